"""Readers, writers and snapshot-directory tables."""
