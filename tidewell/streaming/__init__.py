"""Structured Streaming refinement jobs."""
