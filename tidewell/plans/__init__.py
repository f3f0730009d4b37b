"""Pipelines over the driver tables and the registry of named queries."""

from tidewell.plans.registry import ORACLES, QUERIES


def load_all():
    """Import every plan module so that its queries register."""
    from tidewell.plans import orders, contact, individual, ingest, streams, io  # noqa: F401
    return QUERIES, ORACLES
