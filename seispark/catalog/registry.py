"""All registered queries."""

from seispark.catalog import fields, misfits, streams, traces, updates, windows  # noqa: F401
from seispark.catalog.views import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
