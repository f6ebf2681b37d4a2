"""Small Column helpers."""

from pyspark.sql import functions as F


def required(col, what):
    """The column; a null stops the job instead of being lost in a join."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.isNull(), F.raise_error(F.lit(f"{what} is missing"))).otherwise(col)


def rnd(col, digits):
    """Rounded, and never -0.0."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col, digits) + F.lit(0.0)
