"""Exact, linearly interpolated quantiles of groups of any size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.session import materialise


def in_order(df, by, value):
    """A written table of the rows in order of group and value (nulls last), with ``_pos``: partition and place in it.

    It is dealt by ranges of group and value, and in the end by the row itself, so a large group, and even one value
    of it, lies in many partitions while many small groups share one.
    """
    order = [*by, F.col(value).asc_nulls_last(), "_row"]
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(dealt.drop("_row").withColumn("_pos", F.monotonically_increasing_id()), "in-order")


def quantiles_of(ordered, by, value, probs):
    """One row per group of ``by`` with a column for each entry of ``probs`` (name -> p), from a table ``in_order``.

    Rows are counted per partition and group; sums of the counts before tell in which partition, and where in it, the two
    rows of a wanted rank are, and these alone are fetched. Groups without values give no row.
    """
    part = F.shiftright("_pos", 33).alias("_part")
    counts = ordered.groupBy(*by, part).agg(F.count(value).alias("held"), F.min("_pos").alias("first")).where("held > 0")
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"n": F.sum("held").over(group), "offset": F.coalesce(F.sum("held").over(before), F.lit(0))})
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), side(F.lit(float(p)) * (F.col("n") - 1)).cast("bigint").alias("rank"), (F.lit(float(p)) * (F.col("n") - 1)).alias("place"))
        for name, p in probs.items() for side in (F.floor, F.ceil)
    ])
    asked = counts.withColumn("t", F.explode(wanted)).where("t.rank >= offset and t.rank < offset + held")
    asked = asked.select(*by, "t.name", "t.rank", "t.place", (F.col("first") + F.col("t.rank") - F.col("offset")).alias("_pos")).distinct()
    found = asked.join(ordered.select("_pos", F.col(value).alias("_at")), "_pos")
    low, high = F.min_by("_at", "rank"), F.max_by("_at", "rank")
    ends = found.groupBy(*by, "name").agg((low + (high - low) * (F.max("place") - F.min("rank"))).alias("_at"))
    return ends.groupBy(*by).agg(*[F.max(F.when(F.col("name") == name, F.col("_at"))).alias(name) for name in probs])


def exact_quantiles(df, by, value, probs):
    """One row per group of ``by`` with a column for each entry of ``probs`` (name -> p); one sort by ranges, of the needed columns alone."""
    if not by:
        return exact_quantiles(df.select(F.lit(0).alias("_all"), value), ["_all"], value, probs).drop("_all")
    return quantiles_of(in_order(df.select(*by, value), list(by), value), list(by), value, probs)
