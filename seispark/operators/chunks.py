"""Chunked view of long-form traces.

A trace is a sequence of samples ``(trace, i, v, ...)``. One trace may be most
of a data set, so nothing here windows or groups by ``trace`` alone over
samples. Samples carry ``chunk = i div size`` and every per-sample window or
group runs on ``(trace, chunk)``, which holds at most ``size`` rows plus a halo
of copied neighbours. What has to cross chunks is reduced to a few rows per
chunk first. Samples are numbered from 0 without gaps, as BIGINT: a trace may
have more samples than an INT can count. ``trace`` may be of any type, a struct
included.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.session import materialise

CHUNK = 1 << 16


def by_chunk():
    return Window.partitionBy("trace", "chunk").orderBy("i")


def with_chunk(samples, size=CHUNK):
    return samples.withColumn("chunk", F.expr(f"i div {size}"))


def with_halo(samples, before, after, size=CHUNK):
    """Copy edge samples into the neighbouring chunks.

    Chunk c then sees the indices c*size-before .. (c+1)*size-1+after. Copies
    have ``own = false``; drop them after the window with ``owned``. Only the
    edge samples of a chunk are copied.
    """
    first, last = f"greatest(i - {after}, 0) div {size}", f"(i + {before}) div {size}"
    return (
        samples.drop("chunk")
        .withColumn("chunk", F.explode(F.expr(f"sequence({first}, {last})")))
        .withColumn("own", F.expr(f"chunk = i div {size}"))
    )


def owned(samples):
    return samples.where("own").drop("own")


def attach(samples, per_trace, length="n", size=CHUNK):
    """Join per-trace columns onto samples, spread over (trace, chunk).

    ``per_trace`` has one row per trace with its length; it is repeated once per
    chunk, so the rows of a long trace do not meet in one partition, and a
    following per-chunk window finds its rows already in place.
    """
    spread = per_trace.withColumn(
        "chunk",
        F.explode(F.expr(f"sequence(0L, greatest((cast({length} as bigint) - 1) div {size}, 0L))")),
    )
    return samples.join(spread, ["trace", "chunk"])


def only_traces(samples, keys, size=CHUNK):
    """Samples of the traces in ``keys``; decided per trace, applied per (trace, chunk)."""
    lengths = samples.groupBy("trace").agg((F.max("i") + 1).alias("_n"))
    return attach(samples, lengths.join(keys.select("trace").distinct(), "trace", "left_semi"), "_n", size).drop("_n")


def index_rows(per_trace, length, name="i", size=CHUNK):
    """Rows 0 .. length-1 for each row of ``per_trace``, built chunk by chunk so that no long array exists."""
    chunked = per_trace.withColumn("_m", F.expr(f"cast({length} as bigint)")).where("_m > 0").withColumn(
        "_c", F.explode(F.expr(f"sequence(0L, (_m - 1) div {size})"))
    )
    inside = F.expr(f"sequence(_c * {size}, least((_c + 1) * {size}, _m) - 1)")
    return chunked.withColumn(name, F.explode(inside)).drop("_m", "_c")


def spread_ranges(ranges, start="start", stop="stop", size=CHUNK):
    """Repeat [start, stop) rows once per chunk they touch."""
    return ranges.where(f"{stop} > {start}").withColumn(
        "chunk", F.explode(F.expr(f"sequence({start} div {size}, ({stop} - 1) div {size})"))
    )


def in_ranges(samples, ranges, how="inner", start="start", stop="stop", size=CHUNK):
    """Interval join of samples (with chunk) and index ranges [start, stop)."""
    pieces = spread_ranges(ranges, start, stop, size).withColumnsRenamed({"trace": "_trace", "chunk": "_chunk"})
    hit = F.expr(f"trace = _trace and chunk = _chunk and i >= {start} and i < {stop}")
    return samples.join(pieces, hit, how).drop("_trace", "_chunk")


def runs(valid, size=CHUNK):
    """Maximal runs [start, stop) of the sample indices present in ``valid``.

    Gaps and islands per chunk, then the runs that touch a chunk edge are
    stitched: at most two per chunk do, and only these meet per trace. The
    others stay in a group of their chunk, where no two of them touch.
    """
    numbered = with_chunk(valid.select("trace", "i"), size).withColumn(
        "island", F.col("i") - F.row_number().over(by_chunk())
    )
    pieces = numbered.groupBy("trace", "chunk", "island").agg(
        F.min("i").alias("start"), (F.max("i") + 1).alias("stop")
    )
    pieces = pieces.withColumn("place", F.expr(f"if(start % {size} = 0 or stop % {size} = 0, -1L, chunk)"))
    by_start = Window.partitionBy("trace", "place").orderBy("start")
    new = F.coalesce((F.lag("stop").over(by_start) != F.col("start")).cast("int"), F.lit(1))
    return (
        pieces.withColumn("new", new)
        .withColumn("group", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("trace", "place", "group")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .select("trace", "start", "stop")
    )


def number_rows(df, key, order, bucket, name="i"):
    """0-based row number per key without one task per key.

    ``bucket`` is a Column that grows with ``order``: rows are counted per (key,
    bucket), the counts are summed up before each bucket, and rows are numbered
    inside their bucket only.
    """
    df = df.withColumn("bucket", bucket)
    before = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(key, "bucket")
        .agg(F.count("*").alias("rows"))
        .select(key, "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy(key, "bucket").orderBy(*order)
    return (
        df.join(offsets, [key, "bucket"])
        .withColumn(name, (F.col("offset") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("bucket", "offset")
    )


def number_sorted(df, order, name="i"):
    """0-based number of every row of a table in the order of ``order``; ties in any order.

    The rows are dealt by ranges and sorted once; only the counts of the partitions are summed up in order.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id())
    ordered = materialise(ordered.withColumn("_part", F.shiftright("_pos", 33)), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_pos").alias("_first"))
    starts = starts.select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return ordered.join(starts, "_part").withColumn(name, F.col("_pos") + F.col("_shift")).drop("_pos", "_part", "_shift")


def sibling(rows, columns, name, after=True):
    """Struct ``name`` of the columns of the next (or previous) row of the trace; rows may be sparse.

    The neighbour is looked up inside the chunk; for a row at a chunk's edge it
    comes from the nearest chunk that has rows, found among one row per chunk.
    """
    rows = rows.withColumn("_me", F.struct(*columns))
    inside = (F.lead if after else F.lag)("_me").over(by_chunk())
    pick = F.min_by if after else F.max_by
    edge = rows.groupBy("trace", "chunk").agg(pick("_me", "i").alias("_edge"))
    by_chunks = Window.partitionBy("trace").orderBy("chunk")
    edge = edge.select("trace", "chunk", (F.lead if after else F.lag)("_edge").over(by_chunks).alias("_other"))
    return (
        rows.join(edge, ["trace", "chunk"])
        .withColumn(name, F.coalesce(inside, F.col("_other")))
        .drop("_me", "_other")
    )


def nearest(refs, targets, size=CHUNK):
    """Each target (trace, i, ...) with ``match``, the position of the nearest reference in its trace.

    A tie goes to the right; targets outside the references take the first or
    last one. Targets of traces without references are dropped.
    """
    refs = refs.select("trace", "i").withColumn("chunk", F.floor(F.col("i") / size).cast("bigint"))
    placed = number_rows(refs.withColumn("_c", F.col("chunk")), "trace", ["i"], F.col("_c"), "pos").drop("_c")
    extra = [c for c in targets.columns if c not in ("trace", "i", "chunk")]
    both = placed.select(
        "trace", "chunk", F.col("i").cast("double").alias("at"), F.struct("i", "pos").alias("ref"), F.lit(1).alias("is_ref"),
        *[F.lit(None).cast(targets.schema[c].dataType).alias(c) for c in ["i", *extra] if c != "trace"],
    ).unionByName(
        targets.select(
            "trace", F.floor(F.col("i") / size).cast("bigint").alias("chunk"), F.col("i").cast("double").alias("at"),
            F.lit(None).cast(placed.select(F.struct("i", "pos").alias("x")).schema["x"].dataType).alias("ref"),
            F.lit(0).alias("is_ref"), "i", *extra,
        )
    )
    up = Window.partitionBy("trace", "chunk").orderBy("at", "is_ref").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("trace", "chunk").orderBy(F.desc("at"), F.desc("is_ref")).rowsBetween(Window.unboundedPreceding, -1)
    ends = both.groupBy("trace", "chunk").agg(
        F.min_by("ref", F.when(F.col("is_ref") == 1, F.col("at"))).alias("first"),
        F.max_by("ref", F.when(F.col("is_ref") == 1, F.col("at"))).alias("last"),
    )
    order = Window.partitionBy("trace").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("trace").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        "trace", "chunk",
        F.last("last", ignorenulls=True).over(order).alias("before"),
        F.last("first", ignorenulls=True).over(back).alias("beyond"),
    )
    found = (
        both.withColumn("left", F.last("ref", ignorenulls=True).over(up))
        .withColumn("right", F.last("ref", ignorenulls=True).over(down))
        .where("is_ref = 0")
        .join(carry, ["trace", "chunk"])
        .withColumn("left", F.coalesce("left", "before"))
        .withColumn("right", F.coalesce("right", "beyond"))
    )
    match = F.expr(
        "case when left is null then right.pos when right is null then left.pos "
        "when i - left.i < right.i - i then left.pos else right.pos end"
    )
    return found.withColumn("match", match).where("match is not null").select("trace", "chunk", "i", *extra, "match")


def spread(df, *keys):
    """Hash-partition by keys into as many partitions as the session shuffles to.

    For rows that are small but costly to work on: without it adaptive execution
    would join them into few tasks by their size. A following group by the same keys needs no
    further shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def map_chunks(samples, fn, schema, before=0, after=0, size=CHUNK):
    """Run a callback of one's own (pandas frame -> pandas frame) on every chunk.

    The frame holds the chunk in order of i, with ``before`` and ``after`` samples
    of its neighbours marked ``own = False``.
    """
    return with_halo(samples, before, after, size).groupBy("trace", "chunk").applyInPandas(lambda pdf: fn(pdf.sort_values("i")), schema)


def blocks(samples, columns, extra=()):
    """One row per (trace, chunk): ``lo`` and an array per column, in order of i.

    An array holds at most one chunk and its halo. ``extra`` columns are constant per trace.
    """
    packed = spread(samples, "trace", "chunk").groupBy("trace", "chunk", *extra).agg(
        F.sort_array(F.collect_list(F.struct("i", *columns))).alias("p")
    )
    return packed.select("trace", "chunk", *extra, F.col("p.i")[0].alias("lo"), *[F.col(f"p.{c}").alias(c) for c in columns])
