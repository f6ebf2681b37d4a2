"""The analytic tables read as the inversion's own tables.

Each function takes the session and the folder of parquet tables and returns
the table that an operator needs (see FIXTURES.md part 3).
"""

from pyspark.sql import functions as F

from seispark.operators.chunks import by_chunk, number_rows, owned, with_chunk, with_halo


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def samples(spark, folder):
    """trace, chunk, i, v: one trace per user, ordered by time."""
    raw = table(spark, folder, "events").selectExpr("user_id as trace", "ts", "event_id", "value as v")
    hour = F.struct(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
    return with_chunk(number_rows(raw, "trace", ["ts", "event_id"], hour).select("trace", "i", "v"))


def long_samples(spark, folder, size):
    """trace, chunk, i, v: ten long traces, the users' traces one behind the other, in chunks of ``size`` samples."""
    raw = table(spark, folder, "events").selectExpr("user_id % 10 as trace", "user_id", "ts", "event_id", "value as v")
    return with_chunk(number_rows(raw, "trace", ["ts", "event_id"], F.col("user_id")).select("trace", "i", "v"), size)


def long_pair(spark, folder, size):
    """trace, chunk, i, d, s: a long trace and its three-point mean."""
    near = by_chunk().rowsBetween(-1, 1)
    edged = with_halo(long_samples(spark, folder, size), 1, 1, size)
    return owned(edged.withColumn("s", F.avg("v").over(near))).withColumnRenamed("v", "d")


def pair(spark, folder):
    """trace, chunk, i, d, s: observed trace and its three-point mean as synthetic."""
    near = by_chunk().rowsBetween(-1, 1)
    edged = with_halo(samples(spark, folder), 1, 1)
    return owned(edged.withColumn("s", F.avg("v").over(near))).withColumnRenamed("v", "d")


def stations(spark, folder):
    return table(spark, folder, "supplier").selectExpr(
        "s_nationkey as event",
        "s_suppkey as station",
        "cast((s_suppkey*37)%179-89 as double) as lat",
        "cast((s_suppkey*71)%359-179 as double) as lon",
    )


def event_sources(spark, folder):
    return table(spark, folder, "nation").selectExpr(
        "n_nationkey as event",
        "cast((n_nationkey*53)%121-60 as double) as lat",
        "cast((n_nationkey*97)%359-179 as double) as lon",
        "1000.0e0*n_regionkey as depth_m",
    )


def nodes(spark, folder):
    lat = "radians(cast((p_partkey*37)%179-89 as double))"
    lon = "radians(cast((p_partkey*71)%359-179 as double))"
    r = "(6371.0e0-10.0e0*p_size)*1000.0e0"
    return table(spark, folder, "part").selectExpr(
        "p_partkey as node",
        "p_size as layer",
        f"{r}*cos({lat})*cos({lon}) as x",
        f"{r}*cos({lat})*sin({lon}) as y",
        f"{r}*sin({lat}) as z",
        "p_retailprice as value",
    )


def model(spark, folder):
    return table(spark, folder, "part").selectExpr(
        "p_brand as param",
        "p_partkey as node",
        "p_retailprice as theta0",
        "p_retailprice*(1.0e0+0.01e0*sin(p_partkey)) as theta",
        "cos(p_partkey)*1.0e-3 as g",
    )


def misfits(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "cast((year(o_orderdate)-1995)*12+month(o_orderdate)-1 as int) as iteration",
        "cast(o_custkey%100 as int) as event",
        "o_totalprice as misfit",
        "o_orderstatus as status",
    )


def pool(spark, folder):
    return table(spark, folder, "customer").selectExpr(
        "c_custkey as event",
        "case c_mktsegment when 'BUILDING' then 'validation' when 'MACHINERY' then 'test' else 'train' end as role",
        "abs(c_acctbal) as norm",
        "cast((c_custkey*37)%179-89 as double) as lat",
        "cast((c_custkey*71)%359-179 as double) as lon",
    )


STATUS = """case event_type when 'signup' then 'pending' when 'view' then 'running'
    when 'purchase' then 'finished' when 'error' then 'failed' else 'unknown' end"""


def as_status(events):
    """Status events of jobs, from a batch or streaming read of the event table."""
    return events.selectExpr(
        "event_id as seq",
        "user_id as event",
        "cast(event_id%5 as int) as job_type",
        f"{STATUS} as status",
        "cast(ts as timestamp) as ts",
    )


def status(spark, folder):
    return as_status(table(spark, folder, "events"))


def gradients(spark, folder):
    """event, batch, param, point, g: one gradient per event."""
    cells = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("event"), F.col("label").alias("batch"), F.posexplode("embedding").alias("pos", "e")
    )
    return cells.selectExpr(
        "event", "batch", "cast(pos%4 as int) as param", "cast(floor(pos/4) as int) as point", "cast(e as double) as g"
    )
