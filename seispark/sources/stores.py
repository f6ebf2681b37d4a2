"""Tables kept between jobs: nodal fields, receivers, ledgers, adjoint sources."""

from pyspark.sql import functions as F

from seispark.functions.geo import geocentric_latitude
from seispark.operators.fields import replace_params, select_params
from seispark.session import fresh_path

RECEIVER = "latitude double, longitude double, `network-code` string, `station-code` string"


def new_store(spark, name):
    return fresh_path(spark, name)


def exists(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_nodal(nodal, path):
    """Nodal values (iteration, param, node, value), one folder per iteration and parameter.

    A parameter of an iteration is replaced as a whole, so that a write done twice leaves what one leaves.
    """
    out = nodal.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("iteration", "param").parquet(path)
    return path


def read_nodal(spark, path, iteration, params=None):
    """One iteration, wanted parameters only: both prune folders."""
    rows = spark.read.parquet(path).where(F.col("iteration") == iteration)
    return rows if params is None else select_params(rows, params)


def update_nodal(spark, path, old, new_iteration, new):
    """Write iteration ``new_iteration``: the old values, replaced where ``new`` has some.

    An iteration that is not there, or is to replace itself, is an error.
    """
    if old == new_iteration or not exists(spark, f"{path}/iteration={old}"):
        raise ValueError(f"iteration {new_iteration} can't be written from iteration {old} in {path}")
    target = read_nodal(spark, path, old).withColumn("iteration", F.lit(new_iteration))
    return write_nodal(replace_params(target, new), path)


def write_traces(samples, path):
    """Chunk arrays (event, station, tag, chunk, samples), one folder per event.

    Rows are dealt by event, and a large event is split by size, so that the files of an event are as many as its
    bytes need; in a file they are in order of station, so that its statistics tell which stations it can hold.
    """
    packed = samples.groupBy("event", "station", "tag", "chunk").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("p"))
    rows = packed.select("event", "station", "tag", "chunk", F.col("p.v").alias("samples")).hint("rebalance", "event")
    rows.sortWithinPartitions("event", "station", "tag", "chunk").write.mode("append").partitionBy("event").parquet(path)
    return path


def read_traces(spark, path, event=None, station=None, tag=None):
    """Chunks of all traces, or of one event (which prunes folders), station or tag."""
    rows = spark.read.parquet(path)
    if event is not None:
        rows = rows.where(F.col("event") == event)
    if station is not None:
        rows = rows.where(F.col("station") == station)
    return rows if tag is None else rows.where(F.col("tag") == tag)


def preferred_origin(origins):
    """Per event the preferred origin, else the first one."""
    rest = [c for c in origins.columns if c != "event"]
    order = F.struct((~F.col("preferred")).cast("int"), "origin")
    return origins.groupBy("event").agg(F.min_by(F.struct(*rest), order).alias("o")).select("event", "o.*")


def read_iteration(spark, path, iteration):
    """One past iteration; an iteration that is not there is an error."""
    if not exists(spark, f"{path}/iteration={iteration}"):
        raise ValueError(f"no iteration {iteration} in {path}")
    return spark.read.parquet(path).where(F.col("iteration") == iteration)


def build_receivers(stations, path):
    """Station list with geocentric latitude; written once, read back afterwards.

    ``path`` names the event and the version of its data, so that a new version
    is built anew.
    """
    spark = stations.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        stations.distinct().select(
            "network", "station", geocentric_latitude("lat").alias("latitude"), F.col("lon").alias("longitude")
        ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_receivers_json(spark, path):
    """One JSON object per line."""
    r = F.from_json("value", RECEIVER)
    return spark.read.text(path).select(r.alias("r")).select(
        F.col("r.`network-code`").alias("network"), F.col("r.`station-code`").alias("station"), "r.latitude", "r.longitude"
    )


def receivers_of_run(runs):
    """Receivers nested in a simulation description: forward_run_input.output.point_data.receiver."""
    schema = f"struct<forward_run_input: struct<output: struct<point_data: struct<receiver: array<struct<{RECEIVER_STRUCT}>>>>>>"
    nested = F.from_json("value", schema)["forward_run_input"]["output"]["point_data"]["receiver"]
    return runs.select(F.explode(nested).alias("r")).select("r.*")


RECEIVER_STRUCT = "latitude: double, longitude: double, `network-code`: string, `station-code`: string"
