"""Monitoring of job status events as structured streams.

Every monitor writes each micro-batch to its own ``epoch=N`` folder, replaced as
a whole when a batch is run again after a failure, so results are exactly once.
Aggregates run on the JVM with partial sums; none keeps rows of a busy key in
one place. Job events may come late or out of order: the newest by time counts.
"""

from pyspark.sql import functions as F

from seispark.operators.ledger import latest, status_counts
from seispark.session import fresh_path
from seispark.sources.stores import exists

# The stages of an event in order; validation events stop after forward.
STAGES = ["prepare_forward", "forward", "hpc_processing", "adjoint", "gradient_interp"]
VALIDATION_STAGES = 2
FAILURES = ["failed", "unknown"]
#: How late a status event may come, by its own time.
LATE = "365 days"


def read_events(spark, folder, name="events", files_per_batch=None):
    """Stream over the parquet files of one table."""
    schema = spark.read.option("pathGlobFilter", f"{name}*.parquet").parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run(stream, name, mode="append", transform=None, path=None, checkpoint=None):
    """Process all there is, then stop; returns the folder with one subfolder per batch.

    ``transform(batch, earlier)`` may reshape a batch before it is written;
    ``earlier`` is what the batches before it wrote, or None. Give ``path`` and
    ``checkpoint`` again to go on with files that came later.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, name)
    checkpoint = checkpoint or fresh_path(spark, f"{name}-checkpoint")

    def write(batch, epoch):
        session = batch.sparkSession
        if transform is not None:
            earlier = None
            if epoch > 0 and exists(session, path):
                earlier = session.read.option("basePath", path).parquet(path).where(F.col("epoch") < epoch)
            batch = transform(batch, earlier)
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path


def newest(spark, path, by):
    """Last written row per key."""
    return latest(spark.read.parquet(path), by, ["epoch"]).drop("epoch")


def latest_status(status, **where):
    """Newest status per event and job type."""
    spark = status.sparkSession
    now = status.groupBy("event", "job_type").agg(F.max_by(F.struct("status", "seq", "ts"), F.struct("ts", "seq")).alias("r"))
    path = run(now.select("event", "job_type", "r.*"), "latest-status", "update", **where)
    return newest(spark, path, ["event", "job_type"])


def repost_tracker(status, max_reposts, late=LATE, **where):
    """Reposts per event and job type; ``gave_up`` where one more was needed than allowed.

    Every failure counts once by its event id, replays included: ids are kept for as long as an event may come
    ``late``, and older events are left out, so that the state has a bound. Batches only add their own counts; the
    totals are summed when read.
    """
    spark = status.sparkSession
    failures = status.where(F.col("status").isin(FAILURES)).select("seq", "event", "job_type", "ts")
    failures = failures.withWatermark("ts", late).dropDuplicatesWithinWatermark(["seq"])
    path = run(failures, "reposts", transform=lambda b, _: b.groupBy("event", "job_type").agg(F.count("*").alias("failures")), **where)
    totals = spark.read.parquet(path).groupBy("event", "job_type").agg(F.sum("failures").alias("failures"))
    return totals.select(
        "event", "job_type", F.least("failures", F.lit(max_reposts)).cast("int").alias("reposts"), (F.col("failures") > max_reposts).alias("gave_up")
    )


def stage_readiness(status, is_validation, **where):
    """Stages each event has behind it, counted without gaps, and the one it is ready for.

    ``job_type`` is the position of the stage; ``is_validation`` a Column over event.
    """
    spark = status.sparkSession
    bit = F.when(F.col("status") == "finished", F.expr("shiftleft(1, job_type)")).otherwise(0)
    bits = status.groupBy("event").agg(F.bit_or(bit).alias("bits"))
    path = run(bits, "stages", "update", **where)
    flags = newest(spark, path, ["event"])
    limit = F.when(is_validation, VALIDATION_STAGES).otherwise(len(STAGES))
    gap = F.lit(len(STAGES))
    for k in reversed(range(len(STAGES))):
        gap = F.when(F.col("bits").bitwiseAND(1 << k) == 0, F.lit(k)).otherwise(gap)
    done = F.least(gap, limit)
    names = F.array(*map(F.lit, STAGES))
    return flags.select(
        "event", done.cast("int").alias("done"),
        F.when(done >= limit, F.lit("complete")).otherwise(F.get(names, done)).alias("ready_for"),
    )


def progress_counts(status, **where):
    """Number of jobs in each state per job type."""
    return status_counts(latest_status(status, **where), "job_type")


def new_event_intake(events, late=LATE, **where):
    """Each event once, when it is first seen, with use count 0.

    A batch writes events it has not seen for as long as one may come ``late``; one that comes back after that is
    written again and read once.
    """
    spark = events.sparkSession
    fresh = events.select("event", "ts").withWatermark("ts", late).dropDuplicatesWithinWatermark(["event"])
    path = run(fresh.select("event"), "intake", **where)
    return spark.read.parquet(path).select("event").distinct().select("event", F.lit(0).alias("used"))


def process_once(events, process, **where):
    """Apply ``process`` (batch -> one row per event) to events without output so far."""
    spark = events.sparkSession

    def step(batch, earlier):
        todo = batch if earlier is None else batch.join(earlier.select("event"), "event", "left_anti")
        return process(todo)

    return spark.read.parquet(run(events, "process-once", transform=step, **where)).drop("epoch")
