"""The run ledger: iterations, job states, misfits and usage counts."""

from pyspark.sql import functions as F

JOBS = ["forward", "adjoint", "prepare_forward", "gradient_interp", "hpc_processing"]
VALIDATION_JOBS = ["forward", "prepare_forward"]
STATUSES = ["pending", "running", "finished", "failed", "cancelled", "unknown"]


def init_iteration(events, prepare_forward=True, remote_interp=True, hpc_processing=True):
    """One row per event (iteration, event, role) and job type it needs."""
    on = {"forward": True, "adjoint": True, "prepare_forward": prepare_forward, "gradient_interp": remote_interp, "hpc_processing": hpc_processing}

    def names(jobs):
        return F.array(*[F.lit(j) for j in jobs if on[j]])

    validation = F.col("role") == "validation"
    return events.select(
        "iteration",
        "event",
        F.explode(F.when(validation, names(VALIDATION_JOBS)).otherwise(names(JOBS))).alias("job_type"),
        F.lit(False).alias("submitted"),
        F.lit(False).alias("retrieved"),
        F.lit(0).alias("reposts"),
        F.when(~validation, 0.0).alias("misfit"),
        F.when(~validation, False).alias("usage_updated"),
    )


def latest(rows, by, order):
    """Newest row per key; an aggregate, so rows of a busy key are combined before the shuffle."""
    rest = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*by, "r.*")


def bulk_update(ledger, field, value, iteration, job_type=None, event=None):
    """Set one field for the named (or every) event and the named (or every) job type of an iteration."""
    hit = F.col("iteration") == iteration
    if job_type is not None:
        hit &= F.col("job_type") == job_type
    if event is not None:
        hit &= F.col("event") == event
    return ledger.withColumn(field, F.when(hit, F.lit(value)).otherwise(F.col(field)))


def rollback(ledger, iteration):
    """Drop the iterations above the given one and set that one back to its first task."""
    here = F.col("iteration") == iteration
    return ledger.where(F.col("iteration") <= iteration).withColumns(
        {
            "submitted": F.when(here, False).otherwise(F.col("submitted")),
            "retrieved": F.when(here, False).otherwise(F.col("retrieved")),
            "reposts": F.when(here, 0).otherwise(F.col("reposts")),
        }
    )


def rollback_records(records, iteration, ledger="ledger", kept=("model",)):
    """All record tables set back to the start of an iteration: {name: table}, each with an ``iteration`` column.

    The ledger goes back to the iteration's first task. The iteration's own inputs (``kept``) stay; what it and
    later ones produced (misfits, norms, moments, updates) goes, and so does what was written for the next one.
    """
    out = {}
    for name, table in records.items():
        if name == ledger:
            out[name] = rollback(table, iteration)
        else:
            out[name] = table.where(F.col("iteration") <= iteration if name in kept else F.col("iteration") < iteration)
    return out


def usage_counts(used):
    """Iterations each training event took part in; repeated rows count once."""
    return used.groupBy("event").agg(F.count_distinct("iteration").alias("used"))


def register_new(all_events, seen):
    return all_events.select("event").distinct().join(seen, "event", "left_anti").withColumn("used", F.lit(0))


def misfit_rollup(misfits):
    """Sum per (iteration, event), per iteration and over all; level 0, 1, 3."""
    return misfits.rollup("iteration", "event").agg(
        F.sum("misfit").alias("misfit"), F.grouping_id().cast("int").alias("level")
    )


def control_group(misfits, old, new):
    """Per iteration the misfit sums over the old and the new control group (Columns)."""
    return misfits.groupBy("iteration").agg(
        F.sum(F.when(old, F.col("misfit"))).alias("old_group"), F.sum(F.when(new, F.col("misfit"))).alias("new_group")
    )


def misfit_reduction(misfits):
    """Percent change per iteration over the events of both it and the iteration before."""
    per_event = misfits.groupBy("iteration", "event").agg(F.sum("misfit").alias("new"))
    before = per_event.select((F.col("iteration") + 1).alias("iteration"), "event", F.col("new").alias("old"))
    both = per_event.join(before, ["iteration", "event"]).groupBy("iteration").agg(
        F.sum("old").alias("old"), F.sum("new").alias("new"), F.count("*").alias("events")
    )
    return both.withColumn("percent", 100 * (F.col("old") - F.col("new")) / F.col("old")).withColumn(
        "verdict", F.when(F.col("percent") > 0, "reduction").otherwise("increase")
    )


def status_counts(status, by):
    """Count of each job status per key, of all others (null too) as ``other``, and whether all are finished."""
    known = F.coalesce(F.col("status").isin(STATUSES), F.lit(False))
    return status.groupBy(by).agg(
        *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES],
        F.count(F.when(~known, 1)).alias("other"),
        F.bool_and(F.col("status").eqNullSafe("finished")).alias("all_finished"),
    )


def next_to_process(events, processed, n):
    """The first n events without processed data: validation first, then the current iteration, then the rest."""
    todo = events.join(processed, "event", "left_anti")
    return todo.orderBy("priority", "event").limit(n)
