"""Streaming queries; the SQL twin is the batch answer over the same rows."""

from pyspark.sql import functions as F

from seispark.catalog.views import over, query
from seispark.sources import tables
from seispark.streaming import status

LAST = """, l as (select * from b_status qualify row_number() over (partition by event, job_type order by ts desc, seq desc) = 1)
"""


def _status(spark, folder):
    return tables.as_status(status.read_events(spark, folder))


@query("latest_status", over("b_status", LAST + "select event, job_type, status, seq from l"))
def latest_status(spark, folder):
    return status.latest_status(_status(spark, folder)).select("event", "job_type", "status", "seq")


@query("repost_tracker", over("b_status", """select event, job_type, cast(least(count(*), 3) as int) as reposts, count(*) > 3 as gave_up
  from b_status where status in ('failed', 'unknown') group by event, job_type"""))
def repost_tracker(spark, folder):
    return status.repost_tracker(_status(spark, folder), 3)


@query("stage_readiness", over("b_status", """, f as (select event, bool_or(status = 'finished' and job_type = 0) as f0, bool_or(status = 'finished' and job_type = 1) as f1,
  bool_or(status = 'finished' and job_type = 2) as f2, bool_or(status = 'finished' and job_type = 3) as f3, bool_or(status = 'finished' and job_type = 4) as f4 from b_status group by event),
g as (select event, case when not f0 then 0 when not f1 then 1 when not f2 then 2 when not f3 then 3 when not f4 then 4 else 5 end as gap,
  case when event % 10 = 0 then 2 else 5 end as lim from f)
select event, cast(least(gap, lim) as int) as done, case when gap >= lim then 'complete' else
  ['prepare_forward', 'forward', 'hpc_processing', 'adjoint', 'gradient_interp'][gap + 1] end as ready_for from g"""))
def stage_readiness(spark, folder):
    return status.stage_readiness(_status(spark, folder), F.col("event") % 10 == 0)


@query("progress_counts", over("b_status", LAST + """select job_type, count(*) filter (where status = 'pending') as pending, count(*) filter (where status = 'running') as running,
  count(*) filter (where status = 'finished') as finished, count(*) filter (where status = 'failed') as failed,
  count(*) filter (where status = 'cancelled') as cancelled, count(*) filter (where status = 'unknown') as unknown,
  count(*) filter (where status not in ('pending', 'running', 'finished', 'failed', 'cancelled', 'unknown') or status is null) as other, bool_and(status = 'finished') as all_finished from l group by job_type"""))
def progress_counts(spark, folder):
    return status.progress_counts(_status(spark, folder))


@query("new_event_intake", "select distinct user_id as event, 0 as used from events")
def new_event_intake(spark, folder):
    return status.new_event_intake(_status(spark, folder))


@query("process_once", "select user_id as event, min(event_id) as seq from events group by user_id")
def process_once(spark, folder):
    return status.process_once(_status(spark, folder), lambda b: b.groupBy("event").agg(F.min("seq").alias("seq")))
