"""Choice of the events of an iteration."""

from pyspark.sql import functions as F

from seispark.operators.quantiles import exact_quantiles
from seispark.session import materialise


def blocked(pool):
    """Validation and test events."""
    val = pool.where("role = 'validation'").select("event")
    return val.union(pool.where("role = 'test'").select("event")).distinct()


def event_pool(pool):
    return pool.join(blocked(pool), "event", "left_anti")


def fill_norms(pool, norms, p=0.65):
    """Norm per pool event; events without one get the ``p`` percentile of the known norms.

    Where no norm is known, as in a first iteration, all events weigh the same.
    """
    known = exact_quantiles(norms, [], "norm", {"fill": p}).agg(F.max("fill").alias("fill"))
    fill = known.select(F.coalesce("fill", F.lit(1.0))).scalar()
    return pool.drop("norm").join(norms.select("event", "norm"), "event", "left").withColumn(
        "norm", F.coalesce("norm", fill)
    )


def _degrees(lat, lon):
    """Angular distance of the row to a fixed place."""
    p, q = F.radians("lat"), F.radians(F.lit(lat))
    c = F.sin(p) * F.sin(q) + F.cos(p) * F.cos(q) * F.cos(F.radians("lon") - F.radians(F.lit(lon)))
    same = (F.col("lat") == lat) & (F.col("lon") == lon)
    return F.when(same, 0.0).otherwise(F.degrees(F.acos(F.greatest(F.least(c, F.lit(1.0)), F.lit(-1.0)))))


def pick_minibatch(candidates, size):
    """``size`` events spread over space, large norms preferred: (round, event, score).

    The first pick has the largest norm; each further one has the largest product
    of norm and distance to the nearest pick so far; the smaller id wins a tie.
    Every round is one aggregate over the candidates that returns one row.
    """
    picks = []
    for k in range(size):
        near = [_degrees(p.lat, p.lon) for p in picks]
        distance = F.lit(1.0) if not near else near[0] if len(near) == 1 else F.least(*near)
        left = candidates.where(~F.col("event").isin([p.event for p in picks])) if picks else candidates
        best = left.withColumn("score", distance * F.col("norm")).agg(
            F.max_by(F.struct("event", "lat", "lon", "score"), F.struct("score", -F.col("event"))).alias("b")
        ).first().b
        if best is None:
            break
        picks.append(best)
    rows = [(k, p.event, float(p.score)) for k, p in enumerate(picks)]
    return candidates.sparkSession.createDataFrame(rows, "round int, event bigint, score double")


def events_of_iteration(pool, norms, size, iteration, interval):
    """(event, role) of an iteration: a minibatch of the training events, and the validation events when they are due.

    ``pool`` is (event, role, lat, lon), ``norms`` (event, norm) what earlier iterations left, maybe nothing.
    """
    candidates = materialise(fill_norms(event_pool(pool), norms), "candidates")
    picked = pick_minibatch(candidates, size).select("event", F.lit("train").alias("role"))
    due = interval and (iteration == 0 or (iteration + 1) % interval == 0)
    return picked.unionByName(pool.where("role = 'validation'").select("event", "role")) if due else picked


def random_minibatch(candidates, size, seed):
    """``size`` events drawn without replacement with probability by norm; a distributed top-k."""
    return candidates.orderBy(-F.log(F.rand(seed)) / F.col("norm"), "event").limit(size)


def validation_due(iteration, interval):
    it, every = F.col(iteration), F.col(interval)
    return F.when(every == 0, False).otherwise((it == 0) | (F.expr(f"pmod({iteration} + 1, nullif({interval}, 0))") == 0))
