"""Misfits and adjoint sources over time windows.

A window is (trace, win, start, stop, weight); a cut by time includes the sample
at ``stop``. Windowed series are keyed by ``trace = struct(t, win)``.
"""


from pyspark.sql import functions as F

from seispark.functions.columns import required
from seispark.operators import traces
from seispark.operators.chunks import CHUNK, attach, in_ranges, index_rows, only_traces, spread_ranges
from seispark.operators.timefrequency import phase_misfit


def window_taper(samples, windows, min_period, dt=1.0, columns=("d", "s"), size=CHUNK):
    """Samples inside each window, tapered over half a period at both ends; outside they are zero and left out."""
    length = F.col("stop") - F.col("start")
    spans = windows.withColumns({"end": F.col("stop") + 1, "ratio": F.lit(0.5 * min_period) / (length * dt)})
    inside = in_ranges(samples, spans, stop="end", size=size)
    weight = traces.taper_weight(F.col("i") - F.col("start"), length + 1, F.least("ratio", F.lit(0.5)))
    return inside.withColumns({c: F.col(c) * weight for c in columns}).drop("end", "ratio")


def envelope_scaling(pair, size=CHUNK):
    """Both traces scaled to range 1 and divided by the observed envelope plus 30 % of its top; ``chain`` is the factor for the adjoint source."""
    stats = traces.trace_stats(pair).select("trace", "n", "ptp_d", "ptp_s")
    unit = attach(pair, stats, size=size).withColumns({"d": F.col("d") / F.col("ptp_d"), "s": F.col("s") / F.col("ptp_s")}).drop("n", "ptp_d")
    env = traces.envelope(unit, ["d"], size)
    top = env.groupBy("trace").agg(F.count("*").alias("n"), F.max("env_d").alias("top"))
    w = 1 / (F.col("env_d") + 0.3 * F.col("top"))
    return attach(env, top, size=size).select(
        "trace", "chunk", "i", (F.col("d") * w).alias("d"), (F.col("s") * w).alias("s"), (w / F.col("ptp_s")).alias("chain")
    )


def _sums(tapered):
    return tapered.groupBy("trace", "win", "start", "stop").agg(
        F.sum(F.col("d") * F.col("d")).alias("oo"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum(F.col("d") * F.col("s")).alias("os")
    )


def ccc(tapered, settings, size=CHUNK):
    """Correlation misfit per window and its adjoint samples.

    The sums of a window go back to its samples once per chunk it touches.
    """
    sums = _sums(tapered)
    misfit = sums.select("trace", "win", (1 - F.col("os") / F.sqrt(F.col("oo") * F.col("ss"))).alias("misfit"))
    ends = sums.withColumn("_end", F.col("stop") + 1)
    per_chunk = spread_ranges(ends, "start", "_end", size).drop("start", "stop", "_end")
    adjoint = tapered.join(per_chunk, ["trace", "win", "chunk"]).withColumn(
        "a", (F.col("d") - F.col("os") / F.col("ss") * F.col("s")) / F.sqrt(F.col("oo") * F.col("ss")) * settings["dt"]
    )
    return misfit, adjoint.drop("oo", "ss", "os")


def tf_phase(tapered, settings, size=CHUNK):
    """Time-frequency phase misfit per window and its adjoint samples.

    Each window is a series of its trace's full length, zero outside.
    """
    key = F.struct(F.col("trace").alias("t"), "win").alias("trace")
    inside = tapered.select(key, "i", "d", "s")
    spans = tapered.groupBy("trace", "win").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    outside = index_rows(spans.join(settings["lengths"], "trace"), "n").where("i < start or i > stop")
    outside = outside.select(key, "i", F.lit(0.0).alias("d"), F.lit(0.0).alias("s"))
    misfit, adjoint = phase_misfit(inside.unionByName(outside), settings["min_period"], settings["max_period"], settings["dt"])
    per_window = misfit.select(F.col("trace.t").alias("_t"), "trace.win", "misfit").withColumnRenamed("_t", "trace")
    parts = adjoint.select(F.col("trace.t").alias("_t"), "trace.win", "i", "a").withColumnRenamed("_t", "trace")
    return per_window, tapered.drop("d", "s").join(parts, ["trace", "win", "i"])


# Misfits by name: function (tapered samples, settings, chunk size) -> (misfit per window, adjoint samples ``a``).
MISFITS = {"ccc": ccc, "tf_phase_misfit": tf_phase}


def adjoint_sources(kind, pair, windows, min_period, max_period, dt=1.0, scaled=False, size=CHUNK):
    """Misfit per trace and full-length adjoint source (trace, chunk, i, a), summed over the windows.

    Each window is tapered, given to the named misfit, and its adjoint samples
    are tapered by the same window again.
    """
    if kind not in MISFITS:
        raise ValueError(f"no misfit called {kind}; known are {sorted(MISFITS)}")
    settings = {"min_period": min_period, "max_period": max_period, "dt": dt, "lengths": traces.lengths(pair)}
    base = envelope_scaling(pair, size) if scaled else pair.withColumn("chain", F.lit(1.0))
    tapered = window_taper(base, windows, min_period, dt, size=size)
    misfit, samples = MISFITS[kind](tapered, settings, size)
    length = F.col("stop") - F.col("start")
    again = traces.taper_weight(F.col("i") - F.col("start"), length + 1, F.least(F.lit(0.5 * min_period) / (length * dt), F.lit(0.5)))
    parts = samples.select("trace", "chunk", "i", (F.col("a") * again * F.col("chain")).alias("a"))
    used = only_traces(pair, windows, size).select("trace", "chunk", "i", F.lit(0.0).alias("a"))
    full = parts.unionByName(used).groupBy("trace", "chunk", "i").agg(F.sum("a").alias("a"))
    return misfit.groupBy("trace").agg(F.sum("misfit").alias("misfit"), F.count("*").alias("windows")), full


def weighted_misfits(misfits, weights):
    """Misfit per (station, trace) times the station's weight; a station without one stops the job."""
    keys = [c for c in ("event", "station") if c in weights.columns]
    joined = misfits.join(weights.select(*keys, "weight"), keys, "left")
    return joined.withColumn("misfit", F.col("misfit") * required("weight", "the weight of a station"))
