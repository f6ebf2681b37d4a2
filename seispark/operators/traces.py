"""Per-trace signal operators over long-form samples (trace, chunk, i, v, ...)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seispark.functions import kernels
from seispark.operators import fourier
from seispark.operators.chunks import CHUNK, attach, blocks, by_chunk, index_rows, owned, with_chunk, with_halo
from seispark.session import materialise

# ---- selection ------------------------------------------------------------


def select_component(headers, component=None, by=("station",)):
    """Channels (station, channel) whose last letter is the only one of its kind at the station."""
    letter = F.upper(F.right("channel", F.lit(1)))
    single = headers.groupBy(*by, letter.alias("component")).agg(
        F.count("*").alias("n"), F.first("channel").alias("channel")
    ).where("n = 1").drop("n")
    return single if component is None else single.where(F.col("component") == component)


def one_tag_only(headers, by=("station",)):
    """Stations with exactly one tag."""
    return headers.groupBy(*by).agg(F.min("tag").alias("tag"), F.max("tag").alias("_most")).where("tag = _most").drop("_most")


def usable(samples, column="v"):
    """Per trace: no NaN and not all zero."""
    return samples.groupBy("trace").agg(
        (~F.bool_or(F.isnan(column)) & (F.max(F.abs(column)) > 0)).alias("usable")
    )


def trace_stats(pair):
    """Numbers of an observed (d) and a synthetic (s) trace; one row per trace."""
    return pair.groupBy("trace").agg(
        F.count("*").alias("n"),
        (F.max("d") - F.min("d")).alias("ptp_d"),
        (F.max("s") - F.min("s")).alias("ptp_s"),
        F.max(F.abs("d")).alias("max_d"),
        F.max(F.abs("s")).alias("max_s"),
        F.sum(F.col("d") * F.col("d")).alias("dd"),
        F.sum(F.col("s") * F.col("s")).alias("ss"),
        F.sum(F.col("d") * F.col("s")).alias("ds"),
    ).withColumn("cc", F.col("ds") / (F.sqrt("dd") * F.sqrt("ss")))


def pair_traces(observed, synthetic, keys):
    """Observed and synthetic traces of the same keys."""
    return observed.join(synthetic, list(keys))


def align(observed, synthetic, size=CHUNK):
    """Samples both traces have, from the first to the earlier end."""
    return observed.withColumnRenamed("v", "d").join(synthetic.withColumnRenamed("v", "s"), ["trace", "chunk", "i"])


def resample_slopes(samples, ratios, size=CHUNK):
    """Every ``ratio``-th sample (trace, ratio: new over old interval) by cubics through weighted mean slopes.

    The slope at a sample is the mean of the steps beside it, each weighted by the inverse of its
    size, and 0 where they differ in sign. Each old sample makes the new ones up to the next old one,
    with one neighbour before and two behind it, so a chunk needs no more than these copies.
    """
    n = lengths(samples).join(ratios.select("trace", "ratio"), "trace")
    edged = with_halo(attach(samples, n, size=size), 1, 2, size)
    at = by_chunk()
    steps = edged.withColumns({"_y": F.lead("v").over(at), "_before": F.col("v") - F.lag("v").over(at), "_far": F.lead("v", 2).over(at)})
    steps = owned(steps).withColumns({"_step": F.col("_y") - F.col("v"), "_after": F.col("_far") - F.col("_y")})

    def slope(p, q):
        w, z = 1 / F.greatest(F.abs(p), F.lit(2.0**-52)), 1 / F.greatest(F.abs(q), F.lit(2.0**-52))
        mean = F.when(F.signum(p) == F.signum(q), (w * p + z * q) / (w + z)).otherwise(0.0)
        return F.when(p.isNull(), q).when(q.isNull(), p).otherwise(mean)

    first = F.ceil(F.col("i") / F.col("ratio")).cast("bigint")
    last = F.when(F.col("_y").isNull(), F.floor(F.col("i") / F.col("ratio"))).otherwise(F.ceil((F.col("i") + 1) / F.col("ratio")) - 1).cast("bigint")
    new = steps.withColumns({"_m": slope(F.col("_before"), F.col("_step")), "_n": slope(F.col("_step"), F.col("_after"))})
    new = new.where(first <= last).withColumn("_j", F.explode(F.sequence(first, last)))
    u = F.col("_j") * F.col("ratio") - F.col("i")
    cubic = (
        (1 + 2 * u) * (1 - u) ** 2 * F.col("v") + u * (1 - u) ** 2 * F.col("_m") + u**2 * (3 - 2 * u) * F.col("_y") + u**2 * (u - 1) * F.col("_n")
    )
    value = F.when(F.col("_y").isNull(), F.col("v")).otherwise(cubic)
    return with_chunk(new.select("trace", F.col("_j").alias("i"), value.alias("v")), size)


def align_in_time(observed, synthetic, headers, size=CHUNK):
    """(trace, chunk, i, d, s) of traces that start and are sampled differently.

    ``headers`` has t0_d, dt_d, t0_s and dt_s (seconds) per trace. The synthetic is brought to the rate of the
    data; both are cut to the time they share, and the first shared sample gets index 0.
    """
    ratios = headers.select("trace", (F.col("dt_d") / F.col("dt_s")).alias("ratio"))
    moved = resample_slopes(synthetic, ratios, size)
    shift = F.round((F.col("t0_d") - F.col("t0_s")) / F.col("dt_d")).cast("bigint")
    offsets = headers.select("trace", shift.alias("_shift"))

    def from_start(samples, back):
        known = attach(samples, lengths(samples).withColumnRenamed("n", "_n").join(offsets, "trace"), "_n", size)
        there = known.withColumn("i", F.col("i") - F.greatest(back, F.lit(0)))
        return with_chunk(there.where("i >= 0").select("trace", "i", "v"), size)

    return align(from_start(observed, -F.col("_shift")), from_start(moved, F.col("_shift")), size)


def scale_to_synthetic(pair, stats, size=CHUNK):
    """Observed trace brought to the peak-to-peak range of the synthetic."""
    factor = stats.select("trace", "n", (F.col("ptp_s") / F.col("ptp_d")).alias("factor"))
    return attach(pair, factor, size=size).withColumn("d", F.col("d") * F.col("factor")).drop("n", "factor")


def pair_checks(pairs):
    """Errors and warnings of paired headers (n_d, n_s, dt_d, dt_s, t0_d, t0_s seconds, ptp_d, ptp_s, cha_d, cha_s)."""
    rate_gap = F.abs(1 / F.col("dt_d") - 1 / F.col("dt_s")) * F.col("dt_d")
    ratio = F.greatest("ptp_d", "ptp_s") / F.least("ptp_d", "ptp_s")

    def listed(*cases):
        return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in cases]))

    return pairs.withColumns(
        {
            "errors": listed(
                (F.col("n_d") != F.col("n_s"), "npts"),
                (rate_gap >= 1e-5, "rate"),
                (F.abs(F.col("t0_d") - F.col("t0_s")) > 0.5 * F.col("dt_d"), "start"),
            ),
            "warnings": listed(
                (ratio >= 5, "amplitude"),
                (F.upper(F.right("cha_d", F.lit(1))) != F.upper(F.right("cha_s", F.lit(1))), "component"),
            ),
        }
    )


# ---- simple signal steps --------------------------------------------------


def lengths(samples):
    return samples.groupBy("trace").agg(F.count("*").alias("n"))


def trim_pad(samples, start, stop, column="v", size=CHUNK):
    """Exactly the indices [start, stop) of every trace, renumbered from 0; missing samples are 0."""
    ends = samples.groupBy("trace").agg(F.min("i").alias("first"), F.max("i").alias("last"))
    around = F.expr(f"array(struct({start}L as low, least(first, {stop}) as high), struct(greatest(last + 1, {start}) as low, {stop}L as high))")
    empty = ends.withColumn("g", F.explode(around)).select("trace", "g.low", (F.col("g.high") - F.col("g.low")).alias("gap"))
    gaps = index_rows(empty, "gap", "at", size).select("trace", (F.col("low") + F.col("at")).alias("i"), F.lit(0.0).alias(column))
    kept = samples.where((F.col("i") >= start) & (F.col("i") < stop)).select("trace", "i", column)
    return with_chunk(kept.unionByName(gaps).withColumn("i", F.col("i") - start), size)


def detrend(samples, column="v", size=CHUNK):
    """Subtract the least-squares line over the index; what is left has mean 0."""
    line = samples.groupBy("trace").agg(
        F.count("*").alias("_n"),
        F.regr_slope(column, "i").alias("_slope"),
        F.regr_intercept(column, "i").alias("_level"),
    )
    fitted = attach(samples, line, "_n", size)
    return fitted.withColumn(column, F.col(column) - F.col("_level") - F.col("_slope") * F.col("i")).drop("_n", "_slope", "_level")


def taper_weight(i, n, ratio):
    """Cosine ramp over int(ratio*n) samples at each end."""
    ramp = F.floor(ratio * n)
    j = F.least(i, n - 1 - i)
    return F.when(j < ramp, 0.5 * (1 - F.cos(F.lit(np.pi) * j / ramp))).otherwise(1.0)


def taper(samples, ratio=0.05, column="v", size=CHUNK):
    tapered = attach(samples, lengths(samples).withColumnRenamed("n", "_n"), "_n", size)
    return tapered.withColumn(column, F.col(column) * taper_weight(F.col("i"), F.col("_n"), F.lit(ratio))).drop("_n")


def detrend_taper(samples, ratio=0.05, column="v", size=CHUNK):
    """detrend, then taper, with one aggregate and one join."""
    line = samples.groupBy("trace").agg(
        F.count("*").alias("_n"),
        F.regr_slope(column, "i").alias("_slope"),
        F.regr_intercept(column, "i").alias("_level"),
    )
    flat = F.col(column) - F.col("_level") - F.col("_slope") * F.col("i")
    fitted = attach(samples, line, "_n", size)
    return fitted.withColumn(column, flat * taper_weight(F.col("i"), F.col("_n"), F.lit(ratio))).drop("_n", "_slope", "_level")


def to_float32(samples, column="v"):
    return samples.withColumn(column, F.col(column).cast("float"))


def rotate_to_zne(samples, orientation, size=CHUNK):
    """Z, N, E from three oriented channels per trace (trace, channel, i, v).

    ``orientation`` has azimuth and dip (degrees) of each channel. The mix of
    the three components is inverted once per trace; each sample then adds its
    share to the three components. Traces without three channels are left out.
    """
    az, dip = F.radians("azimuth"), F.radians("dip")
    axis = F.struct("channel", (-F.sin(dip)).alias("z"), (F.cos(dip) * F.cos(az)).alias("n"), (F.cos(dip) * F.sin(az)).alias("e"))
    three = orientation.groupBy("trace").agg(F.sort_array(F.collect_set(axis)).alias("x")).where("size(x) = 3")
    three = three.select("trace", "x.channel", *[F.col("x")[k].alias(f"a{k}") for k in range(3)])

    def minor(p, q, r, s):
        return f"(a{p}.{r}*a{q}.{s} - a{q}.{r}*a{p}.{s})"

    # rows of the inverse: what one unit of channel k adds to z, n and e (cofactors over the determinant)
    cofactors = {
        c: [f"{minor((k + 1) % 3, (k + 2) % 3, r, s)}" for k in range(3)] for c, r, s in (("z", "n", "e"), ("n", "e", "z"), ("e", "z", "n"))
    }
    det = " + ".join(f"a{k}.z*{cofactors['z'][k]}" for k in range(3))
    shares = three.selectExpr("trace", "channel as channels", *[f"array({', '.join(f'{x}/({det})' for x in v)}) as to_{c}" for c, v in cofactors.items()])
    lengths = samples.groupBy("trace").agg((F.max("i") + 1).alias("_n"))
    known = attach(with_chunk(samples, size), lengths.join(shares, "trace"), "_n", size)
    place = F.array_position("channels", F.col("channel")).cast("int") - 1
    parts = known.withColumn("_k", place).where("_k >= 0")
    mixed = parts.groupBy("trace", "i").agg(
        *[F.sum(F.col("v") * F.get(f"to_{c}", F.col("_k"))).alias(c) for c in ("z", "n", "e")]
    )
    return mixed.selectExpr("trace", "i", "stack(3, 'Z', z, 'N', n, 'E', e) as (component, v)")


# ---- resampling -----------------------------------------------------------


def lanczos(samples, ratio, a=8, column="v", points=None, size=CHUNK, starts=None):
    """Resample to every ``ratio``-th (a float) old sample with a Blackman-windowed sinc of half-width a.

    ``points`` is an expression of ``n`` (samples of the trace) for the number of
    new samples; ``starts`` (trace, first) says where the first of them lies, in old samples, if not at
    the first old one. Each sample is sent to the few new samples it touches and the
    products are summed, partially before the shuffle.
    """
    points = points or f"cast(floor((n - 1) / {ratio}) as bigint) + 1"
    numbers = lengths(samples)
    numbers = numbers.withColumn("_at", F.lit(0.0)) if starts is None else numbers.join(starts.withColumnRenamed("first", "_at"), "trace")
    counted = attach(samples, numbers, size=size).withColumn("m", F.expr(points)).withColumn("_x", F.col("i") - F.col("_at"))
    first = F.expr(f"greatest(cast(floor((_x - {a}) / {float(ratio)}D) as bigint) + 1, 0)")
    last = F.expr(f"least(cast(ceil((_x + {a}) / {float(ratio)}D) as bigint) - 1, m - 1)")
    spread = counted.withColumn("j", F.explode(F.when(first <= last, F.sequence(first, last)))).withColumn(
        "x", F.col("j") * float(ratio) - F.col("_x")
    )
    px = F.lit(np.pi) * F.col("x")
    sinc = F.when(F.col("x") == 0, 1.0).otherwise(F.sin(px) / px)
    window = 0.42 + 0.5 * F.cos(px / a) + 0.08 * F.cos(2 * px / a)
    summed = spread.groupBy("trace", F.col("j").alias("i")).agg(F.sum(F.col(column) * sinc * window).alias(column))
    return with_chunk(summed, size)


# ---- recursive filters ----------------------------------------------------


def sections_filter(samples, sections, column="v", size=CHUNK):
    """Causal filter by second-order sections, exact over chunk borders.

    Every chunk is filtered from a zero state for its final state; the states
    are chained over the chunks of a trace (one small row per chunk); then each
    chunk is filtered again from its true state. Input and result are written
    tables: both are read more than once, and a chain of filters would otherwise
    repeat its whole past at every step.
    """
    width = min(64, size)
    if size % width:
        raise ValueError("chunk size must be a multiple of 64")
    m = 2 * len(sections)
    f = kernels.BlockFilter(sections, width)  # made once; its matrices go to the tasks

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def final_state(x: pd.Series) -> pd.Series:
        return pd.Series([f.run(v, np.zeros(m))[1].tolist() for v in x])

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def filtered(x: pd.Series, state: pd.Series) -> pd.Series:
        return pd.Series([f.run(v, s)[0] for v, s in zip(x, state)])

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def chain(ends: pd.Series) -> pd.Series:
        out = []
        for own in ends:  # the final states of one trace's chunks, in order
            states = [np.zeros(m)]
            for end in own[:-1]:
                states.append(f.after(size, states[-1]) + np.asarray(end))
            out.append([state.tolist() for state in states])
        return pd.Series(out)

    packed = materialise(blocks(samples, [column]), "filter-blocks")
    ends = packed.select("trace", "chunk", final_state(column).alias("state"))
    per_trace = ends.groupBy("trace").agg(F.sort_array(F.collect_list(F.struct("chunk", "state"))).alias("p"))
    begun = per_trace.select("trace", F.explode(F.arrays_zip(F.col("p.chunk").alias("chunk"), chain("p.state").alias("state"))).alias("z"))
    stated = packed.join(begun.select("trace", "z.chunk", "z.state"), ["trace", "chunk"])
    out = stated.select("trace", "chunk", "lo", F.posexplode(filtered(column, "state")).alias("p", column))
    return materialise(out.select("trace", "chunk", (F.col("lo") + F.col("p")).cast("bigint").alias("i"), column), "filtered")


def reverse(samples, size=CHUNK):
    """Same trace read from its end."""
    n = lengths(samples).withColumnRenamed("n", "_n")
    turned = attach(samples, n, "_n", size).withColumn("i", (F.col("_n") - 1 - F.col("i")).cast("bigint")).drop("_n")
    return with_chunk(turned, size)


def bandpass(samples, min_period, max_period, dt=1.0, column="v", size=CHUNK):
    """Third-order Butterworth over [1/max_period, 1/min_period], causal."""
    return sections_filter(samples, kernels.bandpass_sections(1 / max_period, 1 / min_period, 1 / dt), column, size)


def double_bandpass(samples, min_period, max_period, dt=1.0, column="v", size=CHUNK):
    """Detrend, taper and band-pass, twice."""
    for _ in range(2):
        samples = detrend_taper(samples, 0.05, column, size)
        samples = bandpass(samples, min_period, max_period, dt, column, size)
    return samples


def zero_phase_lowpass(samples, corner, dt=1.0, column="v", size=CHUNK):
    sections = kernels.lowpass_sections(corner, 1 / dt)
    forward = sections_filter(samples, sections, column, size)
    return reverse(sections_filter(reverse(forward, size), sections, column, size), size)


def decimate(samples, dt, dt_new, column="v", size=CHUNK):
    """Down-sample in steps of at most 8, each after a zero-phase low-pass; returns samples and their dt."""
    while True:
        factor = min(8, int(dt_new / dt))
        if factor <= 1:
            return samples, dt
        low = zero_phase_lowpass(samples, 0.5 / dt / factor, dt, column, size)
        samples = with_chunk(low.where(F.col("i") % factor == 0).withColumn("i", (F.col("i") / factor).cast("bigint")), size)
        dt *= factor


def preprocess(samples, dt, dt_new, min_period, max_period, npts=None, a=12, size=CHUNK):
    """Decimate, detrend, taper, band-pass twice, resample to dt_new (``npts`` samples, or all of the trace), store as float."""
    samples, dt = decimate(samples, dt, dt_new, size=size)
    samples = detrend_taper(samples, size=size)
    samples = double_bandpass(samples, min_period, max_period, dt, size=size)
    return to_float32(lanczos(samples, dt_new / dt, a, points=npts and str(npts), size=size))


def trim_in_time(samples, headers, before=0.2, size=CHUNK):
    """Samples within the span of each trace and ``before`` of its length on either side, renumbered from 0.

    ``headers`` has t0, dt and the span (lo, hi), all in seconds, per trace. Returns the samples and (trace, t0) of the cut.
    """
    edge = before * (F.col("hi") - F.col("lo"))
    low = F.greatest(F.ceil((F.col("lo") - edge - F.col("t0")) / F.col("dt") - 1e-9), F.lit(0)).cast("bigint")
    high = F.floor((F.col("hi") + edge - F.col("t0")) / F.col("dt") + 1e-9).cast("bigint")
    spans = headers.select("trace", low.alias("_low"), high.alias("_high"), (F.col("t0") + low * F.col("dt")).alias("t0"))
    known = attach(samples, lengths(samples).withColumnRenamed("n", "_n").join(spans.drop("t0"), "trace"), "_n", size)
    kept = known.where("i between _low and _high").withColumn("i", F.col("i") - F.col("_low")).drop("_low", "_high", "_n")
    return with_chunk(kept, size), spans.select("trace", "t0")


def source_pulse(per_trace, min_period, max_period, dt=1.0, size=CHUNK):
    """Band-limited unit step of n samples per row of ``per_trace`` (trace, n); its first sample is 0."""
    step = index_rows(per_trace.select("trace", "n"), "2 * n", size=size)
    step = with_chunk(step.withColumn("v", F.when(F.col("i") < F.col("n"), 0.0).otherwise(1.0)), size).drop("n")
    pulse = attach(double_bandpass(step, min_period, max_period, dt, size=size), per_trace.withColumn("_n", 2 * F.col("n")), "_n", size)
    late = pulse.where("i >= n").withColumn("i", (F.col("i") - F.col("n")).cast("bigint"))
    return with_chunk(late.withColumn("v", F.when(F.col("i") == 0, 0.0).otherwise(F.col("v"))).select("trace", "i", "v"), size)


def check_pulse(pulse, per_trace):
    """The samples of a source pulse of one's own; a trace without exactly n samples from 0, or whose first is not 0, stops the job."""
    seen = pulse.groupBy("trace").agg(F.count("*").alias("_n"), F.min_by("v", "i").alias("_first"), F.min("i").alias("_at"))
    good = (F.col("_n") == F.col("n")) & (F.col("_first") == 0) & (F.col("_at") == 0)
    checked = per_trace.select("trace", "n").join(seen, "trace", "left").withColumn(
        "n", F.when(good, F.col("n")).otherwise(F.raise_error(F.lit("a source pulse needs n samples, the first of them 0")).cast("bigint"))
    )
    return attach(pulse, checked.select("trace", "n")).drop("n")


# ---- envelope -------------------------------------------------------------


def hilbert(samples, columns, size=CHUNK):
    """Adds h_<c>: the Hilbert transform of each column over the whole trace."""
    found = fourier.transform(samples, columns, fourier.Hilbert(columns), size)
    return samples.join(with_chunk(found, size), ["trace", "chunk", "i"])


def envelope(samples, columns=("v",), size=CHUNK):
    """Adds env_<c>: the modulus of the analytic signal."""
    with_h = hilbert(samples, list(columns), size)
    for c in columns:
        with_h = with_h.withColumn(f"env_{c}", F.hypot(c, f"h_{c}")).drop(f"h_{c}")
    return with_h
