"""Automatic selection of time windows in which data and synthetics agree."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seispark.functions import kernels
from seispark.functions.columns import required
from seispark.operators import traces
from seispark.operators.chunks import (
    CHUNK, attach, blocks, by_chunk, in_ranges, index_rows, nearest, owned, runs, sibling, with_halo,
)
from seispark.session import materialise


@dataclass(frozen=True)
class Settings:
    """Thresholds; periods and dt in seconds, velocity in km/s."""

    min_period: float
    max_period: float
    dt: float = 1.0
    min_cc: float = 0.10
    max_noise: float = 0.10
    max_noise_window: float = 0.4
    min_velocity: float = 2.4
    threshold_shift: float = 0.30
    threshold_correlation: float = 0.75
    min_length_period: float = 1.5
    min_peaks_troughs: int = 2
    max_energy_ratio: float = 10.0
    min_envelope_similarity: float = 0.2
    enforce_window_noise: bool = False

    @property
    def width(self):
        n = int(round(2 * self.min_period / self.dt))
        return n + 1 if n % 2 == 0 else n

    @property
    def stride(self):
        n = int(0.05 * self.width)
        return max(n + 1 if n % 2 == 0 else n, 1)

    @property
    def shortest(self):
        return min(self.min_period / self.dt * self.min_length_period, self.max_period / self.dt)

    @property
    def min_distance(self):
        return 2 * self.min_period * self.min_velocity


def first_arrival(pair, stats, size=CHUNK):
    """First index where the synthetic exceeds 0.5 % of its largest value."""
    top = attach(pair, stats.select("trace", "n", "max_s"), size=size)
    return top.where(F.abs("s") > 5e-3 * F.col("max_s")).groupBy("trace").agg(F.min("i").alias("first"))


def noise_level(pair, arrivals, stats, size=CHUNK):
    """Largest data value before 0.9 of the first arrival, absolute and relative."""
    end = F.greatest(F.floor(0.9 * F.col("first")), F.lit(1))
    known = stats.select("trace", "n", "max_d").join(arrivals, "trace")
    early = attach(pair, known, size=size).where(F.col("i") < end)
    noise = early.groupBy("trace").agg(F.max(F.abs("d")).alias("noise"), F.first("max_d").alias("max_d"))
    return noise.select("trace", "noise", (F.col("noise") / F.col("max_d")).alias("noise_relative"))


def rejection(s):
    """Why a trace is rejected, or null; of several reasons the last counts."""
    return (
        F.when(F.col("dist_km") < s.min_distance, "distance")
        .when(F.col("noise_relative") > s.max_noise, "noise")
        .when((F.col("cc") < s.min_cc) & (F.col("noise_relative") > s.max_noise / 3), "correlation")
    )


def accept_traces(pair, distances, s, size=CHUNK):
    """Trace numbers with ``first``, ``noise_relative`` and ``reason`` (null: accepted).

    Silent traces are left out; a trace without a distance stops the job.
    """
    stats = traces.trace_stats(pair).where("max_d > 0 and max_s > 0")
    arrivals = first_arrival(pair, stats, size)
    noise = noise_level(pair, arrivals, stats, size)
    full = stats.join(arrivals, "trace").join(noise, "trace").join(distances, "trace", "left")
    return full.withColumn("dist_km", required("dist_km", "the distance of a trace")).withColumn("reason", rejection(s))


def pulse_width(pulse, size=CHUNK):
    """Per source pulse: index of the envelope's peak plus the samples until it falls below half of it."""
    env = traces.envelope(pulse, ["v"], size)
    peak = env.groupBy("trace").agg(F.count("*").alias("n"), F.max("env_v").alias("top"), F.max_by("i", F.struct("env_v", -F.col("i"))).alias("peak"))
    after = attach(env, peak, size=size).where("i >= peak and env_v < 0.5 * top").groupBy("trace").agg(F.min("i").alias("below"))
    return peak.join(after, "trace", "left").select("trace", F.coalesce("below", "peak").alias("pulse"))


def travel_bounds(accepted, s, pulse=0, global_mode=False):
    """min_idx and max_idx: usable samples lie strictly above the one and below the other.

    ``pulse`` is the width of the source pulse in samples, a number or a column that came with the distances.
    """
    slowest = F.ceil((F.col("dist_km") / s.min_velocity + s.min_period / 2) / s.dt) + pulse
    return accepted.withColumn("min_idx", F.greatest(F.col("first") - int(s.min_period / s.dt), F.lit(0))).withColumn(
        "max_idx", F.col("n") if global_mode else slowest
    )


def hop_windows(lengths, s):
    """start, stop, mid of the overlapping windows of each trace (trace, n)."""
    hops = index_rows(lengths.select("trace", "n"), f"if(n >= {s.width}, (n - {s.width}) div {s.stride} + 1, 0)", "hop")
    return hops.withColumn("start", F.col("hop") * s.stride).select(
        "trace", "start", (F.col("start") + s.width).alias("stop"), (F.col("start") + s.width // 2).alias("mid")
    )


def sliding_correlation(pair, s, size=CHUNK):
    """Adds per sample the lag (in periods) and the correlation of the hop window around it.

    ``pair`` carries n, ptp_s, min_idx and max_idx of its trace. Samples no hop
    covers have nulls; hops without energy have ``energetic`` false; ``in_time``
    says that the sample itself lies between the bounds. A chunk with
    its halo of half a window is one array, and one step of a vectorised call.
    """
    wl, stride, half, h = s.width, s.stride, (s.stride - 1) // 2, s.width // 2
    taper = np.hanning(wl)
    numbers = ["n", "ptp_s", "min_idx", "max_idx"]

    def slide(d, y, first, own, n, ptp, lo, hi):
        """(shift, cc, covered, energetic, in_time) of the samples ``own`` of a block that starts at index ``first``."""
        d, y = np.asarray(d), np.asarray(y)
        start = (own - h + half) // stride * stride
        mid = start + h
        ok = (start >= 0) & (start + wl <= n) & (mid > lo) & (mid < hi)
        shift, cc, energetic = np.full(len(own), np.nan), np.full(len(own), np.nan), np.zeros(len(own), bool)
        if ok.any():
            hops, back = np.unique(start[ok], return_inverse=True)
            a = np.lib.stride_tricks.sliding_window_view(d, wl)[hops - first] * taper
            b = np.lib.stride_tricks.sliding_window_view(y, wl)[hops - first] * taper
            loud = np.ptp(b, axis=1) >= 0.001 * ptp
            c = kernels.full_correlation(a, b)
            scale = np.sqrt((b**2).sum(axis=1) * (a**2).sum(axis=1))
            with np.errstate(divide="ignore", invalid="ignore"):
                top = c.max(axis=1) / scale
            shift[ok] = np.where(loud, (kernels.first_largest(c, scale) - wl + 1) * s.dt / s.min_period, np.nan)[back]
            cc[ok] = np.where(loud, top, np.nan)[back]
            energetic[ok] = loud[back]
        return shift, cc, ok, energetic, (own > lo) & (own < hi)

    doubles, flags = T.ArrayType(T.DoubleType()), T.ArrayType(T.BooleanType())
    result = T.StructType().add("shift", doubles).add("cc", doubles).add("covered", flags).add("energetic", flags).add("in_time", flags)

    @F.pandas_udf(result)
    def slid(d: pd.Series, y: pd.Series, first: pd.Series, chunk: pd.Series, n: pd.Series, ptp: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
        rows = []
        for x, z, at, c, count, span, low, high in zip(d, y, first, chunk, n, ptp, lo, hi):
            own = np.arange(c * size, min((c + 1) * size, count))
            rows.append(slide(x, z, at, own, count, span, low, high))
        return pd.DataFrame(rows, columns=result.names)

    edged = with_halo(pair.select("trace", "i", "d", "s", *numbers), h + half, h + half, size).where(f"chunk <= (n - 1) div {size}")
    packed = blocks(edged, ["d", "s"], extra=numbers)
    out = packed.withColumn("r", slid("d", "s", "lo", "chunk", *numbers))
    zipped = out.select("trace", "chunk", F.posexplode(F.arrays_zip(*[f"r.{c}" for c in result.names])).alias("p", "z"))
    return zipped.select(
        "trace", "chunk", (F.col("p") + F.col("chunk") * size).cast("bigint").alias("i"),
        *[F.when(~F.isnan(F.col("z")[c]), F.col("z")[c]).alias(c) for c in ("shift", "cc")],
        *[F.col(f"z.{c}").alias(c) for c in ("covered", "energetic", "in_time")],
    )


def shift_jumps(slid, s, size=CHUNK):
    """Adds ``jump``: a change of the lag by more than 0.1 period lies within the buffer."""
    b = int(np.ceil(s.min_period / s.dt * 0.1))
    edged = with_halo(slid, b - 1, b + 1, size)
    leap = F.abs(F.lead("shift").over(by_chunk()) - F.col("shift")) > 0.1
    near = by_chunk().rowsBetween(-(b - 1), b)
    return owned(
        edged.withColumn("_leap", F.coalesce(leap, F.lit(False))).withColumn("jump", F.max("_leap").over(near)).drop("_leap")
    )


def envelope_ratio(pair, s, size=CHUNK):
    """Adds ``ratio``: smaller by larger envelope, both clipped from below."""
    env = traces.envelope(pair, ["d", "s"], size)
    tops = env.groupBy("trace").agg(F.count("*").alias("_n"), F.max("env_d").alias("_td"), F.max("env_s").alias("_ts"))
    floor = s.min_envelope_similarity * 0.5
    clipped = attach(env, tops, "_n", size).withColumns(
        {"_a": F.greatest("env_d", F.col("_td") * floor), "_b": F.greatest("env_s", F.col("_ts") * floor)}
    )
    return clipped.withColumn("ratio", F.least("_a", "_b") / F.greatest("_a", "_b")).drop("_n", "_td", "_ts", "_a", "_b", "env_d", "env_s")


def keep_long(ranges, s):
    return ranges.where(F.col("stop") - F.col("start") >= s.shortest)


# ---- extrema and marching -------------------------------------------------


def extrema(series, ranges, size=CHUNK):
    """Peaks and troughs (trace, i, peak) of each range of a series.

    ``series`` is (trace, i, v), contiguous over [lo, hi); ``ranges`` is (trace,
    lo, hi). A flat top or bottom counts at its first sample. The ends are added
    so that peaks and troughs alternate; a series without any extremum has none.
    """
    edged = with_halo(series.select("trace", "i", "v"), 1, 0, size)
    steps = owned(edged.withColumn("prev", F.lag("v").over(by_chunk()))).where("v <> prev").withColumn("up", F.expr("v > prev"))
    inner = sibling(steps.select("trace", "chunk", "i", "up"), ["up"], "next").where("up <> next.up").select(
        "trace", "i", F.col("up").alias("peak")
    )
    inner = materialise(inner, "extrema")
    sides = inner.groupBy("trace").agg(
        F.min(F.when(F.col("peak"), F.col("i"))).alias("p0"),
        F.min(F.when(~F.col("peak"), F.col("i"))).alias("t0"),
        F.max(F.when(F.col("peak"), F.col("i"))).alias("p1"),
        F.max(F.when(~F.col("peak"), F.col("i"))).alias("t1"),
    )
    ends = sides.join(ranges, "trace").select(
        "trace",
        F.explode(
            F.expr(
                "array(struct(lo as i, p0 is null or coalesce(t0 < p0, false) as peak),"
                "struct(hi - 1 as i, p1 is null or coalesce(p1 < t1, false) as peak))"
            )
        ).alias("e"),
    )
    return inner.unionByName(ends.select("trace", F.col("e.i").cast("bigint").alias("i"), "e.peak"))


def _both_series(pair, ranges, size):
    """Data and synthetic of each range as series of their own; key (trace, lo, synthetic)."""
    inside = in_ranges(pair.select("trace", "chunk", "i", "d", "s"), ranges.select("trace", "start", "stop"), size=size)
    stacked = inside.selectExpr(
        "trace as t", "start", "stop", "i", "stack(2, false, d, true, s) as (synthetic, v)"
    ).selectExpr("struct(t, start as lo, stop as hi, synthetic) as trace", "i", "v")
    keys = ranges.select(
        F.explode(F.array(F.lit(False), F.lit(True))).alias("synthetic"), F.col("trace").alias("t"), "start", "stop"
    ).selectExpr("struct(t, start as lo, stop as hi, synthetic) as trace", "start as lo", "stop as hi")
    return stacked, keys


def range_extrema(pair, ranges, size=CHUNK):
    """(t, lo, hi, synthetic, i, peak) of data and synthetics inside each range."""
    series, keys = _both_series(pair, ranges, size)
    return extrema(series, keys, size).select("trace.t", "trace.lo", "trace.hi", "trace.synthetic", "i", "peak")


def march(found, size=CHUNK):
    """Ranges (trace, start, stop) where successive synthetic extrema match successive data extrema.

    ``found`` is the result of range_extrema. Each synthetic extremum is matched
    with the nearest data extremum of its kind; where the match moves on by
    exactly one, the stretch from the previous to the next synthetic extremum stays.
    """
    found = materialise(found, "extrema-all")
    seq = F.struct("t", "lo", "hi", "peak").alias("trace")
    data = found.where("not synthetic").select(seq, "i")
    synthetic = found.where("synthetic").select(seq, "i")
    matched = materialise(nearest(data, synthetic, size), "extrema-matched")
    linked = sibling(sibling(matched, ["i", "match"], "next"), ["i"], "prev", after=False)
    kept = linked.where("next.match - match = 1")
    return kept.selectExpr("trace.t as trace", "coalesce(prev.i, trace.lo) as start", "next.i as stop")


def merge_ranges(pair, ranges, size=CHUNK):
    """Union of overlapping ranges as maximal runs."""
    return runs(in_ranges(pair.select("trace", "chunk", "i"), ranges, "left_semi", size=size), size)


def enough_extrema(pair, ranges, s, size=CHUNK):
    """Ranges in which data and synthetics both have enough peaks and troughs."""
    counts = range_extrema(pair, ranges, size).groupBy("t", "lo", "hi").agg(
        *[
            F.count(F.when((F.col("synthetic") == syn) & (F.col("peak") == peak), 1)).alias(f"c{int(syn)}{int(peak)}")
            for syn in (False, True)
            for peak in (False, True)
        ]
    )
    return counts.where(F.least("c00", "c01", "c10", "c11") >= s.min_peaks_troughs).selectExpr("t as trace", "lo as start", "hi as stop")


def balanced_energy(pair, ranges, s, noise=None, size=CHUNK):
    """Ranges whose larger energy is at most max_energy_ratio times the smaller one.

    With ``enforce_window_noise`` ranges that are not clearly above the noise of
    their trace are dropped as well; by default they stay.
    """
    inside = in_ranges(pair.select("trace", "chunk", "i", "d", "s"), ranges.select("trace", "start", "stop"), size=size)
    energy = inside.groupBy("trace", "start", "stop").agg(
        F.sum(F.col("d") * F.col("d")).alias("ed"), F.sum(F.col("s") * F.col("s")).alias("es"), (F.max("d") - F.min("d")).alias("ptp")
    )
    good = energy.where(F.greatest("ed", "es") <= s.max_energy_ratio * F.least("ed", "es"))
    if s.enforce_window_noise:
        good = good.join(noise.select("trace", "noise"), "trace").where(F.col("noise") / F.col("ptp") <= s.max_noise_window)
    return good.select("trace", "start", "stop", "ed", "es")


def index_to_time(ranges, dt):
    """Adds t_start, t_end (timestamps from t0) and weight 1."""

    def at(i):
        return F.timestamp_micros(F.unix_micros("t0") + (F.col(i) * dt * 1e6).cast("bigint"))

    return ranges.withColumns({"t_start": at("start"), "t_end": at("stop"), "weight": F.lit(1.0)})


def valid_samples(pair, bounds, s, size=CHUNK):
    """Samples that pass the travel-time, correlation, lag, jump and envelope tests."""
    numbers = bounds.select("trace", "n", "ptp_s", "min_idx", "max_idx")
    slid = shift_jumps(sliding_correlation(attach(pair, numbers, size=size), s, size), s, size)
    good = slid.where(
        F.col("in_time")
        & (F.coalesce("cc", F.lit(0.0)) >= s.threshold_correlation)
        & (F.abs(F.coalesce("shift", F.lit(0.0))) <= s.threshold_shift)
        & ~F.col("jump")
    ).select("trace", "chunk", "i")
    alike = envelope_ratio(attach(pair, bounds.select("trace", "n"), size=size).drop("n"), s, size).where(F.col("ratio") >= s.min_envelope_similarity).select("trace", "chunk", "i")
    return good.join(alike, ["trace", "chunk", "i"], "left_semi")


def select_windows(pair, distances, s, pulse=0, global_mode=False, window_everything=False, size=CHUNK):
    """Windows (trace, start, stop) of all traces; the two costly intermediate results are written tables."""
    accepted = accept_traces(pair, distances, s, size).where("reason is null")
    bounds = travel_bounds(accepted, s, pulse, global_mode)
    if window_everything:
        return bounds.selectExpr("trace", "cast(min_idx as bigint) as start", "cast(max_idx as bigint) as stop")
    bounds = materialise(bounds, "window-bounds")
    valid = runs(valid_samples(pair, bounds, s, size), size)
    valid = materialise(keep_long(valid, s), "window-runs")
    marched = merge_ranges(pair, march(range_extrema(pair, valid, size), size), size)
    marched = materialise(marched, "window-marched")
    counted = keep_long(enough_extrema(pair, marched, s, size), s)
    return balanced_energy(pair, counted, s, bounds if s.enforce_window_noise else None, size).select("trace", "start", "stop")


def mark_flat(series, found):
    """Extrema (trace, i, peak) with ``flat``: the next sample has the same value."""
    edged = with_halo(series.select("trace", "i", "v"), 0, 1)
    flat = owned(edged.withColumn("flat", F.lead("v").over(by_chunk()) == F.col("v"))).select("trace", "i", "flat")
    return found.join(flat, ["trace", "i"])
