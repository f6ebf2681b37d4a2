"""Gabor transforms and the time-frequency phase misfit.

A transform of n samples is n spectra of n numbers. The window positions of a series are cut into blocks, and a
block meets only the samples its Gaussians reach (where they are above 2**-53 of their top): a halo join, after
which spectra come from zero padding, some positions at a time. A spectrum is cheaper to compute again than to keep,
so the misfit goes over the blocks three times: for the largest size, for the numbers that can be merged
once it is known (largest weights, sums scaled later), and for jumps and adjoint signal. A series of one small block
is done in one pass.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seispark.functions import kernels
from seispark.operators.chunks import attach, blocks, with_chunk, with_halo
from seispark.operators.fourier import _lists as lists
from seispark.operators.traces import lanczos
from seispark.session import materialise

#: Widths from a Gaussian's middle to where it falls below 2**-53 of its top.
REACH = 8.6
#: Cells that are worked on at once.
CELLS = 1 << 20
DOUBLES = T.ArrayType(T.DoubleType())


def reach_of(width, dt):
    return int(np.ceil(REACH * width / dt))


def block_size(width, dt):
    """Positions of a block: a power of two, at least the Gaussian's reach, so that a sample is in three blocks at most."""
    return 1 << max(8, (reach_of(width, dt) - 1).bit_length())


def series_blocks(samples, columns, width, dt):
    """One row per series and block of window positions (chunk): n, largest sizes of the columns, and from index lo the samples that the windows reach."""
    reach, size = reach_of(width, dt), block_size(width, dt)
    tops = samples.groupBy("trace").agg(F.count("*").alias("n"), *[F.max(F.abs(c)).alias(f"top_{c}") for c in columns])
    known = attach(with_chunk(samples.select("trace", "i", *columns), size), tops, "n", size)
    edged = with_halo(known, reach, reach + 1, size).where(f"chunk <= (n - 1) div {size}")
    return blocks(edged, columns, extra=["n", *[f"top_{c}" for c in columns]])


def steps(first, last, n):
    """Positions first .. last-1 in steps of at most CELLS cells."""
    width = max(1, CELLS // n)
    return [np.arange(k, min(k + width, last)) for k in range(first, last, width)]


def _spectra(rows, columns, size, compute):
    """(trace, n, k, re, im) of all positions of the blocks, a few rows at a time; ``top`` of the rows is kept if they have it."""
    trace, tops = T.StructField("trace", rows.schema["trace"].dataType), [c for c in rows.columns if c == "top"]
    schema = T.StructType([trace, T.StructField("n", T.LongType()), T.StructField("k", T.IntegerType()), T.StructField("re", DOUBLES), T.StructField("im", DOUBLES)])
    for c in tops:
        schema = schema.add(c, T.DoubleType())

    def work(batches):
        for batch in batches:
            values = [lists(batch.column(c)) for c in columns]
            numbers = zip(*[batch.column(c).to_pylist() for c in ("chunk", "lo", "n", f"top_{columns[0]}")])
            for row, (chunk, lo, n, top) in enumerate(numbers):
                for ks in steps(chunk * size, min((chunk + 1) * size, n), n):
                    z = compute(*[v[row] for v in values], lo, n, ks, top)
                    ends = pa.array(np.arange(0, len(ks) * n + 1, n, dtype=np.int32))
                    parts = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(x).ravel())) for x in (z.real, z.imag)]
                    names, *largest = (batch.column(c).take(pa.array(np.full(len(ks), row))) for c in ["trace", *tops])
                    yield pa.RecordBatch.from_arrays([names, pa.array(np.full(len(ks), n)), pa.array(ks.astype(np.int32)), *parts, *largest], [f.name for f in schema])

    return rows.mapInArrow(work, schema)


def gabor(samples, width, dt=1.0, column="s", threshold=1e-2, tops=False):
    """(trace, n, k, re, im): spectra of the signal under a Gaussian window at every sample k.

    With ``tops`` also ``top``, the largest size in all spectra of the trace: a pass over the blocks of its own finds it, so
    that it meets blocks of samples and not the spectra, which are far larger.
    """
    size = block_size(width, dt)

    def compute(v, lo, n, ks, top):
        return kernels.gabor_rows(v, lo, n, ks, width, dt, top, threshold)

    @F.pandas_udf(T.DoubleType())
    def largest_size(v: pd.Series, lo: pd.Series, n: pd.Series, chunk: pd.Series, top: pd.Series) -> pd.Series:
        blocks = zip(v, lo, n, chunk, top)
        return pd.Series([np.max([np.abs(compute(x, at, count, ks, t)).max() for ks in steps(c * size, min((c + 1) * size, count), count)]) for x, at, count, c, t in blocks])

    rows = series_blocks(samples, [column], width, dt)
    if tops:
        rows = materialise(rows, "series")
        level = rows.select("trace", largest_size(column, "lo", "n", "chunk", f"top_{column}").alias("size")).groupBy("trace")
        # a size that is no number comes back as null, and is the largest
        rows = rows.join(level.agg(F.when(F.count("size") == F.count("*"), F.max("size")).otherwise(float("nan")).alias("top")), "trace")
    return _spectra(rows, [column], size, compute)


def correlation_spectra(samples, width, dt=1.0, threshold=1e-2):
    """(trace, n, k, re, im): spectra of the correlation of windowed d and s; n is odd."""

    def compute(d, s, lo, n, ks, top):
        return kernels.correlation_rows(d, s, lo, n, ks, width, dt, top, threshold)

    return _spectra(series_blocks(samples, ["d", "s"], width, dt), ["d", "s"], block_size(width, dt), compute)


def inverse(spectra, width, dt=1.0, threshold=1e-2):
    """Signal (trace, i, re, im) from spectra: inverse transform per row, then a Gaussian-weighted sum over the rows.

    Rows are summed up by blocks of positions within a batch first, so only what a block's Gaussians reach is shuffled.
    Spectra that have the largest size of their trace as ``top`` are read once and not shuffled.
    """
    reach, block = reach_of(width, dt), block_size(width, dt)
    trace = T.StructField("trace", spectra.schema["trace"].dataType)
    schema = T.StructType([trace, T.StructField("i", T.LongType()), T.StructField("re", T.DoubleType()), T.StructField("im", T.DoubleType())])

    def work(batches):
        for batch in batches:
            known, sums = {}, {}
            ids = batch.column("trace").dictionary_encode().indices.to_numpy() if not pa.types.is_nested(batch.column("trace").type) else np.arange(len(batch))
            numbers = zip(ids.tolist(), batch.column("k").to_pylist(), batch.column("top").to_pylist(), lists(batch.column("re")), lists(batch.column("im")))
            for row, (own, k, top, re, im) in enumerate(numbers):
                z = re + 1j * im
                if np.abs(z).max() < top * threshold:
                    continue
                n, first = len(z), max(k // block * block - reach, 0)
                last = min((k // block + 1) * block + reach, n)
                key = own, k // block
                if key not in sums:
                    known[key], sums[key] = (row, first), np.zeros(last - first, complex)
                at = np.arange(max(k - reach, 0), min(k + reach + 1, n))
                sums[key][at - first] += np.fft.ifft(z)[at] * kernels.gaussian((at - k) * dt, width) * np.sqrt(2 * np.pi) * dt
            for key, x in sums.items():
                row, first = known[key]
                names = batch.column("trace").take(pa.array(np.full(len(x), row)))
                yield pa.RecordBatch.from_arrays([names, pa.array(first + np.arange(len(x))), pa.array(x.real.copy()), pa.array(x.imag.copy())], [f.name for f in schema])

    if "top" not in spectra.columns:
        size = F.array_max(F.transform(F.arrays_zip("re", "im"), lambda z: F.hypot(z["re"], z["im"])))
        spectra = spectra.join(spectra.groupBy("trace").agg(F.max(size).alias("top")), "trace")
    parts = spectra.select("trace", "k", "top", "re", "im").mapInArrow(work, schema)
    return parts.groupBy("trace", "i").agg(F.sum("re").alias("re"), F.sum("im").alias("im"))


def cells(spectra):
    """One row per (trace, k, l)."""
    return spectra.select(
        *[c for c in spectra.columns if c not in ("re", "im")], F.posexplode(F.arrays_zip("re", "im")).alias("l", "z")
    ).select("*", "z.re", "z.im").drop("z")


def _grid(samples, min_period, dt):
    """Both signals on a grid of a quarter period (but no finer than dt) with an odd number of points."""
    step = max(float(int(min_period / 4.0)), dt)
    points = f"cast(floor((n - 1) / {step / dt}D + 1e-7) as bigint) + 1"
    odd = f"({points}) - 1 + ({points}) % 2"
    chunked = with_chunk(samples)
    new_d, new_s = (lanczos(chunked, step / dt, 8, c, odd) for c in ("d", "s"))
    return materialise(new_d.join(new_s.drop("chunk"), ["trace", "i"]), "tf-grid"), step


def phase_misfit(samples, min_period, max_period, dt=1.0, max_criterion=7, threshold=1e-2):
    """Misfit per series (trace, plain, jumps, misfit) and its adjoint samples (trace, i, a).

    Where the phase jumps too often the misfit counts twice and the adjoint source is zero.
    """
    grid, step = _grid(samples, min_period, dt)
    width = 2.0 * min_period
    size = block_size(width, step)
    rows = materialise(series_blocks(grid, ["d", "s"], width, step), "tf-series")

    def cells_of(d, s, lo, n, ks, top, m):
        """Phase and weight (not yet normalised) of the cells at the positions ks."""
        c = kernels.correlation_rows(d, s, lo, n, ks, width, step, top, threshold)
        return np.angle(c), kernels.phase_weights(c, m, min_period, max_period, step)

    def kernel_of(s, lo, n, ks, top_s, m, phase, raw):
        """Adjoint spectra of the positions ks, not yet divided by the square of the largest weight."""
        synthetic = kernels.gabor_rows(s, lo, n, ks, width, step, top_s, threshold)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.nan_to_num(raw**2 * phase * synthetic / (m + np.abs(synthetic) ** 2))

    def signal_of(weighted, z, at, count, ks, lead, largest, loud):
        """Jumps and adjoint samples of the positions ks; ``weighted`` has ``lead`` positions before them."""
        field = weighted / largest if largest > 0 else np.zeros(weighted.shape)
        jumps = (np.abs(np.diff(field, axis=0)) > 0.7).sum() + (np.abs(np.diff(field[lead:], axis=1)) > 0.7).sum()
        keep = np.abs(z).max(axis=1) >= loud * threshold
        g = kernels.gaussian((at + np.arange(count) - ks[keep, None]) * step, width)
        return jumps, (np.fft.ifft(z[keep], axis=1).imag[:, at : at + count] * g).sum(axis=0)

    def positions(chunk, n):
        return steps(chunk * size, min((chunk + 1) * size, n), n)

    @F.pandas_udf(T.DoubleType())
    def largest_size(d: pd.Series, s: pd.Series, lo: pd.Series, n: pd.Series, chunk: pd.Series, top: pd.Series) -> pd.Series:
        out = []
        for x, y, at, count, c, t in zip(d, s, lo, n, chunk, top):
            out.append(max(np.abs(kernels.correlation_rows(x, y, at, count, ks, width, step, t, threshold)).max() for ks in positions(c, count)))
        return pd.Series(out)

    @F.pandas_udf(T.StructType().add("w", T.DoubleType()).add("x", T.DoubleType()).add("z", T.DoubleType()).add("total", T.DoubleType()))
    def mergeable(d: pd.Series, s: pd.Series, lo: pd.Series, n: pd.Series, chunk: pd.Series, top: pd.Series, top_s: pd.Series, m: pd.Series) -> pd.DataFrame:
        out = []
        for x, y, at, count, c, t, ts, level in zip(d, s, lo, n, chunk, top, top_s, m):
            most, total = np.zeros(3), 0.0
            for ks in positions(c, count):
                phase, raw = cells_of(x, y, at, count, ks, t, level)
                z = kernel_of(y, at, count, ks, ts, level, phase, raw)
                most = np.maximum(most, [raw.max(), np.abs(raw * phase).max(), np.abs(z).max()])
                total += ((raw * phase) ** 2).sum()
            out.append((*most, total))
        return pd.DataFrame(out, columns=["w", "x", "z", "total"])

    @F.pandas_udf(T.StructType().add("jumps", T.LongType()).add("a", DOUBLES))
    def signals(
        d: pd.Series, s: pd.Series, lo: pd.Series, n: pd.Series, chunk: pd.Series, top: pd.Series, top_s: pd.Series, m: pd.Series, x_top: pd.Series, z_top: pd.Series
    ) -> pd.DataFrame:
        out = []
        for x, y, at, count, c, t, ts, level, largest, loud in zip(d, s, lo, n, chunk, top, top_s, m, x_top, z_top):
            jumps, a = 0, np.zeros(len(x))
            for ks in positions(c, count):
                lead = 1 if ks[0] > 0 else 0  # one position before, for the step between blocks
                phase, raw = cells_of(x, y, at, count, np.arange(ks[0] - lead, ks[-1] + 1), t, level)
                z = kernel_of(y, at, count, ks, ts, level, phase[lead:], raw[lead:])
                more, part = signal_of(raw * phase, z, at, len(x), ks, lead, largest, loud)
                jumps, a = jumps + more, a + part
            out.append((int(jumps), a * np.sqrt(2 * np.pi) * step))
        return pd.DataFrame(out, columns=["jumps", "a"])

    tops = T.StructType()
    for c in "m", "w", "x", "z", "total":
        tops = tops.add(c, T.DoubleType())

    @F.pandas_udf(tops.add("jumps", T.LongType()).add("a", DOUBLES))
    def at_once(d: pd.Series, s: pd.Series, lo: pd.Series, n: pd.Series, top: pd.Series, top_s: pd.Series) -> pd.DataFrame:
        out = []
        for x, y, at, count, t, ts in zip(d, s, lo, n, top, top_s):
            ks = np.arange(count)
            c = kernels.correlation_rows(x, y, at, count, ks, width, step, t, threshold)
            m = np.abs(c).max() / 10
            phase, raw = np.angle(c), kernels.phase_weights(c, m, min_period, max_period, step)
            weighted, z = raw * phase, kernel_of(y, at, count, ks, ts, m, phase, raw)
            most = np.maximum(0.0, [raw.max(), np.abs(weighted).max(), np.abs(z).max()])
            jumps, a = signal_of(weighted, z, at, len(x), ks, 0, most[1], most[2])
            out.append((m, *most, (weighted**2).sum(), int(jumps), a * np.sqrt(2 * np.pi) * step))
        return pd.DataFrame(out, columns=["m", "w", "x", "z", "total", "jumps", "a"])

    # a series that is one block and one step is done in one pass
    short = F.expr(f"n <= {size} and n * n <= {CELLS}")
    once = rows.where(short).select("trace", F.col("n").alias("_n"), "lo", at_once("d", "s", "lo", "n", "top_d", "top_s").alias("r"))
    once = materialise(once.select("trace", "_n", "lo", "r.*"), "tf-short")
    rows = rows.where(~short)

    block = ["d", "s", "lo", "n", "chunk", "top_d"]
    level = rows.select("trace", largest_size(*block).alias("size")).groupBy("trace").agg((F.max("size") / 10).alias("m"))
    merged = rows.join(level, "trace").select("trace", "n", "m", mergeable(*block, "top_s", "m").alias("r")).groupBy("trace").agg(
        F.max("n").alias("_n"), F.max("m").alias("m"), F.max("r.w").alias("w"), F.max("r.x").alias("x"), F.max("r.z").alias("z"), F.sum("r.total").alias("total")
    )
    merged = materialise(merged, "tf-tops")
    found = rows.join(merged.select("trace", "m", "x", "z"), "trace").select("trace", "lo", signals(*block, "top_s", "m", "x", "z").alias("r"))
    found = materialise(found.select("trace", "lo", "r.*"), "tf-signals")
    merged = merged.unionByName(once.select(*merged.columns))
    found = found.unionByName(once.select(*found.columns))

    weighted = F.when(F.col("w") > 0, F.col("total") / F.col("w") ** 2).otherwise(0.0)
    jumps = found.groupBy("trace").agg(F.sum("jumps").alias("jumps"))
    misfit = merged.join(jumps, "trace").select("trace", F.sqrt(weighted * step / (F.col("_n") * step)).alias("plain"), "jumps")
    misfit = misfit.withColumn("misfit", F.when(F.col("jumps") > max_criterion, 2 * F.col("plain")).otherwise(F.col("plain")))

    parts = found.select("trace", "lo", F.posexplode("a").alias("p", "a"))
    signal = parts.groupBy("trace", (F.col("p") + F.col("lo")).alias("i")).agg(F.sum("a").alias("a"))
    lengths = samples.groupBy("trace").agg(F.count("*").alias("old_n"))
    scale = F.when(F.col("jumps") > max_criterion, 0.0).otherwise(dt / step**2 / (F.col("plain") + float(np.finfo(float).eps)))
    square = F.when(F.col("w") > 0, F.col("w") ** 2).otherwise(1.0)
    scales = misfit.join(merged.select("trace", "w"), "trace").select("trace", (scale / square).alias("scale"))
    adjoint = _resample_to(signal, lengths, dt / step).join(scales, "trace")
    return misfit, adjoint.select("trace", "i", (F.col("a") * F.col("scale")).alias("a"))


def _resample_to(signal, lengths, ratio):
    """Each series back on its old grid of old_n samples; zeros follow its end."""
    a = 8
    first = F.expr(f"greatest(cast(floor((i - {a}) / {float(ratio)}D) as bigint) + 1, 0)")
    last = F.expr(f"least(cast(ceil((i + {a}) / {float(ratio)}D) as bigint) - 1, cast(old_n as bigint) - 1)")
    near = signal.join(lengths, "trace").withColumn("j", F.explode(F.when(first <= last, F.sequence(first, last))))
    x = F.col("j") * float(ratio) - F.col("i")
    px = F.lit(np.pi) * x
    sinc = F.when(x == 0, 1.0).otherwise(F.sin(px) / px)
    kernel = sinc * (0.42 + 0.5 * F.cos(px / a) + 0.08 * F.cos(2 * px / a))
    return near.groupBy("trace", F.col("j").alias("i")).agg(F.sum(F.col("a") * kernel).alias("a"))
