"""Results must not depend on where a trace is cut: tiny chunks against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seispark.functions import kernels
from seispark.operators import chunks, correlate, traces, windows
from seispark.session import fresh_path
from seispark.sources import stores

SIZE = 16


def make(spark, arrays, columns=("v",)):
    """Samples (trace, chunk, i, columns) from {trace: array or tuple of arrays}."""
    rows = []
    for t, a in arrays.items():
        a = (a,) if len(columns) == 1 else a
        rows += [(t, i, *map(float, x)) for i, x in enumerate(zip(*a))]
    df = spark.createDataFrame(rows, "trace bigint, i int, " + ", ".join(f"{c} double" for c in columns))
    return chunks.with_chunk(df, SIZE)


def read(df, column, n):
    out = {}
    for r in df.collect():
        out.setdefault(r.trace, np.full(n[r.trace], np.nan))[r.i] = r[column]
    return out


@pytest.fixture(scope="module")
def noise():
    rng = np.random.default_rng(3)
    return {1: rng.normal(size=100), 2: rng.normal(size=16), 3: rng.normal(size=33), 4: rng.normal(size=5)}


def test_runs_cover_the_valid_samples(spark, noise):
    s = make(spark, noise)
    got = {(r.trace, r.start, r.stop) for r in chunks.runs(s.where("v > -1"), SIZE).collect()}
    want = set()
    for t, v in noise.items():
        ok = np.concatenate([[False], v > -1, [False]])
        starts, stops = np.flatnonzero(~ok[:-1] & ok[1:]), np.flatnonzero(ok[:-1] & ~ok[1:])
        want |= {(t, a, b) for a, b in zip(starts, stops)}
    assert got == want


def test_one_run_over_many_chunks(spark):
    s = make(spark, {7: np.ones(200)})
    assert [tuple(r) for r in chunks.runs(s, SIZE).collect()] == [(7, 0, 200)]


def test_number_rows(spark):
    df = spark.createDataFrame([(1, k * 7 % 101) for k in range(101)], "key int, x int")
    got = chunks.number_rows(df, "key", ["x"], F.floor(F.col("x") / 10)).collect()
    assert all(r.i == r.x for r in got) and len(got) == 101


@pytest.mark.parametrize("after", [True, False])
def test_sibling_of_sparse_rows(spark, after):
    at = [0, 3, 40, 41, 99, 160]
    s = chunks.with_chunk(spark.createDataFrame([(1, i) for i in at], "trace int, i int"), SIZE)
    got = {r.i: r.other and r.other.i for r in chunks.sibling(s, ["i"], "other", after).collect()}
    pairs = zip(at, at[1:] + [None]) if after else zip(at, [None] + at[:-1])
    assert got == dict(pairs)


def test_nearest_matches_the_published_example(spark):
    refs = spark.createDataFrame([(1, float(k)) for k in range(20)], "trace int, i double")
    targets = spark.createDataFrame([(1, x) for x in (-2.0, 100.0, 2.0, 2.4, 2.5, 2.6)], "trace int, i double")
    got = {r.i: r.match for r in chunks.nearest(refs, targets, 4).collect()}
    assert got == {-2.0: 0, 100.0: 19, 2.0: 2, 2.4: 2, 2.5: 3, 2.6: 3}


def test_nearest_over_empty_chunks(spark):
    ref = np.array([5, 90, 91])
    refs = spark.createDataFrame([(1, int(k)) for k in ref], "trace int, i int")
    targets = spark.createDataFrame([(1, k) for k in range(120)], "trace int, i int")
    for r in chunks.nearest(refs, targets, SIZE).collect():
        d = np.abs(ref - r.i)
        assert r.match == np.flatnonzero(d == d.min())[-1]


def test_interval_join(spark, noise):
    s = make(spark, noise)
    ranges = spark.createDataFrame([(1, 10, 70), (1, 15, 17), (3, 30, 33)], "trace bigint, start int, stop int")
    got = sorted((r.trace, r.start, r.i) for r in chunks.in_ranges(s, ranges, size=SIZE).collect())
    want = sorted((t, a, i) for t, a, b in [(1, 10, 70), (1, 15, 17), (3, 30, 33)] for i in range(a, b))
    assert got == want


def direct(sections, x):
    for b0, b1, b2, a1, a2 in sections:
        y, p, q = [], 0.0, 0.0
        for v in x:
            o = b0 * v + p
            p, q = b1 * v - a1 * o + q, b2 * v - a2 * o
            y.append(o)
        x = y
    return np.array(x)


def test_filter_over_chunk_borders(spark, noise):
    sections = kernels.bandpass_sections(0.05, 0.25, 1.0)
    n = {t: len(v) for t, v in noise.items()}
    got = read(traces.sections_filter(make(spark, noise), sections, size=SIZE), "v", n)
    for t, v in noise.items():
        np.testing.assert_allclose(got[t], direct(sections, v), atol=1e-12)


def response(sections, f):
    z = np.exp(-2j * np.pi * np.asarray(f))
    h = np.ones(len(z), complex)
    for b0, b1, b2, a1, a2 in sections:
        h *= (b0 + b1 * z + b2 * z * z) / (1 + a1 * z + a2 * z * z)
    return np.abs(h)


def test_bandpass_design():
    h = response(kernels.bandpass_sections(0.05, 0.2, 1.0), [1e-9, 0.05, 0.1, 0.2, 0.4999])
    np.testing.assert_allclose(h[[1, 3]], np.sqrt(0.5), atol=1e-9)
    assert h[0] < 1e-9 and h[4] < 1e-6 and h[2] > 0.99


def test_lowpass_design():
    sections = kernels.lowpass_sections(0.125, 1.0)
    assert len(sections) <= 6
    stop = response(sections, np.linspace(0.126, 0.4999, 300))
    assert stop.max() < 10 ** (-95.9 / 20)
    assert abs(response(sections, [1e-6])[0] - 1) < 1e-9


def test_zero_phase_lowpass_keeps_slow_waves(spark):
    t = np.arange(400)
    x = np.cos(2 * np.pi * t / 100)
    got = read(traces.zero_phase_lowpass(make(spark, {1: x}), 0.25, size=SIZE), "v", {1: 400})[1]
    np.testing.assert_allclose(got[100:300], x[100:300], atol=2e-2)


def test_envelope_equals_fft(spark, noise):
    n = {t: len(v) for t, v in noise.items()}
    got = read(traces.envelope(make(spark, noise), size=SIZE), "env_v", n)
    for t, v in noise.items():
        m = len(v)
        h = np.zeros(m)
        h[0] = 1
        h[1 : (m + 1) // 2] = 2
        if m % 2 == 0:
            h[m // 2] = 1
        np.testing.assert_allclose(got[t], np.abs(np.fft.ifft(np.fft.fft(v) * h)), atol=1e-10)


@pytest.mark.parametrize("size", [1, 4, 7, 100, 512])
def test_transforms_on_every_grid(spark, size):
    rng = np.random.default_rng(size)
    both = {t: (rng.normal(size=n), rng.normal(size=n)) for t, n in {1: 1, 2: 2, 3: 31, 4: 64, 5: 257}.items()}
    pair = chunks.with_chunk(make(spark, both, ("d", "s")).drop("chunk"), size)
    env = {(r.trace, r.i): (r.env_d, r.env_s) for r in traces.envelope(pair, ["d", "s"], size).collect()}
    lags = {(r.trace, r.lag): r.c for r in correlate.cross_correlation(pair, size=size).collect()}
    for t, (d, s) in both.items():
        n = len(d)
        full = np.correlate(d, s, "full")
        np.testing.assert_allclose([lags.pop((t, k)) for k in range(1 - n, n)], full, atol=1e-10)
        half = np.zeros(n)
        half[0], half[1 : (n + 1) // 2], half[n // 2 : n // 2 + 1 - n % 2] = 1, 2, 1
        want = [np.abs(np.fft.ifft(np.fft.fft(x) * half)) for x in (d, s)]
        np.testing.assert_allclose([env.pop((t, k)) for k in range(n)], np.array(want).T, atol=1e-10)
    assert not lags and not env


def test_no_traces_no_transforms(spark, noise):
    none = make(spark, noise).where("i < 0")
    assert traces.envelope(none, size=SIZE).collect() == []
    assert correlate.best_shift(none.withColumn("d", F.col("v")).withColumn("s", F.col("v")), 3, SIZE).collect() == []


@pytest.mark.parametrize("most, size", [(3, 4), (9, 4), (40, 16), (300, 16)])
def test_best_shift_with_lags_beyond_chunks(spark, most, size):
    rng = np.random.default_rng(most)
    both = {t: (rng.normal(size=n), rng.normal(size=n)) for t, n in {1: 1, 2: 5, 3: 70, 4: 131}.items()}
    got = {r.trace: (r.lag, r.c) for r in correlate.best_shift(chunks.with_chunk(make(spark, both, ("d", "s")).drop("chunk"), size), most, size).collect()}
    for t, (d, s) in both.items():
        full = np.zeros(2 * most + 1)
        for k in range(-most, most + 1):
            full[k + most] = sum(s[m + k] * d[m] for m in range(len(d)) if 0 <= m + k < len(d))
        assert got[t][0] == full.argmax() - most and abs(got[t][1] - full.max()) < 1e-10


def test_cross_correlation(spark, noise):
    rng = np.random.default_rng(5)
    both = {t: (v, rng.normal(size=len(v))) for t, v in noise.items()}
    got = correlate.cross_correlation(make(spark, both, ("d", "s")), size=SIZE).collect()
    for t, (d, s) in both.items():
        rows = {r.lag: (r.position, r.c) for r in got if r.trace == t}
        full = np.correlate(d, s, "full")
        n = len(d)
        assert len(rows) == 2 * n - 1
        for lag, (position, c) in rows.items():
            assert position == lag % (2 * n - 1)
            assert abs(c - full[lag + n - 1]) < 1e-10


def test_numbers_of_sorted_rows(spark):
    rows = [(k * 7919 % 503, "x") for k in range(503)] + [(None, "null")]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = chunks.number_sorted(df, [F.desc("a")], "n").collect()
    assert [(r.a, r.n) for r in sorted(got, key=lambda r: r.n)] == [(502 - k, k) for k in range(503)] + [(None, 503)]
    assert chunks.number_sorted(df.where("a < 0"), ["a"]).collect() == []


@pytest.mark.parametrize("start, stop", [(0, 40), (-37, 9), (20, 140), (-50, 300), (110, 150), (-9, -3)])
def test_trim_and_pad_over_many_chunks(spark, noise, start, stop):
    got = read(traces.trim_pad(make(spark, noise), start, stop, size=SIZE), "v", {t: stop - start for t in noise})
    for t, v in noise.items():
        want = [v[i] if 0 <= i < len(v) else 0.0 for i in range(start, stop)]
        np.testing.assert_allclose(got[t], want)


def test_files_of_an_event(spark):
    """However many tasks the rows come from, an event is one file as long as it is small."""
    rows = spark.range(4000).selectExpr("id % 3 as event", "id % 50 as station", "'raw' as tag", "id div 1000 as chunk", "id as i", "1.0e0 as v")
    path = stores.write_traces(rows.repartition(8), fresh_path(spark, "few-files"))
    files = [f for f in stores.read_traces(spark, path).inputFiles()]
    assert len(files) == 3
    for f in files:
        stations = [r.station for r in spark.read.parquet(f).select("station").collect()]
        assert stations == sorted(stations)


def test_best_shift(spark):
    s = np.sin(np.arange(100) / 3.0) * np.hanning(100)
    got = correlate.best_shift(make(spark, {1: (np.roll(s, -2), s)}, ("d", "s")), 5, SIZE).first()
    assert got.lag == 2


def test_lanczos_keeps_samples_at_ratio_one(spark, noise):
    n = {t: len(v) for t, v in noise.items()}
    got = read(traces.lanczos(make(spark, noise), 1.0, 8, size=SIZE), "v", n)
    for t, v in noise.items():
        np.testing.assert_allclose(got[t], v, atol=1e-12)


def test_detrend_taper(spark, noise):
    x = {1: noise[1] + 0.3 * np.arange(100)}
    a = read(traces.detrend_taper(make(spark, x), 0.1, size=SIZE), "v", {1: 100})[1]
    b = read(traces.taper(traces.detrend(make(spark, x), size=SIZE), 0.1, size=SIZE), "v", {1: 100})[1]
    np.testing.assert_allclose(a, b, atol=1e-12)
    flat = x[1] - np.polyval(np.polyfit(np.arange(100), x[1], 1), np.arange(100))
    np.testing.assert_allclose(a[10:90], flat[10:90], atol=1e-10)
    assert a[0] == 0 and a[99] == 0


@pytest.mark.parametrize("period", [3.0, 12.0])
def test_sliding_correlation(spark, period):
    s = windows.Settings(period, 60.0)
    rng = np.random.default_rng(8)
    d = rng.normal(size=100)
    y = np.roll(d, 1) + 0.1 * rng.normal(size=100)
    pair = make(spark, {1: (d, y)}, ("d", "s")).withColumns(
        {"n": F.lit(100), "ptp_s": F.lit(float(np.ptp(y))), "min_idx": F.lit(5), "max_idx": F.lit(90)}
    )
    got = {r.i: r for r in windows.sliding_correlation(pair, s, SIZE).collect()}
    assert len(got) == 100
    w, stride = s.width, s.stride
    shift, cc = np.full(100, np.nan), np.full(100, np.nan)
    for a in range(0, 100 - w + 1, stride):
        mid = a + w // 2
        if not 5 < mid < 90:
            continue
        p, q = d[a : a + w] * np.hanning(w), y[a : a + w] * np.hanning(w)
        c = np.correlate(p, q, "full")
        k = slice(mid - (stride - 1) // 2, mid + (stride - 1) // 2 + 1)
        shift[k] = (c.argmax() - w + 1) / period
        cc[k] = c.max() / np.sqrt((p**2).sum() * (q**2).sum())
    for i in range(100):
        assert got[i].covered == (not np.isnan(cc[i]))
        if got[i].covered:
            assert abs(got[i].cc - cc[i]) < 1e-12 and abs(got[i]["shift"] - shift[i]) < 1e-12


def test_extrema_with_flat_tops_over_chunks(spark):
    v = np.concatenate([np.arange(10), np.full(40, 10.0), np.arange(10)[::-1], [3, 5, 4, 4, 4, 6]])
    s = make(spark, {1: v})
    ranges = spark.createDataFrame([(1, 0, len(v))], "trace bigint, lo int, hi int")
    got = sorted((r.i, r.peak) for r in windows.extrema(s, ranges, SIZE).collect())
    assert got == [(0, False), (10, True), (59, False), (61, True), (62, False), (65, True)]


def test_full_correlation_both_ways():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(3, 300)), rng.normal(size=(3, 300))
    got = kernels.full_correlation(a, b)
    for k in range(3):
        np.testing.assert_allclose(got[k], np.correlate(a[k], b[k], "full"), atol=1e-9)


def test_select_windows_does_not_depend_on_the_chunk(spark):
    t = np.arange(300.0)
    wave = np.sin(2 * np.pi * t / 12) * np.exp(-((t - 150) ** 2) / 3000)
    pair = {1: (wave, np.roll(wave, 1)), 2: (wave, -wave)}
    s = windows.Settings(10.0, 40.0, max_noise=0.5)
    far = spark.createDataFrame([(1, 500.0), (2, 500.0)], "trace bigint, dist_km double")
    results = []
    for size in (64, 1 << 16):
        p = chunks.with_chunk(make(spark, pair, ("d", "s")), size)
        results.append(sorted(tuple(r) for r in windows.select_windows(p, far, s, size=size).collect()))
    assert results[0] == results[1]
    assert results[0] and all(r[0] == 1 for r in results[0])


def test_callback_per_chunk_sees_its_neighbours(spark, noise):
    def smooth(pdf):
        pdf["v"] = pdf["v"].rolling(3, center=True).mean()
        return pdf.loc[pdf["own"], ["trace", "i", "v"]].dropna()

    got = chunks.map_chunks(make(spark, noise), smooth, "trace bigint, i int, v double", 1, 1, SIZE).collect()
    assert len(got) == sum(len(v) - 2 for v in noise.values())
    for r in got:
        assert abs(r.v - noise[r.trace][r.i - 1 : r.i + 2].mean()) < 1e-12


def test_source_pulse_contract(spark):
    n = spark.createDataFrame([(1, 60)], "trace bigint, n bigint")
    pulse = traces.source_pulse(n, 4.0, 20.0, size=64)
    assert traces.check_pulse(pulse.withColumn("chunk", F.lit(0).cast("bigint")), n).count() == 60
    with pytest.raises(Exception, match="source pulse"):
        traces.check_pulse(pulse.withColumn("chunk", F.lit(0).cast("bigint")).withColumn("v", F.lit(1.0)), n).collect()
