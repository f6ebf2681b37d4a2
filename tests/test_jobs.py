"""Quantiles, space, updates, misfits, streams: properties and brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from seispark.functions import geo
from seispark.operators import batch, fields, misfit, spatial, timefrequency, update, windows
from seispark.operators.chunks import with_chunk
from seispark.operators.quantiles import exact_quantiles, in_order, quantiles_of
from seispark.plans.iteration import IterationJob
from seispark.plans import waveforms
from seispark.plans.waveforms import process_events
from seispark.session import fresh_path
from seispark.sources import stores, tables
from seispark.streaming import status


@pytest.mark.parametrize("partitions", [3, 40])
def test_quantiles_with_many_ties_and_a_hot_group(spark, partitions):
    rng = np.random.default_rng(0)
    hot = np.concatenate([np.zeros(3000), rng.normal(size=4000), 10.0 ** rng.uniform(-20, 3, size=2000)])
    groups = {"hot": hot, "few": rng.normal(size=7), "one": np.array([2.5]), "same": np.ones(500), **{f"small{k}": rng.normal(size=16) for k in range(60)}}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        ordered = in_order(df, ["g"], "v")
        # the hot group, and the value that a third of it has, lie in many partitions
        spread = ordered.where("v = 0").select(F.shiftright("_pos", 33)).distinct().count()
        assert spread > partitions / 6
        got = quantiles_of(ordered, ["g"], "v", {"a": 0.02, "b": 0.5, "c": 0.98, "z": 1.0}).collect()
        whole = exact_quantiles(df, [], "v", {"h": 0.3}).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == len(groups)
    for r in got:
        np.testing.assert_allclose([r.a, r.b, r.c, r.z], np.quantile(groups[r.g], [0.02, 0.5, 0.98, 1.0]), rtol=1e-12)
    np.testing.assert_allclose(whole[0].h, np.quantile(np.concatenate(list(groups.values())), 0.3), rtol=1e-12)
    assert exact_quantiles(df.where("v is null"), [], "v", {"h": 0.3}).collect() == []


def test_clip_twice_changes_nothing_more(spark):
    df = spark.createDataFrame([("p", float(k * k)) for k in range(101)], "param string, value double")
    df = df.withColumn("event", F.lit(1))
    once = fields.clip_quantile(df, 0.9)
    values = sorted(r.value for r in once.collect())
    np.testing.assert_allclose(values[:11] + values[-11:], [100.0] * 11 + [8100.0] * 11)
    again = sorted(r.value for r in fields.clip_quantile(once, 0.9).collect())
    np.testing.assert_allclose(again, values)
    assert fields.clip_quantile(df, 1) is df


def test_parameter_orders(spark):
    cases = {
        ("VS", "VP"): ["VP", "VS"],
        ("VP", "VS", "RHO"): ["RHO", "VP", "VS"],
        ("VPV", "VSV", "VPH", "VSH", "RHO"): ["VPV", "VPH", "VSV", "VSH", "RHO"],
        ("VPV", "VSV", "VPH", "VSH", "RHO", "QKAPPA", "QMU", "ETA"): ["VPV", "VPH", "VSV", "VSH", "RHO", "QKAPPA", "QMU", "ETA"],
        ("RHO", "VP", "VS", "QKAPPA", "QMU"): ["QKAPPA", "QMU", "RHO", "VP", "VS"],
    }
    df = spark.createDataFrame([(list(k),) for k in cases], "given array<string>")
    for r in df.select("given", fields.arranged(F.col("given")).alias("out")).collect():
        assert r.out == cases[tuple(r.given)]
    bad = spark.createDataFrame([(["VP", "RHO", "MAG", "QKAPPA"],)], "given array<string>")
    with pytest.raises(Exception, match="not a known parameter set"):
        bad.select(fields.arranged(F.col("given"))).collect()


def test_unknown_parameter_is_an_error(spark):
    df = spark.createDataFrame([("VP", 1.0)], "param string, value double")
    assert fields.select_params(df, ["VP"]).count() == 1
    with pytest.raises(Exception, match="not all of"):
        fields.select_params(df, ["VP", "VS"]).collect()


def test_geocentric_and_geodesic(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (90.0, 0.0, -90.0, 0.0), (45.0, 7.0, 45.0, 7.0)], "a double, b double, c double, d double")
    lat = [r[0] for r in df.select(geo.geocentric_latitude("a")).collect()]
    assert lat[0] == 0.0 and lat[1] == 90.0 and abs(lat[2] - 44.80757678) < 1e-6
    km = [r.dist_km for r in geo.with_geodesic_km(df, "a", "b", "c", "d").collect()]
    assert abs(km[0] - 111.319491) < 1e-6 and abs(km[1] - 20003.931459) < 1e-3 and km[2] == 0


@pytest.mark.parametrize("tile", [3, 2048])
def test_station_weights(spark, tile):
    rng = np.random.default_rng(2)
    rows = [(e, k, float(rng.integers(-80, 80)), float(rng.integers(-5, 5))) for e in (1, 2) for k in range(40)]
    rows += [(3, 0, 10.0, 20.0)] + [(4, k, 5.0, 5.0) for k in range(4)]
    df = spark.createDataFrame(rows, "event int, station int, lat double, lon double")
    got = {(r.event, r.station): r.weight for r in spatial.station_weights(df, tile).collect()}
    assert len(got) == len(rows) and got[(3, 0)] == 1.0
    for e in (1, 2, 4):
        pts = np.radians([(a, b) for ev, _, a, b in rows if ev == e])
        c = np.sin(pts[:, None, 0]) * np.sin(pts[None, :, 0]) + np.cos(pts[:, None, 0]) * np.cos(pts[None, :, 0]) * np.cos(pts[:, None, 1] - pts[None, :, 1])
        deg = np.degrees(np.arccos(np.clip(c, -1, 1)))
        deg[(pts[:, None] == pts[None]).all(axis=2)] = 0
        w = 1 / ((1 / (1 + deg)).sum(axis=1) - 1)
        w *= len(w) / w.sum()
        np.testing.assert_allclose([got[(e, k)] for k in range(len(w))], w, rtol=1e-9)
        assert abs(np.mean(w) - 1) < 1e-12


@pytest.mark.parametrize("levels", [24, 6])
def test_nearest_nodes_with_copies_and_clusters(spark, levels):
    rng = np.random.default_rng(4)
    src = [(k, int(k % 2), *map(float, rng.normal(size=3) * 1000)) for k in range(200)]
    src += [(1000 + k, 0, 1.0, 2.0, 3.0) for k in range(300)]
    src += [(2000 + k, 1, 1e6 + k, 1e6, 1e6) for k in range(50)]
    tgt = [(5000 + k, int(k % 2), *map(float, rng.normal(size=3) * 1000)) for k in range(60)] + [(6000, 0, 1.0, 2.0, 3.0)]
    src += [(3000, 5, 1.0, 0.0, 0.0), (3001, 5, 900.0, 0.0, 0.0)]  # a layer with too few sources
    tgt += [(8000, 5, 3.0, 0.0, 0.0)]
    tgt += [(7000, 0, 5e7, -3e6, 0.0), (7001, 1, -2e5, 4e5, 9e6)]  # far outside the box of the sources
    cols = "{} bigint, layer int, x double, y double, z double"
    got = spatial.nearest_nodes(spark.createDataFrame(tgt, cols.format("node")), spark.createDataFrame(src, cols.format("source")), levels=levels)
    rows = {}
    for r in got.collect():
        rows.setdefault(r.node, {})[r["rank"]] = (r.d2, r.source)
    for node, layer, *p in tgt:
        d = sorted((sum((a - b) ** 2 for a, b in zip(p, q)), s) for s, m, *q in src if m == layer)[:4]
        assert [rows[node][k][1] for k in sorted(rows[node])] == [s for _, s in d]
    w = spatial.inverse_distance_weights(got)
    assert {r.source for r in w.where("node = 6000 and w > 0").collect()} == {1000}


def test_cut_regions_counts_a_node_once(spark):
    nodes = spark.createDataFrame([(k, float(k), 0.0, 0.0, 1.0) for k in range(100)], "node int, x double, y double, z double, value double")
    centres = spark.createDataFrame([(10.0, 0.0, 0.0)] * 5 + [(12.0, 0.0, 0.0)], "x double, y double, z double")
    cut = spatial.cut_regions(nodes, centres, 3.0).collect()
    assert len(cut) == 100 and sorted(r.node for r in cut if r.value == 0) == list(range(8, 15))


def test_adam_without_memory(spark):
    g = spark.createDataFrame([("p", k, float(x)) for k, x in enumerate([1, -2, 4])], "param string, node int, g double")
    rule = update.Adam(beta_1=0.0, beta_2=0.0, scaling=1.0)
    raw = {r.node: r.update for r in rule.raw_update(rule.moments(g, None), 0).collect()}
    e = 0.1 * np.mean([1, 2, 4])
    np.testing.assert_allclose([raw[k] for k in range(3)], [0.001 * x / (abs(x) + e) for x in (1, -2, 4)])


def test_nan_and_size_guards(spark):
    g = spark.createDataFrame([("p", 0, float("nan"))], "param string, node int, g double")
    with pytest.raises(Exception, match="NaN in the gradient"):
        update.Adam().moments(g, None).collect()
    u = spark.createDataFrame([("p", 0, 0.5)], "param string, node int, update double")
    with pytest.raises(Exception, match="is larger than"):
        update.check_magnitude(u, "update", 0.1, "the step").collect()


def test_unknown_names(spark):
    with pytest.raises(ValueError):
        update.optimizer("lbfgs")
    with pytest.raises(ValueError):
        misfit.adjoint_sources("envelope_misfit", None, None, 1.0, 2.0)
    assert isinstance(update.optimizer("adam", alpha=0.5), update.Adam)


def test_iteration_job_resumes(spark):
    m = spark.createDataFrame([("p", k, 10.0 + k, 10.0 + k) for k in range(5)], "param string, node int, theta0 double, theta double")
    g = spark.createDataFrame([(e, "p", k, float(k - 2)) for k in range(5) for e in (1, 2)], "event int, param string, node int, g double")
    job = IterationJob(spark, fresh_path(spark, "job"), update.Momentum())
    job.start(m)
    first = sorted(tuple(r) for r in job.run(0, g).collect())
    again = IterationJob(spark, job.path, update.Momentum())
    assert sorted(tuple(r) for r in again.run(0, g.withColumn("g", F.lit(0.0))).collect()) == first
    assert stores.exists(spark, f"{job.folder(1, 'model')}/_SUCCESS")


def test_pick_minibatch_small_pool(spark):
    c = spark.createDataFrame([(1, 0.0, 0.0, 2.0), (2, 0.0, 90.0, 1.0), (3, 0.0, 1.0, 1.5)], "event bigint, lat double, lon double, norm double")
    assert [r.event for r in batch.pick_minibatch(c, 9).orderBy("round").collect()] == [1, 2, 3]
    assert batch.random_minibatch(c, 2, 7).count() == 2


def brute_phase_misfit(d, s, lo, hi):
    """The phase misfit written out with plain loops."""
    n, width = len(d), 2 * lo
    t = np.arange(n)
    g = lambda y: (np.pi * width**2) ** -0.25 * np.exp(-0.5 * y**2 / width**2)
    c, tf = np.zeros((n, n), complex), np.zeros((n, n), complex)
    long, want = np.fft.fftfreq(2 * n - 1), np.fft.fftfreq(n)
    order = np.argsort(long)
    for k in range(n):
        a, b = g(t - k) * d, g(t - k) * s
        if np.abs(b).max() >= 0.01 * np.abs(s).max():
            tf[k] = np.fft.fft(b)
        if min(np.abs(a).max(), np.abs(b).max()) < 0.01 * np.abs(d).max():
            continue
        cc = np.roll(np.correlate(b, a, "full"), -(n - 1))
        f = np.fft.fft(cc)
        c[k] = np.interp(want, long[order], f.real[order]) + 1j * np.interp(want, long[order], f.imag[order])
    c, tf = c / np.sqrt(2 * np.pi), tf / np.sqrt(2 * np.pi)
    m, nu = np.abs(c).max() / 10, np.arange(n) / n
    w = (1 - np.exp(-np.abs(c) ** 2 / m**2)) * (1 - np.exp(-((nu * hi) ** 2)))
    w = w * np.where(nu <= 1 / lo, 1, np.exp(-10 * np.abs(nu * lo - 1)))
    w /= w.max()
    phase = np.angle(c)
    x = w * phase / np.abs(w * phase).max()
    jumps = (np.abs(np.diff(x, axis=0)) > 0.7).sum() + (np.abs(np.diff(x, axis=1)) > 0.7).sum()
    value = np.sqrt((w**2 * phase**2).sum() / n)
    z = w**2 * phase * tf / (m + np.abs(tf) ** 2)
    inv = np.zeros((n, n), complex)
    for k in range(n):
        if np.abs(z[k]).max() >= 0.01 * np.abs(z).max():
            inv[k] = np.fft.ifft(z[k]) * 2 * np.pi
    a = np.array([(g(k - t) * inv[:, k]).sum() for k in range(n)]) / np.sqrt(2 * np.pi)
    return value, jumps, a.imag / (value + np.finfo(float).eps)


@pytest.mark.parametrize("n", [65, 151])
def test_phase_misfit_and_adjoint(spark, n):
    t = np.arange(float(n))
    s = np.sin(2 * np.pi * t / 9) * np.exp(-((t - n / 2) ** 2) / 200)
    d = np.sin(2 * np.pi * (t + 1) / 9) * np.exp(-((t - n / 2) ** 2) / 200)
    df = spark.createDataFrame([(1, i, float(d[i]), float(s[i])) for i in range(n)], "trace bigint, i int, d double, s double")
    value, jumps, a = brute_phase_misfit(d, s, 6.0, 30.0)
    m, adj = timefrequency.phase_misfit(df, 6.0, 30.0, max_criterion=10**9)
    r = m.first()
    assert abs(r.misfit - value) < 1e-9 and r.jumps == jumps
    got = np.zeros(n)
    for x in adj.collect():
        got[x.i] = x.a
    np.testing.assert_allclose(got, a, atol=1e-10)


@pytest.mark.parametrize("size, cells", [(8, 1 << 20), (32, 500)])
def test_phase_misfit_over_many_blocks(spark, monkeypatch, size, cells):
    """Windows of four samples reach a part of the series only; blocks and steps cut it anywhere."""
    monkeypatch.setattr(timefrequency, "block_size", lambda width, dt: size)
    monkeypatch.setattr(timefrequency, "CELLS", cells)
    rng, t = np.random.default_rng(size), np.arange(211.0)
    both = [(np.sin(2 * np.pi * (t + s) / p) * np.exp(-((t - 100) ** 2) / 3000) + 0.05 * rng.normal(size=211)) for s, p in ((1, 9), (0, 9))]
    df = spark.createDataFrame([(1, i, float(both[0][i]), float(both[1][i])) for i in range(211)], "trace bigint, i int, d double, s double")
    value, jumps, a = brute_phase_misfit(*both, 2.0, 30.0)
    m, adj = timefrequency.phase_misfit(df, 2.0, 30.0, max_criterion=10**9)
    r = m.first()
    assert abs(r.plain - value) < 1e-9 and r.jumps == jumps
    got = np.zeros(211)
    for x in adj.collect():
        got[x.i] = x.a
    np.testing.assert_allclose(got, a, atol=1e-9)


def test_gabor_and_back_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(timefrequency, "block_size", lambda width, dt: 16)
    monkeypatch.setattr(timefrequency, "CELLS", 700)
    v = np.random.default_rng(8).normal(size=150)
    df = spark.createDataFrame([(("x", 1), i, float(v[i])) for i in range(150)], "trace struct<a:string,b:int>, i bigint, s double")
    found = timefrequency.gabor(df, 3.0)
    got = {r.k: np.array(r.re) + 1j * np.array(r.im) for r in found.collect()}
    t = np.arange(150)
    rows = np.stack([(np.pi * 9) ** -0.25 * np.exp(-((t - k) ** 2) / 18) * v for k in t])
    want = np.fft.fft(rows, axis=1) / np.sqrt(2 * np.pi)
    want[np.abs(rows).max(axis=1) < 0.01 * np.abs(v).max()] = 0
    np.testing.assert_allclose(np.stack([got[k] for k in t]), want, atol=1e-12)
    keep = np.abs(want).max(axis=1) >= 0.01 * np.abs(want).max()
    signal = sum((np.pi * 9) ** -0.25 * np.exp(-((t - k) ** 2) / 18) * np.fft.ifft(want[k]) for k in t[keep]) * np.sqrt(2 * np.pi)
    back = {r.i: r.re for r in timefrequency.inverse(found, 3.0).collect()}
    np.testing.assert_allclose([back.get(i, 0.0) for i in range(150)], signal.real, atol=1e-12)


def test_phase_misfit_of_equal_traces_is_zero(spark):
    df = spark.createDataFrame([(1, i, float(np.sin(i)), float(np.sin(i))) for i in range(51)], "trace bigint, i int, d double, s double")
    assert timefrequency.phase_misfit(df, 4.0, 20.0)[0].first().misfit < 1e-6


def test_ccc_of_scaled_traces_is_zero_with_envelopes_too(spark):
    rows = [(1, i, float(np.sin(i / 3) * 2), float(np.sin(i / 3))) for i in range(90)]
    pair = with_chunk(spark.createDataFrame(rows, "trace bigint, i int, d double, s double"), 32)
    w = spark.createDataFrame([(1, 0, 5, 60, 1.0), (1, 1, 40, 80, 1.0)], "trace bigint, win int, start int, stop int, weight double")
    for scaled in (False, True):
        m, a = misfit.adjoint_sources("ccc", pair, w, 6.0, 30.0, scaled=scaled, size=32)
        assert abs(m.first().misfit) < 1e-12 and a.count() == 90


def test_waveform_job_with_phase_misfit(spark):
    t = np.arange(200.0)
    s = np.sin(2 * np.pi * t / 12) * np.exp(-((t - 100) ** 2) / 1500)
    rows = [(1, i, float(2 * np.roll(s, 1)[i]), float(s[i])) for i in range(200)]
    pair = with_chunk(spark.createDataFrame(rows, "trace bigint, i int, d double, s double"))
    far = spark.createDataFrame([(1, 400.0)], "trace bigint, dist_km double")
    weight = spark.createDataFrame([(1, 2.0)], "trace bigint, weight double")
    cfg = windows.Settings(10.0, 40.0, max_noise=0.5)
    found, m, a = process_events(pair, far, weight, cfg, kind="tf_phase_misfit")
    assert found.count() >= 1 and m.first().misfit > 0 and a.count() == 200
    _, m, a = process_events(pair, far, weight, cfg)
    assert m.first().misfit > 0 and a.where("a <> 0").count() > 0
    near = far.withColumn("dist_km", F.lit(1.0))
    with pytest.raises(ValueError, match="no window"):
        process_events(pair, near, weight, cfg)


def test_preprocessing_job_rotates_trims_and_writes_on_one_grid(spark):
    """Channels along N and E under the names BH1 and BH2, and a recording that starts later, give the same traces."""
    t = np.arange(400.0)
    wave = {c: np.sin(2 * np.pi * t / p) * np.exp(-((t - 200) ** 2) / 3000) for c, p in (("BHZ", 14), ("BHN", 17), ("BHE", 21))}
    headers, samples, axes = [], [], []
    names = {1: {c: c for c in wave}, 2: {"BHZ": "BHZ", "BHN": "BH1", "BHE": "BH2"}, 3: {"BHZ": "BHZ"}}
    for station, own in names.items():
        skip = 5 if station == 3 else 0
        for source, channel in own.items():
            headers.append((7, station, channel, "raw_recording", 900.0 + skip, 1.0))
            samples += [(7, station, channel, "raw_recording", i - skip, float(wave[source][i])) for i in range(skip, 400)]
            axes.append((7, station, channel, {"BHZ": 0.0, "BHN": 0.0, "BHE": 90.0}[source], -90.0 if source == "BHZ" else 0.0))
    headers.append((7, 4, "BHZ", "other", 900.0, 1.0))
    head = spark.createDataFrame(headers, "event int, station int, channel string, tag string, t0 double, dt double")
    rows = spark.createDataFrame(samples, "event int, station int, channel string, tag string, i bigint, v double")
    orientation = spark.createDataFrame(axes, "event int, station int, channel string, azimuth double, dip double")
    origins = spark.createDataFrame([(7, 1000.0)], "event int, time double")
    path = fresh_path(spark, "processed")
    out = waveforms.preprocess_job(head, rows, orientation, origins, path, "clean", 0.5, 401, 10.0, 40.0)
    assert stores.exists(spark, f"{path}/_SUCCESS") and {r.tag for r in out.select("tag").distinct().collect()} == {"clean"}
    got = {}
    for r in out.collect():
        got.setdefault((r.station, r.channel), {})[r.i] = r.v
    assert set(got) == {(1, c) for c in wave} | {(2, c) for c in wave} | {(3, "BHZ")}
    for c in wave:
        a, b = (np.array([got[s, c][i] for i in range(401)]) for s in (1, 2))
        assert np.abs(a).max() > 0.1
        np.testing.assert_allclose(a, b, atol=1e-5)
    late = np.array([got[3, "BHZ"][i] for i in range(401)])
    np.testing.assert_allclose(late, [got[1, "BHZ"][i] for i in range(401)], atol=2e-2)


def test_streams_go_on_with_late_files_and_replays(spark, small, tmp_path):
    events = pq.read_table(f"{small}/events.parquet")
    folder, half = str(tmp_path), events.num_rows // 2
    (tmp_path / "in").mkdir()
    pq.write_table(events.slice(half - 20), f"{folder}/in/events1.parquet")
    src = tables.as_status(status.read_events(spark, f"{folder}/in"))
    keep = {k: {"path": f"{folder}/{k}/out", "checkpoint": f"{folder}/{k}/cp"} for k in ("latest", "repost", "intake", "stage", "once")}

    def once(b):
        return b.groupBy("event").agg(F.min("seq").alias("seq"))

    def answers():
        return {
            "latest": status.latest_status(src, **keep["latest"]).select("event", "job_type", "status", "seq"),
            "repost": status.repost_tracker(src, 3, **keep["repost"]),
            "intake": status.new_event_intake(src, **keep["intake"]),
            "stage": status.stage_readiness(src, F.col("event") % 10 == 0, **keep["stage"]),
            "once": status.process_once(src, once, **keep["once"]).select("event"),
        }

    answers()
    pq.write_table(events.slice(0, half), f"{folder}/in/events2.parquet")
    got = {k: sorted(tuple(r) for r in df.collect()) for k, df in answers().items()}
    from seispark.catalog.registry import QUERIES

    for key, name in {"latest": "latest_status", "repost": "repost_tracker", "intake": "new_event_intake", "stage": "stage_readiness"}.items():
        assert got[key] == sorted(tuple(r) for r in QUERIES[name](spark, small).collect()), key
    assert got["once"] == sorted((u,) for u in set(events["user_id"].to_pylist()))


def test_receivers_nested_in_a_run(spark):
    text = '{"forward_run_input": {"output": {"point_data": {"receiver": [{"latitude": 1.5, "longitude": 2.0, "network-code": "A", "station-code": "B"}]}}}}'
    r = stores.receivers_of_run(spark.createDataFrame([(text,)], "value string")).first()
    assert r.latitude == 1.5 and r["network-code"] == "A"


def test_missing_iteration_is_an_error(spark):
    path = fresh_path(spark, "it")
    spark.range(3).selectExpr("id", "1 as iteration").write.partitionBy("iteration").parquet(path)
    assert stores.read_iteration(spark, path, 1).count() == 3
    with pytest.raises(ValueError):
        stores.read_iteration(spark, path, 2)
