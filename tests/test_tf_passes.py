"""Spectra that are read once, and series that are done in one pass, against the ways over many blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seispark.operators import timefrequency

SCHEMA = "trace bigint, i bigint, d double, s double"


def series(lengths, seed=3):
    rng = np.random.default_rng(seed)
    return [(k, i, float(d), float(s)) for k, n in enumerate(lengths) for i, (d, s) in enumerate(rng.normal(size=(n, 2)) * np.exp(-((np.arange(n) - n / 3) ** 2) / 300)[:, None])]


def test_spectra_with_tops_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(timefrequency, "block_size", lambda width, dt: 32)
    rows = series([40, 150, 33])
    rows[45] = (*rows[45][:3], float("nan"))
    df = spark.createDataFrame(rows, SCHEMA)
    plain, known = timefrequency.gabor(df, 3.0), timefrequency.gabor(df, 3.0, tops=True)
    want = {(r.trace, r.i): r.re for r in timefrequency.inverse(plain, 3.0).collect()}
    back = timefrequency.inverse(known, 3.0)
    got = {(r.trace, r.i): r.re for r in back.collect()}
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12, nan_ok=True) and any(np.isnan(v) for v in got.values())
    largest = {r.trace: r.top for r in plain.select("trace", F.explode(F.arrays_zip("re", "im")).alias("z")).groupBy("trace").agg(F.max(F.hypot("z.re", "z.im")).alias("top")).collect()}
    tops = known.groupBy("trace").agg(F.min("top").alias("a"), F.max("top").alias("b")).collect()
    for c in "ab":
        assert {r.trace: r[c] for r in tops} == pytest.approx(largest, nan_ok=True)
    # no join above the spectra
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Join" not in plan[: plan.rindex("MapInArrow")]


def test_series_of_one_block_take_one_pass(spark, monkeypatch):
    """The same misfits and adjoint samples as in three passes over blocks, which only the long series still takes."""
    df = spark.createDataFrame(series([41, 65, 300]), SCHEMA)
    seen, steps = [], timefrequency.materialise
    monkeypatch.setattr(timefrequency, "materialise", lambda table, name: seen.append((name, steps(table, name))) or seen[-1][1])
    one = timefrequency.phase_misfit(df, 4.0, 20.0)
    counts = {name: table.count() for name, table in seen}
    assert counts["tf-short"] == 2 and counts["tf-tops"] == 1
    monkeypatch.setattr(timefrequency, "CELLS", 40 * 40)
    three = timefrequency.phase_misfit(df, 4.0, 20.0)
    for a, b, keys in zip(one, three, (["trace"], ["trace", "i"])):
        got, want = ({tuple(r[k] for k in keys): [r[c] for c in a.columns] for r in x.collect()} for x in (a, b))
        assert set(got) == set(want)
        for k in got:
            assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9)
