"""Smoothing over tiles against brute force over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seispark.functions import kernels
from seispark.operators import spatial


def brute(rows, lateral, radial, period):
    """{(by, node): mean} from rows (by, node, x, y, z, velocity, value)."""
    out = {}
    for by, node in {r[:2] for r in rows}:
        top = below = 0.0
        for a in (r for r in rows if r[:2] == (by, node) and r[5] is not None and r[5] > 0):
            for b in (r for r in rows if r[0] == by and r[6] is not None):
                p, q = np.array(a[2:5]), np.array(b[2:5])
                dr2 = (np.sqrt(p @ p) - np.sqrt(q @ q)) ** 2
                u2 = dr2 / (radial * a[5] * period) ** 2 + max(((p - q) ** 2).sum() - dr2, 0) / (lateral * a[5] * period) ** 2
                if u2 <= 9:
                    top, below = top + np.exp(-u2 / 2) * b[6], below + np.exp(-u2 / 2)
        out[by, node] = top / below if below else next(r[6] for r in rows if r[:2] == (by, node))
    return out


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    rows = [(k % 2, k, *(float(v) for v in rng.normal(0, 20, 3)), float(rng.uniform(0.5, 4)), float(rng.normal())) for k in range(160)]
    rows += [(0, 1000, *rows[0][2:5], 1.0, 7.0), (0, 1001, *rows[0][2:5], 9.0, None)]  # one place, several nodes
    rows += [(1, 1002, 3.0, 4.0, 5.0, 0.0, 2.0), (1, 1003, 3.0, 4.0, 5.0, None, 2.5), (1, 1004, 900.0, 0.0, 0.0, 1.0, 4.0)]
    return rows + rows[20:24]  # rows that come twice


SCHEMA = "by int, node long, x double, y double, z double, velocity double, value double"


@pytest.mark.parametrize("home, visit, together", [(512, 2048, 16), (3, 4, 1), (5, 7, 2)])
def test_smoothing_equals_brute_force(spark, monkeypatch, cloud, home, visit, together):
    for name, size in zip(("HOME", "VISIT", "TOGETHER"), (home, visit, together)):
        monkeypatch.setattr(spatial, name, size)
    got = spatial.smooth(spark.createDataFrame(cloud, SCHEMA), 2.0, 0.5, 3.0, by=["by"]).collect()
    want = brute(cloud, 2.0, 0.5, 3.0)
    assert len(got) == len(cloud) and {(r.by, r.node) for r in got} == set(want)
    for r in got:
        assert r.value == pytest.approx(want[r.by, r.node], rel=1e-9), r


def test_a_value_that_is_no_number_stays_within_reach(spark):
    rows = [(0, 1, 0.0, 0.0, 10.0, 1.0, float("nan")), (0, 2, 0.0, 1.0, 10.0, 1.0, 3.0), (0, 3, 0.0, 30.0, 10.0, 1.0, 5.0)]
    got = {r.node: r.value for r in spatial.smooth(spark.createDataFrame(rows, SCHEMA), 2.0, 2.0, 1.0, by=["by"]).collect()}
    assert np.isnan(got[1]) and np.isnan(got[2]) and got[3] == 5.0


def test_updates_share_the_search(spark, cloud):
    """Parameters of one velocity are smoothed together; the second update finds the tiles written."""
    once = {r[1]: r for r in cloud if r[6] is not None}
    nodes = spark.createDataFrame(list(once.values()), SCHEMA)
    model = nodes.select(F.lit("VPV").alias("param"), "node", "velocity")
    smoother = spatial.ParameterSmoother(nodes, model, ["RHO", "VPV"], 2.0, 0.5, 3.0)
    for factor in 1.0, -3.0:
        update = nodes.select(F.explode(F.array(F.lit("RHO"), F.lit("VPV"))).alias("param"), "node", F.col("value") * factor).toDF("param", "node", "update")
        update = update.withColumn("update", F.when(F.col("param") == "RHO", F.col("update") ** 2).otherwise(F.col("update")))
        got = {(r.param, r.node): r.update for r in smoother(update).collect()}
        for param, power in ("VPV", 1), ("RHO", 2):
            want = brute([(0, *r[1:6], (r[6] * factor) ** power) for r in once.values()], 2.0, 0.5, 3.0)
            assert {n: got[param, n] for n in once} == pytest.approx({n: want[0, n] for n in once}, rel=1e-9)


def test_pairs_are_neither_rows_nor_broadcast(spark, cloud):
    """The places that visit cells are many times their table's size: a broadcast of them fails on the driver."""
    many = spark.createDataFrame(cloud, SCHEMA).withColumn("node", F.col("node") + F.lit(0))
    plan = spatial.smooth(many, 2.0, 0.5, 3.0, by=["by"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line and "_part" in line]
    assert joins and all("strategy=merge" in line for line in joins)


def weighed(own, other, lateral, radial, most, **settings):
    sums, met = np.zeros((len(own[0]), len(other) - 3)), np.zeros(len(own[0]), bool)
    kernels.gaussian_sums(own, other, lateral, radial, sums, met, kernels.near_blocks(own, lateral, radial, most), **settings)
    return sums, met


def squares(own, other, lateral, radial):
    """Squared scaled distance of every node and every place."""
    p, q, v = np.stack(own[:3], axis=1)[:, None], np.stack(other[:3], axis=1)[None], own[3][:, None]
    dr2 = (np.sqrt((p * p).sum(axis=2)) - np.sqrt((q * q).sum(axis=2))) ** 2
    return dr2 / (radial * v) ** 2 + np.maximum(((p - q) ** 2).sum(axis=2) - dr2, 0.0) / (lateral * v) ** 2


@pytest.mark.parametrize("lateral, radial", [(2.0, 0.5), (0.5, 2.0), (1.0, 1.0), (30.0, 0.1)])
@pytest.mark.parametrize("most, settings", [(128, {}), (3, {"shells": 5, "group": 2}), (1000, {"shells": 1, "group": 1})])
def test_shells_leave_nothing_out(lateral, radial, most, settings):
    rng = np.random.default_rng(8)
    own = [*rng.normal(0, 20, (3, 700)) + [[300.0], [0.0], [40.0]], rng.uniform(0.3, 6, 700), rng.integers(1, 3, 700)]
    other = [*rng.normal(0, 25, (3, 900)) + [[300.0], [0.0], [40.0]], rng.normal(size=900), np.zeros(900), np.ones(900)]
    own[3][5], other[3][7] = np.inf, np.inf
    u2 = squares(own, other, lateral, radial)
    w = np.where(u2 <= 9, np.exp(-u2 / 2), 0.0) * own[4][:, None]
    sums, met = weighed(own, other, lateral, radial, most, **settings)
    assert (met == (u2 <= 9).any(axis=1)).all()
    np.testing.assert_allclose(sums[:, 2], w.sum(axis=1), rtol=1e-9)
    assert (sums[:, 1] == 0).all() and (np.isinf(sums[:, 0]) == (u2[:, 7] <= 9)).all()
    finite = np.arange(900) != 7
    np.testing.assert_allclose(sums[u2[:, 7] > 9, 0], (w[:, finite] @ other[3][finite])[u2[:, 7] > 9], rtol=1e-9, atol=1e-9)


def test_a_place_at_three_sigma_is_in_reach():
    """Steps along an axis, all of them exact: the place six steps away is three sigma away."""
    n = np.arange(40.0)
    own = [0 * n, 0 * n, 1000.0 + n, np.full(40, 4.0), np.ones(40)]
    sums, _ = weighed(own, [*own[:3], np.ones(40)], 1.0, 0.5, 7)
    for k in range(40):
        steps = [j for j in range(-6, 7) if 0 <= k + j < 40]
        assert sums[k, 0] == pytest.approx(sum(np.exp(-((j / 2) ** 2) / 2) for j in steps), rel=1e-12)


def test_few_pairs_out_of_reach_are_weighed(monkeypatch):
    """The work is that of the pairs in reach, not of boxes around them."""
    rng = np.random.default_rng(9)
    x, y, z = rng.normal(size=(3, 6000))
    r = rng.uniform(5900, 6400, 6000) / np.sqrt(x * x + y * y + z * z)
    own = [x * r, y * r, z * r, rng.uniform(0.9, 1.9, 6000), np.ones(6000)]
    seen, plain = [], np.exp

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, w, **more):
            seen.append(np.size(w))
            return plain(w, **more)

    monkeypatch.setattr(kernels, "np", Counting())
    weighed(own, [*own[:3], np.ones(6000)], 600.0, 150.0, 32)
    monkeypatch.undo()
    assert sum(seen) < 3 * (squares(own, own, 600.0, 150.0) <= 9).sum()


def test_a_part_of_nodes_is_visited_by_what_it_reaches(spark, monkeypatch):
    """A crowded cell in many parts: places go to the parts near them, not to all parts of the cells around."""
    monkeypatch.setattr(spatial, "HOME", 8)
    monkeypatch.setattr(spatial, "TOGETHER", 4)
    monkeypatch.setattr(spatial, "VISIT", 16)
    rng = np.random.default_rng(10)
    rows = [(k, *(float(v) for v in rng.uniform(0, 64, 3)), 0.55) for k in range(4000)]
    nodes = spark.createDataFrame(rows, "node long, x double, y double, z double, velocity double")
    home = spatial._home_parts(nodes, 10.0, 5.0, 1.0, "velocity", [])
    places, meets = spatial._visitors(home, nodes.select("x", "y", "z"), [])
    assert home.agg(F.sum(F.size("node"))).first()[0] == places.count() == 4000
    assert home.agg(F.max(F.size("node"))).first()[0] <= 64 and home.count() > 60
    visits = places.join(meets, ["size", *spatial.CELL, "_part"]).count()
    assert visits < home.count() * 4000 / 2  # the 27 cells around hold them all
