"""Threshold algorithm against a full scan."""

import math

import numpy as np
import pytest
from helpers import CLASH, CLASH_VALUES
from hypothesis import given, settings
from hypothesis import strategies as st

from seispark.llm import topk


def plain(rows, is_query, k=5):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for at, (q, v) in enumerate(whole):
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for k2, (i, w) in enumerate(whole) if k2 != at and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def awkward_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(70)]
    rows += [(100 + i, [0.5, 0.5, 0.0, -0.5]) for i in range(30)]  # ties
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan"), 0.0, 0.0, 0.0]), (203, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(7, [9.0, 9.0, -9.0, 9.0]), (20, [3.0, 0.0, 1.0, 0.0]), (20, [0.0, 2.0, 2.0, 1.0])]  # ids with several vectors
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (300, [0.0] * 4), (300, [0.0] * 4), (301, [1.0]), (302, [2.0]), (303, []), (304, []), (310, [1.0, 2.0])]
    return rows


@pytest.mark.parametrize("block, together", [(7, 5), (16_384, 2_048)])
def test_same_as_full_scan(spark, block, together):
    rows = awkward_vectors()
    df = spark.createDataFrame([(*r, *CLASH_VALUES) for r in rows], "vec_id long, embedding array<float>, " + CLASH)
    got = topk.top_k(df, lambda i: i % 10 == 0, block=block, together=together)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 10 == 0)


def test_every_row_of_an_id_is_a_candidate(spark):
    rows = [(50, [1.0, 0.0]), (7, [0.0, 0.0]), (7, [1.0, 1.0]), (8, [0.5, 0.0]), (8, [0.5, 0.0]), (100, [0.25, 0.0]), (100, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(df, lambda i: i % 50 == 0).collect()))
    assert (50, 2, 7, 65536) in got and got == plain(rows, lambda i: i % 50 == 0)
    assert [(q, v) for q, _, v, _ in got].count((100, 100)) == 2


def test_no_queries_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(df, lambda i: i > 9).collect() == [] == topk.top_k(df.limit(0), lambda i: i > 0).collect()
    assert [tuple(r) for r in topk.top_k(df, lambda i: i == 1).collect()] == [(1, 1, 2, 256 * 512)]


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60), st.integers(1, 5), st.integers(1, 7))
def test_search_is_exact(seed, n, d, k):
    rng = np.random.default_rng(seed)
    vectors, query, ids = rng.integers(-3, 4, (n, d)), rng.integers(-3, 4, d), rng.permutation(n)
    score, best = topk.threshold_search(query, vectors, ids, topk.sorted_lists(vectors), k, first=2)
    want = sorted((-int(s), int(i)) for s, i in zip(vectors @ query, ids))[:k]
    assert [(-int(s), int(i)) for s, i in zip(score, best)] == want


def test_search_stops_early():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-100, 100, (20_000, 3))
    vectors[7] = [900, 900, 900]

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, np.ndarray) and key.ndim == 1:
                Counted.read += len(key)
            return out

    score, best = topk.threshold_search(np.array([1, 1, 1]), vectors.view(Counted), np.arange(20_000), topk.sorted_lists(vectors), 1)
    assert best.tolist() == [7] and Counted.read < 200
