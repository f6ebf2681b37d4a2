"""Hybrid search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, with_clash
from hypothesis import given, settings
from hypothesis import strategies as st

from seispark.llm import ngrams, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        found = []
        for i, c in counted:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
            if score > 0:
                found.append((-score, i is not None, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    items = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, doc_id int, score int")
    return sorted(map(tuple, ranked.top_documents(with_clash(spark, docs), items, **options).collect()), key=str)


DOCS = awkward() + [(20 + j, " ".join(f"t{(j * k) % 23} x{j % 5}" for k in range(j % 17))) for j in range(150)] + [(9, "t1 t2"), (9, "t1 t2"), (None, "t3 t2")]
ITEMS = [(1, "t1 T2 t2 x3"), (1, "w5 and line"), (2, None), (3, ""), (4, "nothing here"), (None, "é line"), (5, "t1 T2 t2 x3"), (5, "t1 T2 t2 x3"), (6, " ".join(f"t{k}" for k in range(23)))]


@pytest.mark.parametrize("options", [{}, {"k": 3, "block": (20, 100), "together": 3}, {"block": (7, 1 << 20), "together": 1}])
def test_same_as_scoring_everything(spark, options):
    assert run(spark, DOCS, ITEMS, **options) == plain(DOCS, ITEMS, options.get("k", 10))


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == [] == run(spark, DOCS, [])
    assert run(spark, [(1, None), (2, "- !")], ITEMS) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700), st.integers(1, 12), st.integers(1, 12), st.integers(0, 2**32 - 1))
def test_skipping_loses_nothing(docs, terms, k, seed):
    random = np.random.default_rng(seed)
    place = [np.flatnonzero(random.random(docs) < p) for p in random.choice([0.01, 0.05, 0.5, 0.9], terms)]
    term = np.repeat(np.arange(terms), [len(p) for p in place])
    doc = np.concatenate(place)
    tf, norm = random.integers(1, 4, len(doc)), random.integers(25, 200, docs)
    weight = random.integers(0, 3000, terms)
    lists = ranked.Lists(docs, np.arange(terms), weight, (term, doc), tf, norm)
    times = random.integers(1, 3, terms)
    score = np.zeros(docs, np.int64)
    np.add.at(score, doc, (times * weight)[term] * ((10**9 * tf) // (1000 * tf + 8 * norm[doc])))
    want = sorted((-s, d) for d, s in enumerate(score.tolist()) if s > 0)[:k]
    got = ranked.hybrid_search(lists, np.arange(terms), times, k)
    assert [(-s, d) for d, s in zip(*map(np.ndarray.tolist, got))] == want


@pytest.mark.parametrize("sep", [" ", "\n", "-"])
def test_terms_of_long_texts(monkeypatch, sep):
    import pyarrow as pa

    monkeypatch.setattr(ngrams, "PIECE", 64)
    texts = [sep.join(f"Word{k}é" for k in range(60)), "x" * 300 + sep + "end", None, "short" + sep + "text"]
    got = {}
    for lo, _, hashes, row in ranked.terms_of(pa.array(texts)):
        for h, r in zip(hashes.tolist(), row.tolist()):
            got.setdefault(lo + r, []).append(h)
    for r, t in enumerate(texts):
        one = [ngrams.tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]), ranked.TERM)[0][0] for w in words(t)]
        assert got.get(r, []) == one
