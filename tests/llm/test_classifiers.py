"""Quality classifier and language mixtures: held-out accuracy, descent and mixtures against plain forms."""

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, with_clash

from seispark.llm import language, ngrams, quality
from seispark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def middle():
    return "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark, middle):
    rows = QUERIES["op2_quality_classifier"](spark, middle).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{middle}/labels.parquet").collect()}
    held = [(r["predicted"], r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, _, y in held]) >= 0.95
    good, bad = [s for _, s, y in held if y], [s for _, s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def test_score_depends_on_the_text_alone(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = with_clash(spark, [(i, "fine words here" if i % 2 else "bad!! stuff!!") for i in range(60)])
    model = quality.train(docs, labels)
    rows = quality.score(with_clash(spark, awkward(300_000) + [(20, "fine words here"), (21, "bad!! stuff!!"), (None, "bad!! stuff!!")]), model).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[20]["predicted"] == 1 and by_id[21]["predicted"] == 0
    assert by_id[1]["score"] == by_id[2]["score"] == by_id[9]["score"]
    assert len(rows) == len(awkward(1)) + 3
    kept = quality.keep_good(with_clash(spark, [(20, "fine words here"), (21, "bad!! stuff!!"), (22, None)]), model)
    assert 21 not in [r["doc_id"] for r in kept.collect()] and "_row" in kept.columns


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0)], [(1, None), (None, 1), (1, 7)]])
def test_quality_without_two_classes(spark, labels):
    docs = with_clash(spark, awkward(10))
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    scores = {r["score"] for r in quality.score(docs, model).collect()}
    assert len(scores) == 1
    assert quality.score(docs.limit(0), model).collect() == []


def test_sample_is_a_bound(spark):
    docs = with_clash(spark, [(i, f"text {i}") for i in range(90)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, quality int")
    assert quality.labelled(docs, labels, 25, "doc_id", "text", "quality").count() <= 25


def test_descent_solves_the_dual():
    """Complementary slackness of the hinge loss holds at the end."""
    rng = np.random.default_rng(1)
    signs = np.where(np.arange(40) % 2, 1, -1)
    vectors = []
    for y in signs:
        x = rng.normal(size=6) + y * np.array([1.5, 0, 0, 0, 0, 0])
        vectors.append((np.arange(6), x / np.linalg.norm(x)))
    w = quality.dual_descent(vectors, signs, 6, cost=1.0, rounds=3000)
    loss = 0.5 * w @ w + sum(max(0, 1 - y * (w[:-1] @ x + w[-1])) for y, (_, x) in zip(signs, vectors))
    for _ in range(300):
        v = w + rng.normal(size=7) * 0.05
        assert loss <= 1e-2 + 0.5 * v @ v + sum(max(0, 1 - y * (v[:-1] @ x + v[-1])) for y, (_, x) in zip(signs, vectors))


def plain_tokens(text):
    kind = lambda b: 0 if b in b" \t\n\x0b\x0c\r" else 1 if b >= 128 or chr(b).isalnum() else 2
    found, last = [], 0
    for b in text.encode():
        k = kind(b)
        if k and k == last:
            found[-1].append(b)
        elif k:
            found.append([b])
        last = k
    return [bytes(t) for t in found]


def test_tokens_and_indicators_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    texts = ["Ab cd!! ab", None, "", "é1 é1 é1 -- x", "Ab", "cd", "a" * 40 + " b"]
    h, row = ngrams.tokens(*ngrams.buffers(pa.array(texts)))
    names = [t for x in texts for t in plain_tokens(x or "")]
    assert row.tolist() == [k for k, x in enumerate(texts) for _ in plain_tokens(x or "")]
    assert len(set(h.tolist())) == len(set(names)) == len(set(zip(h.tolist(), names)))
    long_text = " ".join(f"t{k % 50}" for k in range(4000))
    whole = {tuple(b) for *_, b in ngrams.indicators(pa.array([long_text]), 18)}
    counts = [(b.tolist(), n.tolist()) for *_, b, n in ngrams.trigram_counts(pa.array([long_text]), 16)]
    monkeypatch.setattr(ngrams, "PIECE", 1 << 10)
    monkeypatch.setattr(ngrams.groups, "__defaults__", (1 << 10,))
    monkeypatch.setattr(ngrams.cuts, "__defaults__", (1 << 10,))
    assert {tuple(b) for *_, b in ngrams.indicators(pa.array([long_text]), 18)} == whole
    assert [(b.tolist(), n.tolist()) for *_, b, n in ngrams.trigram_counts(pa.array([long_text]), 16)] == counts


@pytest.mark.parametrize("text", ["alpha\nbeta\n" * 800, "a-b!c?" * 900, "one two  two\tthree!! " * 300, "é" * 5000 + " end", "x x " * 1000])
def test_indicators_of_long_texts_do_not_depend_on_the_piece(monkeypatch, text):
    def found():
        return {tuple(b) for *_, b in ngrams.indicators(pa.array(["before", text, None, "after"]).slice(1, 1), 18)}

    whole = found()
    for size in (16, 100, 1 << 10):
        monkeypatch.setattr(ngrams, "PIECE", size)
        assert found() == whole


def test_language_on_held_out_rows(spark, middle):
    rows = QUERIES["op9_language_mixture"](spark, middle).collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{middle}/documents.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]) >= 0.98


def test_und_and_learned_values(spark, middle):
    model = language.train(spark.read.parquet(f"{middle}/documents.parquet"))
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the and of with"), (5, "é"), (6, "x"), (None, "der und die das"), (7, "the " * 400_000)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(with_clash(spark, rows), model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == got[7][0] == "en" and got[None][0] == "de" and {got[5][0], got[6][0]} <= set(model[0])


def test_language_without_anything_learned(spark):
    docs = with_clash(spark, awkward(10)).selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language.predict(docs, language.train(docs)).collect()} == {"und"}
    assert language.predict(docs.limit(0), language.train(docs.limit(0))).collect() == []


def test_mixture_of_two_languages(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    langs, logs = language.train(docs)
    text = {r["lang"]: r["text"] for r in docs.where("length(text) > 3000").collect()}
    mixed = pa.array([text["en"][:2500] + " " + text["de"][:1500], text["fr"]])
    ((_, _, row, bucket, n),) = ngrams.trigram_counts(mixed, language.BITS)
    share = language.mixtures(row, bucket, n, 2, logs)
    first = dict(zip(langs, share[0].round(2)))
    assert 0.5 < first["en"] < 0.75 and 0.25 < first["de"] < 0.5 and first["es"] == first["fr"] == 0
    assert share[1].tolist() == [float(x == "fr") for x in langs]


def test_expectation_maximisation_against_loops():
    rng = np.random.default_rng(3)
    like, n, row = rng.random((30, 3)), rng.integers(1, 9, 30).astype(float), np.sort(rng.integers(0, 4, 30))
    share, value = language.expectation_maximisation(like, n, row, np.full((4, 3), 1 / 3), rounds=5)
    for d in range(4):
        p = np.full(3, 1 / 3)
        own = np.flatnonzero(row == d)
        for _ in range(5):
            p = sum(n[k] * like[k] * p / (like[k] @ p) for k in own) / n[own].sum()
        assert np.allclose(p, share[d]) and np.isclose(value[d], sum(n[k] * np.log(like[k] @ p) for k in own))
