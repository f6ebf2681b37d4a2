"""The pipeline stage by stage against plain forms of each stage."""

import corpus_pipeline
import pytest
from helpers import awkward, with_clash
from test_decontaminate import plain_leaks
from test_line_dedup import plain as plain_lines
from test_near_copies import plain_alike, plain_groups, plain_set

from seispark.llm import quality
from seispark.session import materialise

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, small):
    """What each stage returned, in order, the documents first."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, small), name.replace(" ", "-"))
        out.append(docs.collect())
    return out


def test_stages_in_order():
    assert list(STAGES) == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_all_but_the_last_keep_the_columns(results):
    assert all(r.__fields__ == COLUMNS for rows in results[:-1] for r in rows[:1])


def test_quality(spark, small, results):
    before, after = results[0], results[1]
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    good = {r["doc_id"] for r in quality.score(docs, quality.train(docs, labels)).collect() if r["predicted"] == 1}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if r["doc_id"] in good)
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert {r["doc_id"] for r in before if label.get(r["doc_id"]) == 1} <= good | {-1}


def test_line_dedup(results):
    want = {i: t for i, _, _, t in plain_lines([(r["doc_id"], r["text"]) for r in results[1]])}
    assert {r["doc_id"]: r["text"] for r in results[2]} == want and all(r["n_chars"] == len(r["text"]) for r in results[2])


def test_near_copies(results):
    rows = [(r["doc_id"], r["text"]) for r in results[2]]
    label = plain_groups(rows, corpus_pipeline.NEAR["radius"], corpus_pipeline.NEAR["similarity"])
    assert sorted(r["doc_id"] for r in results[3]) == sorted(min(i for (i, _), x in zip(rows, label) if x == root) for root in set(label))
    sets = {i: plain_set(t) for i, t in rows}
    gone = set(sets) - {r["doc_id"] for r in results[3]}
    assert all(any(plain_alike(sets[i], sets[j]) for j in sets if j != i) for i in gone)


def test_leaks(spark, small, results):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    bad = {d for d, _ in plain_leaks([(r["doc_id"], r["text"]) for r in results[3]], items)}
    assert sorted(r["doc_id"] for r in results[4]) == sorted(r["doc_id"] for r in results[3] if r["doc_id"] not in bad)


def test_packing(results):
    found = {}
    for r in results[5]:
        assert r["used"] == sum(p["length"] for p in r["pieces"]) <= r["size"]
        for p in r["pieces"]:
            found.setdefault(p["doc_id"], []).append((p["start"], p["text"]))
    assert {i: "".join(t for _, t in sorted(p)) for i, p in found.items()} == {r["doc_id"]: r["text"] for r in results[4]}


def test_run_gives_the_last_stage(spark, small, results):
    def flat(rows):
        return sorted((r["size"], r["used"], [tuple(p) for p in r["pieces"]]) for r in rows)

    assert flat(corpus_pipeline.run(spark, small).collect()) == flat(results[-1])


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_rows(spark, small, name):
    docs = with_clash(spark, awkward(5000)).withColumnRenamed("length", "n_chars")
    out = STAGES[name](spark, materialise(docs, "awkward"), small)
    if name != "best-fit packing":
        assert out.columns == docs.columns
        ids = {r["doc_id"] for r in out.collect()}
        assert ids <= {i for i, _ in awkward(1)}
    else:
        assert sum(len(r["pieces"]) for r in out.collect()) >= len(awkward(1))
    assert STAGES[name](spark, docs.limit(0), small).collect() == []
