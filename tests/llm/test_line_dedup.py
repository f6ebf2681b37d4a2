"""Line dedup against plain loops."""

import hashlib
from collections import defaultdict

import pytest
from helpers import awkward, with_clash

from seispark.llm import line_dedup


def plain(rows, min_docs=2, min_chars=10):
    least = -(2**63)
    holders = defaultdict(set)

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(least if i is None else i)
    out = []
    for i, t in rows:
        own = least if i is None else i
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and own != min(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_same_as_loops(spark, min_docs):
    rows = awkward() + [(11, "Twin line of text\nlast\n"), (12, "\n".join(f"line number {k % 40}" for k in range(3000)))]
    got = line_dedup.drop_repeated_lines(with_clash(spark, rows), min_docs=min_docs).collect()
    assert sorted(((r["_row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got), key=str) == plain(rows, min_docs)


def test_stage_returns_the_columns_with_new_texts(spark):
    docs = with_clash(spark, awkward()).withColumnRenamed("length", "n_chars")
    out = line_dedup.stage(docs)
    assert out.columns == docs.columns
    found = out.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found) and len(found) == len(awkward())
    assert sorted(str(r["_id"]) for r in found) == ["x"] * len(found)


def test_empty_table(spark):
    assert line_dedup.drop_repeated_lines(with_clash(spark, [])).collect() == []


def test_query_digest(spark, small):
    from seispark.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(rows))
    got = QUERIES["op1_line_dedup"](spark, small).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == want
