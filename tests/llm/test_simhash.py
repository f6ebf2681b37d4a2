"""SimHash near-duplicates against plain loops."""

import itertools
import re

import pytest
import xxhash

from seispark.llm import simhash
from seispark.llm.queries import QUERIES


def plain_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """prints: (id, fingerprint) pairs; smallest reachable id of each."""
    label = [i for i, _ in prints]
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(len(prints)), 2):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= radius and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def near_rows(spark):
    base = "the quick brown fox jumps over the lazy dog while seven wise men watch from the far river bank at dawn " * 6
    rows = [(1, base), (2, base + "x"), (3, base.upper()), (4, ""), (5, None), (6, "  \t\n"), (7, "one two"), (8, "One TWO three É"), (8, "One TWO three É"), (9, "É é"), (10, base.replace("dog", "cat"))]
    return spark.createDataFrame([(i, t, "u", 3) for i, t in rows], "doc_id long, text string, _fp string, component int"), rows


def test_same_as_loops_on_edge_cases(spark):
    docs, rows = near_rows(spark)
    got = sorted((r["_id"], int(r["_fp"].hex(), 16), r["component"]) for r in simhash.near_duplicates(docs).collect())
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    assert got == sorted((i, f, c) for (i, f), c in zip(prints, plain_components(prints, 3)))


@pytest.mark.parametrize("tile", [3, 4096])
def test_query_rule_on_the_small_table(spark, small, tile):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    want = {i: (f, c) for (i, f), c in zip(prints, plain_components(prints, 3))}
    got = simhash.near_duplicates(docs, tile=tile).collect()
    assert {r["_id"]: (int(r["_fp"].hex(), 16), r["component"]) for r in got} == want and len(got) == len(rows)


def test_query_columns(spark, small):
    rows = QUERIES["op4_simhash_near_dedup"](spark, small).collect()
    assert len(rows) == 200 and all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) and r["component_id"] <= r["doc_id"] for r in rows)


def test_one_of_each_keeps_one_row_and_all_columns(spark):
    docs, rows = near_rows(spark)
    docs = docs.unionByName(docs)
    kept = simhash.one_of_each(docs)
    found = kept.collect()
    assert kept.columns == docs.columns
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    assert sorted(r["doc_id"] for r in found) == sorted(set(plain_components(prints, 3)))


def test_one_of_each_keeps_unrelated_texts_of_one_id(spark):
    texts = [" ".join(f"{word}{k}" for k in range(40)) for word in ("red", "green", "blue", "grey", "pink")]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1].upper()), (None, texts[2]), (7, texts[2]), (8, texts[3]), (8, texts[4]), (9, texts[4]), (9, texts[4])]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r["doc_id"] or 0, r["text"].lower()) for r in kept)
    assert found == sorted([(0, texts[0]), (0, texts[1]), (0, texts[2]), (8, texts[3]), (8, texts[4])])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == [] and simhash.one_of_each(docs).collect() == []
