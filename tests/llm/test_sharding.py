"""Extendible hashing: buckets split one by one give the same shards."""

import hashlib
from collections import defaultdict

import pytest
from helpers import awkward, with_clash

from seispark.llm import sharding


def plain(rows, limit):
    """{shard: ids}; splits a bucket on its next bit as long as it is too large."""
    hashed = [(int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16), i, len((t or "").encode())) for i, t in rows]
    done, todo = {}, [("", hashed)]
    while todo:
        name, part = todo.pop()
        if sum(n for *_, n in part) <= limit or len(name) == 60:
            if part:
                done[name] = sorted(str(i) for _, i, _ in part)
            continue
        for bit in "01":
            todo.append((name + bit, [p for p in part if f"{p[0]:060b}"[len(name)] == bit]))
    return done


@pytest.mark.parametrize("step", [2, 7, 16])
def test_same_as_splitting_one_by_one(spark, step):
    rows = [(i, "word " * (i % 37)) for i in range(300)] + [(None, "nul"), (3, None), (500, "")]
    got = defaultdict(list)
    for r in sharding.shard(with_clash(spark, rows), 900, step=step).collect():
        got[r["shard"]].append("None" if r["_id"] == sharding_null() else str(r["_id"]))
        assert r["depth"] == len(r["shard"]) and r["shard_bytes"] <= 900
    assert {k: sorted(v) for k, v in got.items()} == plain(rows, 900)


def sharding_null():
    from seispark.llm.text import NULL_ID

    return NULL_ID


def test_one_key_over_the_limit_goes_to_pages(spark):
    rows = [(7, "x" * 100)] * 50 + [(8, "y" * 2000)] + [(9, "z")] * 3 + awkward(100)
    got = sharding.shard(with_clash(spark, rows), 1000, step=20).collect()
    assert len(got) == len(rows)
    total, single = defaultdict(int), defaultdict(int)
    for r in got:
        total[r["shard"]] += r["n_bytes"]
        single[r["shard"]] += 1
        assert r["shard_bytes"] <= 1000 or r["n_bytes"] > 1000
    assert all(n <= 1000 or single[s] == 1 for s, n in total.items())


def test_small_and_empty_tables_are_one_shard_or_none(spark):
    assert {r["shard"] for r in sharding.shard(with_clash(spark, awkward(10)), 1 << 20).collect()} == {""}
    assert sharding.shard(with_clash(spark, []), 10).collect() == []


def test_write_shards(spark, tmp_path):
    docs = with_clash(spark, [(i, "t" * i) for i in range(60)])
    found = sharding.shard(docs, 400).withColumnRenamed("_id", "doc_id")
    path = sharding.write_shards(found.select("doc_id", "shard", "n_bytes"), str(tmp_path / "shards"))
    back = spark.read.schema("doc_id long, n_bytes long, shard string").parquet(path)
    assert back.groupBy("shard").sum("n_bytes").where("`sum(n_bytes)` > 400").isEmpty() and back.count() == 60
