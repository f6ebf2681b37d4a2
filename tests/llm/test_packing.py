"""Best-fit packing against a piece-by-piece run and a round trip of the texts."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from seispark.llm import packing
from seispark.llm.queries import QUERIES


def plain_contents(length, lengths, claimed, size):
    """Places in ``lengths`` (falling) of what a new bin would hold, the first one a piece of ``length``; claimed ones and pieces of its length before it are out."""
    room, found = size, []
    for i, x in enumerate(lengths):
        if i >= length[1] and (x == length[0] or i not in claimed) and x <= room:
            room -= x
            found.append(i)
    return found


def plain_best_fit(lengths, sizes, overhead=64):
    """Words in each bin and its size, one piece and one bin at a time."""
    room, used, claimed = [], [], set()
    for i, length in enumerate(lengths):
        fits = [b for b, r in enumerate(room) if r >= length]
        if fits:
            b = min(fits, key=lambda x: room[x])
        else:
            views = {s: plain_contents((length, i), lengths, claimed, s) for s in sizes if s >= length}
            words = {s: sum(lengths[k] for k in found) for s, found in views.items()}
            size = min(views, key=lambda s: ((min(x for x in sizes if x >= words[s]) + overhead) / words[s], -s))
            claimed |= {k for k in views[size] if lengths[k] != length}
            room.append(size)
            used.append(0)
            b = len(room) - 1
        room[b] -= length
        used[b] += length
    return used


def padding(used, sizes):
    return sum(min(s for s in sizes if s >= u) - u for u in used)


def words_used(placed):
    spans = {}
    for length, _, count, first, offset in placed:
        for k in range(count):
            spans[first + k] = max(spans.get(first + k, 0), offset + length)
    return list(spans.values())


def test_sizes_that_divide_each_other_mix():
    sizes = (512, 1024, 2048, 4096)
    histogram = [(520, 5), (2100, 6), (1300, 7), (350, 2)]
    used = words_used(packing.plan(histogram, sizes)[0])
    alone = words_used(packing.plan(histogram, sizes[-1:])[0])
    assert sum(used) == sum(alone) == sum(x * n for x, n in histogram)
    opened = {min(s for s in sizes if s >= u) for u in used}
    assert len(opened) > 1 and padding(used, sizes) < padding(alone, sizes[-1:])
    # five pieces of 520 would leave a third of the largest size empty: two bins of less hold them
    assert sorted(words_used(packing.plan([(520, 5)], sizes)[0])) == [1040, 1560]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.sampled_from([(10, 25, 40), (5, 10, 20, 40)]))
def test_plan_places_every_piece_once_and_as_well_as_one_by_one(lengths, sizes):
    histogram = {}
    for x in lengths:
        histogram[x] = histogram.get(x, 0) + 1
    placed, bins = packing.plan(list(histogram.items()), sizes, 3)
    spans = {}
    ranks = {x: set() for x in histogram}
    for length, rank, count, first, offset in placed:
        for k in range(count):
            assert rank + k not in ranks[length]
            ranks[length].add(rank + k)
            spans.setdefault(first + k, []).append((offset, offset + length))
    assert all(ranks[x] == set(range(n)) for x, n in histogram.items())
    for parts in spans.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[-1][1] <= 40
    assert len(spans) == bins
    used = sorted(plain_best_fit(sorted(lengths, reverse=True), sizes, 3))
    assert sorted(parts[-1][1] for parts in spans.values()) == used


def test_plan_follows_the_number_of_lengths():
    placed, bins = packing.plan([(x, 10**9 // x) for x in range(1, 513)], (512, 1024))
    assert len(placed) < 100_000 and bins > 10**6


def rebuilt(rows):
    found = {}
    for r in rows:
        assert r["used"] <= r["size"] and r["used"] == sum(p["length"] for p in r["pieces"])
        assert r["size"] == min(s for s in (4, 8, 16) if s >= r["used"])
        at = 0
        for p in r["pieces"]:
            assert p["offset"] == at
            at += p["length"]
            found.setdefault(p["doc_id"], []).append((p["piece"], p["text"]))
    return {i: [t for _, t in sorted(p)] for i, p in found.items()}


def test_round_trip(spark):
    random.seed(4)
    texts = [" ".join("w%d" % random.randrange(99) for _ in range(random.randrange(60))) for _ in range(40)]
    texts += [None, "", "  \n ", " lead and trail \n\n", "word " * 500, "no\tbreak\x0bhere"]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "null id", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    found = rebuilt(packing.pack(docs, (4, 8, 16), texts=True).collect())
    assert {i: "".join(t) for i, t in found.items()} == {i: t or "" for i, t, _ in rows}


def test_equal_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 50, "doc_id long, text string")
    rows = packing.pack(docs, (4, 8, 16)).collect()
    assert sum(len(r["pieces"]) for r in rows) == 50 and sorted(r["used"] for r in rows) == [8] + [16] * 12
    assert packing.pack(docs.limit(0)).collect() == []


def test_query_holds_every_word(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op7_best_fit_packing"](spark, small).collect()
    words = {r["doc_id"]: len(r["text"].split()) + 1 for r in docs}
    got = {}
    for r in rows:
        for p in r["pieces"]:
            got[p["doc_id"]] = got.get(p["doc_id"], 0) + p["length"]
    assert got == words
    sizes = sorted(packing.SIZES)
    filled = sum(r["used"] for r in rows) / sum(r["size"] for r in rows)
    assert filled > 0.9 and all(r["size"] in sizes for r in rows)
