"""Decontamination: the index against full scoring, and leaks planted in texts."""

import collections
import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from helpers import awkward, with_clash

from seispark.llm import decontaminate, ngrams
from seispark.llm.queries import QUERIES


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def plain_impacts(items):
    bags = {i: collections.Counter(words(t)) for i, t in items if i is not None and words(t)}
    mean = np.mean([sum(b.values()) for b in bags.values()])
    df = collections.Counter(t for b in bags.values() for t in b)
    out = {}
    for i, b in bags.items():
        size = sum(b.values())
        w = {t: math.log(1 + (len(bags) - df[t] + 0.5) / (df[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean)) for t, n in b.items()}
        out[i] = {t: x / sum(w.values()) for t, x in w.items()}
    return out


def some_items(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)]
    return [(k, " ".join(rng.choices(vocabulary, k=rng.randint(3, 25))).capitalize() + ". " + " ".join(rng.choices(vocabulary, k=rng.randint(1, 6))) + ".") for k in range(n)]


def index_of(spark, items):
    df = spark.createDataFrame(items, "item_id long, text string")
    texts, terms = decontaminate.item_terms(df, "item_id", "text")
    postings = decontaminate.impacts(terms).toPandas()
    known = {r["_item"]: r["_text"] for r in texts.collect()}
    return decontaminate.Index(postings, {i: known[i] for i in postings["item"].unique().tolist()}), postings


def test_impacts_and_block_max_wand(spark, monkeypatch):
    items = some_items() + [(900, None), (901, "..."), (None, "no id")]
    want = plain_impacts([x for x in items if x[0] is not None])
    for size in (7, 64):
        monkeypatch.setattr(decontaminate, "BLOCK", size)
        index, postings = index_of(spark, items)
        assert len(postings) == sum(map(len, want.values())) and sorted(index.items.tolist()) == sorted(want)
        rng = random.Random(size)
        queries = [{f"w{rng.randrange(130)}" for _ in range(rng.randint(1, 60))} for _ in range(60)]
        h, row = ngrams.tokens(*ngrams.buffers(pa.array([" ".join(sorted(q)) for q in queries])), decontaminate.WORDS_ONLY)
        terms = index.terms(h)
        for least in (0.05, 0.3, 0.6):
            got = {(k, int(index.items[s])): v for k, s, v in index.retrieve(row[terms >= 0], terms[terms >= 0], 60, least)}
            full = {(k, i): sum(x for t, x in w.items() if t in q) for k, q in enumerate(queries) for i, w in want.items()}
            full = {i: x for i, x in full.items() if x >= least}
            assert full and got.keys() == full.keys() and all(abs(got[i] - full[i]) < 1e-9 for i in got)


def plain_leaks(rows, items):
    out = set()
    for d, t in rows:
        w = words(t)
        for i, text in items:
            ok = bool(words(text))
            for part in decontaminate.parts_of(text):
                p = words(part)
                n = min(5, len(p))
                have = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
                runs = {tuple(p[k : k + n]) for k in range(len(p) - n + 1)} if p else set()
                ok &= not runs or len(runs & have) >= 0.8 * len(runs)
            if ok:
                out.add((d, i))
    return out


@pytest.mark.parametrize("part", [7, 20_000])
def test_planted_leaks_are_found_and_nothing_else(spark, part):
    rng = random.Random(9)
    filler = [f"f{k}" for k in range(500)] + [f"w{k}" for k in range(120)]
    items = [(k, t) for k, t in some_items(40) if len(words(t)) >= 10]
    rows = [(r[0], r[1]) for r in awkward(3000)]
    for d in range(100, 160):
        before, after = (rng.choices(filler, k=rng.randint(0, 400)) for _ in range(2))
        leak = rng.choice(items)[1] if d % 2 else ""
        rows.append((d, " ".join(before) + " " + leak.upper() + " " + " ".join(after)))
    rows.append((170, " ".join(rng.choices(filler, k=300_000)) + " " + items[0][1]))
    df = spark.createDataFrame(items + items[:3] + [(None, "x y z"), (800, None), (801, "")], "item_id long, text string").withColumnRenamed("text", "_text")
    found = decontaminate.find_leaks(with_clash(spark, rows), df.withColumnRenamed("_text", "text"), part=part).collect()
    got = {(r["_id"], r["item_id"]) for r in found}
    assert got == plain_leaks([r for r in rows if r[0] is not None], items) and len(found) == len(got) >= 25


def test_query_and_stage(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_benchmark_decontamination"](spark, small).collect()}
    want = plain_leaks([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert got == want and got
    left = decontaminate.without_leaks(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] not in {d for d, _ in want})


def test_long_items_are_found(spark):
    rng = random.Random(4)
    known = [f"n{k}" for k in range(4000)]
    sizes = [60, 65, 90, 128, 200, 256, 500, 1000, 2000]
    items = [(k, " ".join(rng.choices(known, k=n - 3)) + ". Answer of three.") for k, n in enumerate(sizes)]
    rows = [(k, " ".join(rng.choices(known, k=150)) + " " + t + " " + " ".join(rng.choices(known, k=150))) for k, t in items]
    # every 30th word another one: 0.83 of the runs are left; every 20th: 0.75
    rows += [(100 + k, " ".join("changed" if at % 30 == 29 and at < n - 3 else w for at, w in enumerate(t.split()))) for (k, t), n in zip(items, sizes)]
    rows += [(200 + k, " ".join("changed" if at % 20 == 9 and at < n - 3 else w for at, w in enumerate(t.split()))) for (k, t), n in zip(items, sizes)]
    rows += [(300 + k, t[: len(t) // 2]) for k, t in items]
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["_id"], r["item_id"]) for r in found}
    assert got == plain_leaks(rows, items) >= {(d + k, k) for d in (0, 100) for k in range(len(items))} and len(found) == len(got)


def test_shuffled_copy_before_a_verbatim_one(spark):
    rng = random.Random(6)
    rows, items = [], []
    for k, n in enumerate([12, 40, 64, 100, 128, 400]):
        own = [f"i{k}w{j}" for j in range(n)]
        items.append((k, " ".join(own)))
        between = [f"f{j}" for j in range(3 * n + 2000)]
        rows += [(k, " ".join(rng.sample(own, n) + between + own)), (100 + k, " ".join(own + between + rng.sample(own, n))), (200 + k, " ".join(rng.sample(own, n) + between))]
        rows.append((300 + k, " ".join(rng.sample(own, n) + between + rng.sample(own, n) + between[:70] + own)))
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["_id"], r["item_id"]) for r in found) == sorted((d + k, k) for d in (0, 100, 300) for k in range(len(items)))


def test_items_with_one_id_and_without(spark):
    texts = [" ".join(f"t{k}w{j}" for j in range(20)) for k in range(5)]
    items = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (2, texts[4]), (2, texts[4])]
    rows = [(k, f"before {t} after") for k, t in enumerate(texts)] + [(9, "none of them")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    for part in (2, 4000):
        found = decontaminate.find_leaks(docs, items, part=part).collect()
        assert sorted((r["_id"], r["item_id"]) for r in found) == [(0, 1), (1, 1), (2, None), (3, None), (4, 2)]
    assert [r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()] == [9]


def test_pieces_hold_every_run_once():
    sizes = np.array([0, 1, 4, 5, 64, 65, 124, 125, 1999])
    item, piece, first, last = decontaminate.pieces(sizes)
    for k, n in enumerate(sizes):
        own = item == k
        assert (last - first)[own].max() <= decontaminate.PIECE_WORDS and piece[own].tolist() == list(range(own.sum()))
        starts = [at for a, b in zip(first[own], last[own]) for at in range(a, b - decontaminate.RUN + 1)]
        assert starts == list(range(n - decontaminate.RUN + 1)) and first[own][0] == 0 and last[own][-1] == n


def test_empty_tables(spark):
    docs, items = with_clash(spark, awkward(10)), spark.createDataFrame(some_items(5), "item_id long, text string")
    assert decontaminate.find_leaks(docs.limit(0), items).collect() == []
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []
    assert decontaminate.without_leaks(docs, items.limit(0)).count() == len(awkward(10))


def test_passages_cover_every_word():
    row = np.repeat([0, 2, 3, 5], [1, 128, 129, 1000])
    first, last = decontaminate.passages(row)
    seen = np.zeros(len(row), int)
    for a, b in zip(first, last):
        assert row[a] == row[b - 1] and b - a <= decontaminate.PASSAGE
        seen[a:b] += 1
    assert seen.min() >= 1
    for start in range(0, len(row) - 64):  # 64 words in a row always lie in one passage
        if row[start] == row[start + 63]:
            assert any(a <= start and start + 64 <= b for a, b in zip(first, last))


def test_bounds_hold_for_a_frame_without_rows():
    index = decontaminate.Index(pd.DataFrame({"item": [], "term": [], "impact": []}), {})
    none = np.zeros(0, np.int64)
    assert index.retrieve(none, none, 3, 0.5) == [] and index.terms(np.array([5], np.uint64)).tolist() == [-1]


@pytest.mark.parametrize("blank", ["\n", " ", "-", "\u3000"])
def test_leaks_across_every_cut_of_a_long_text(monkeypatch, blank):
    """Copies of an item over every place where a long text may be cut into pieces."""
    monkeypatch.setattr(ngrams, "PIECE", 512)
    item = blank.join(f"leak{k}" for k in range(10))
    filler = blank.join(f"f{k}" for k in range(7))
    texts = [filler * 40 + blank + "x" * k + blank + item + blank + filler * 60 for k in range(0, 130, 3)]
    words = decontaminate.WORDS_ONLY
    for text in texts:
        data, offsets = ngrams.buffers(pa.array([text]))
        got, _ = ngrams.token_hashes(data, offsets, words)
        assert got.tolist() == ngrams.tokens(data, offsets, words)[0].tolist()


def test_leaks_in_a_text_of_lines_over_a_mebibyte(spark):
    item = "\n".join(f"leak{k}word" for k in range(10))
    filler = "\n".join(f"filler{k}" for k in range(40))
    half = filler + ("\n" + filler) * ((1 << 19) // len(filler))
    near = [half[: (1 << 19) - 60 + 7 * k].rsplit("\n", 1)[0] for k in range(8)]
    rows = [(k, f"{a}\n{half[: 1 << 19]}\n{item}\n{half}") for k, a in enumerate(near)]
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(r["_id"] for r in found.collect()) == list(range(8))
