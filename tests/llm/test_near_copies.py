"""Verified near copies against all pairs of texts by exact similarity."""

import itertools
import random

import numpy as np
import pytest

from seispark.llm import near_copies
from seispark.llm.simhash import fingerprint


def plain_set(text, shingle=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words[k : k + shingle]) for k in range(len(words) - shingle + 1)} or ({tuple(words)} if words else set())


def plain_alike(a, b, similarity=0.8):
    return a == b or len(a & b) >= similarity * len(a | b)


def plain_groups(rows, radius, similarity=0.8):
    """Smallest row reachable over links between any two rows (id, text)."""
    sets = [plain_set(t) for _, t in rows]
    prints = [np.frombuffer(fingerprint((t or "").encode(), 5, 2, 7), np.uint64) for _, t in rows]
    label, changed = list(range(len(rows))), True
    links = [
        (a, b)
        for a, b in itertools.combinations(range(len(rows)), 2)
        if np.bitwise_count(prints[a] ^ prints[b]).sum() <= radius and plain_alike(sets[a], sets[b], similarity)
    ]
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def near_rows(groups=6, copies=9, words=60, seed=3):
    """Groups of texts around bases, changed more and more, so that pairs lie on both sides of 0.8."""
    random.seed(seed)
    rows = []
    for _ in range(groups):
        base = ["w%d" % random.randrange(500) for _ in range(words)]
        for k in range(copies):
            text = list(base)
            for at in random.sample(range(words), k % 4):
                text[at] = "x%d" % random.randrange(500)
            rows.append((len(rows), " ".join(text)))
    return [*rows, (900, ""), (901, None), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, "one three"), (None, rows[0][1]), (None, "alone it stands here without any id")]


def grouped(pairs):
    found = {}
    for row, root in pairs:
        found.setdefault(root, []).append(row)
    return sorted((sorted(g, key=str) for g in found.values()), key=str)


@pytest.mark.parametrize(("tile", "fan", "first"), [(4096, 8, 4), (7, 2, 1)])
def test_same_groups_as_all_pairs(spark, monkeypatch, tile, fan, first):
    monkeypatch.setattr(near_copies, "FIRST", first)
    monkeypatch.setattr(near_copies, "GROWTH", 2)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_copies.near_copies(docs, tile=tile, fan=fan, radius=40).collect()
    want = plain_groups(rows, 40)
    assert len(set(want)) > 20 and len(got) == len(rows)
    hashed = {(r["_id"], r["_h"]): r["root"] for r in got}
    keys = {(r["_id"], r["_h"]) for r in got}
    marked = docs.select("doc_id", "text", *near_copies.row_key("doc_id", "text")[:2]).collect()
    assert keys == {(r["_id"], r["_h"]) for r in marked}
    place = {(r["doc_id"], r["text"]): hashed[r["_id"], r["_h"]] for r in marked}
    assert grouped((row, place[row]) for row in rows) == grouped(zip(rows, want))


def test_candidates_that_are_not_alike_do_not_hide_those_that_are(spark, monkeypatch):
    """Many texts share about 0.7 with each other; two of them are near copies."""
    monkeypatch.setattr(near_copies, "FIRST", 1)
    monkeypatch.setattr(near_copies, "GROWTH", 2)
    random.seed(8)
    base = ["b%d" % k for k in range(100)]
    texts = []
    for k in range(25):
        own = list(base)
        for at in range(3):
            own[k * 3 % 90 + at * 3] = f"own{k}-{at}"
        texts.append(" ".join(own))
    texts.append(texts[11] + " tail")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in near_copies.one_of_each(docs, radius=64).collect())
    want = plain_groups(list(enumerate(texts)), 64)
    assert kept == sorted(set(want)) and 25 not in kept


def test_group_near_but_not_alike_names_links_by_its_texts(spark, monkeypatch):
    """Two words of each text are its own, so that pairs share about 0.65: no link connects them, and their pairs end in the tiles."""
    random.seed(12)
    base, texts = ["b%d" % k for k in range(100)], []
    for k in range(150):
        own = list(base)
        for at in random.sample(range(100), 2):
            own[at] = f"own{k}-{at}"
        texts.append(" ".join(own))
    rows = list(enumerate([*texts, texts[3] + " tail", "tail " + texts[140]]))
    listed, verified = [], near_copies.verified

    def counted(links, *others):
        listed.append(links.count())
        return verified(links, *others)

    monkeypatch.setattr(near_copies, "verified", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in near_copies.one_of_each(docs, radius=64).collect())
    assert kept == sorted(set(plain_groups(rows, 64))) and not {150, 151} & set(kept)
    assert len(rows) < sum(listed) <= (near_copies.FIRST + 1) * len(rows)


def test_sketches_rule_out_only_sets_that_are_not_alike():
    rng = np.random.default_rng(4)
    sets = [np.zeros(0, np.uint64)]
    for size in 1, 9, 90, 900, 9000:
        base = rng.integers(0, 2**63, size, np.uint64)
        for part in 0, 0.05, 0.1, 0.112, 0.2, 0.5, 1:
            other = base.copy()
            other[: int(size * part)] = rng.integers(0, 2**63, int(size * part), np.uint64)
            sets += [np.unique(other), np.unique(other[int(size * part) :])]
    rows = np.stack([np.frombuffer(near_copies.sketch(s), ">u8").astype(np.uint64) for s in sets])
    i, j = (x.ravel() for x in np.indices((len(sets), len(sets))))
    for similarity in 0.5, 0.8, 0.9, 1.0:
        left = near_copies.may_be_alike(rows, rows, i, j, similarity)
        true = np.array([near_copies.alike(sets[a], sets[b], similarity) for a, b in zip(i, j)])
        assert not (true & ~left).any() and true.sum() >= len(sets) and left.sum() < len(left) / 2
        small = np.array([max(len(sets[a]), len(sets[b])) < 200 for a, b in zip(i, j)])
        assert (left & ~true & small).sum() <= 0.05 * small.sum()


def test_columns_repeated_rows_and_empty_table(spark):
    rows = [(1, "a text of more than five words", 2)] * 40 + [(None, None, 3), (2, "another text that has more words", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h int")
    kept = near_copies.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(kept.collect(), key=str) == sorted({tuple(r) for r in rows}, key=str)
    assert near_copies.one_of_each(docs.limit(0)).collect() == []


def test_sets():
    assert len(near_copies.shingle_set(b"", 5)) == 0 and len(near_copies.shingle_set(b"a B", 5)) == 1
    a, b = (near_copies.shingle_set(t, 5) for t in (b"a b c d e f g h", b"A b  c d e f g h i"))
    assert len(a) == 4 and len(b) == 5 and near_copies.alike(a, b, 0.8) and not near_copies.alike(a, b[1:], 0.8)


def test_links_shortened_connect_the_same(spark):
    random.seed(5)
    chain = [(k, k + 1) for k in range(-40, 40)]
    links = [*chain, *[(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(90)], (7, 7), (2000, 2000)]
    near = {x: {x} for link in links for x in link}
    for a, b in links:
        both = near[a] | near[b]
        for x in both:
            near[x] = both
    least = {x: min(group) for x, group in near.items()}
    a, b = near_copies.forest(*(np.array(ends) for ends in zip(*links)))
    assert dict(zip(a.tolist(), b.tolist())) == {x: m for x, m in least.items() if x != m}
    table = spark.createDataFrame(links, "a long, b long")
    for size in 1, 7, 1000:
        found = near_copies.relabelled(None, near_copies.shortened(table, size)).collect()
        assert {r["_h"]: r["root"] for r in found} == {x: m for x, m in least.items() if len(near[x]) > 1}
    assert near_copies.shortened(table.limit(0)).count() == 0
