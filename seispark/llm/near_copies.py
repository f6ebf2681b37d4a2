"""Near copies: SimHash tiles give candidates, exact similarity of shingle sets decides."""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from seispark.llm.components import components
from seispark.llm.simhash import SEED, cell_of, fingerprint, neighbours
from seispark.llm.text import row_key, with_fields
from seispark.session import materialise

#: Candidates that a text names in one group of tiles in the first round; each round names so many times more.
FIRST, GROWTH = 16, 16
#: Bits of a sketch, one for each remainder of the hashes.
BITS = 512
#: Links that one task shortens at a time.
SHORTEN = 1 << 18
KEY = ["_c", "_s", "_k"]


def shingle_set(text, shingle):
    """Sorted distinct shingle hashes of a text given as bytes; with fewer words its whole sequence is the one shingle, without words there is none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in parts), np.uint64))


def alike(a, b, similarity):
    """Whether two sorted sets of hashes share that part of their union; two empty sets do."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def sketch(hashes):
    """Size of a set of hashes, then for each remainder by ``BITS`` whether an odd number of them leaves it; as bytes."""
    odd = np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return len(hashes).to_bytes(8, "big") + np.packbits(odd.astype(np.uint8)).tobytes()


def may_be_alike(a, b, i, j, similarity):
    """False only for rows ``i`` of sketches ``a`` and ``j`` of ``b`` whose sets are not alike.

    Each hash that only one of two sets holds changes one bit, and their sizes by one: neither the bits that differ nor
    the difference of sizes is more than the number of such hashes.
    """
    own, other = a[i, 0].astype(np.int64), b[j, 0].astype(np.int64)
    bits = np.zeros(len(i), np.int64)
    for k in range(1, a.shape[1]):
        bits += np.bitwise_count(a[i, k] ^ b[j, k])
    total, apart = own + other, np.maximum(bits, np.abs(own - other))
    return total - apart >= similarity * (total + apart)


def sets_of(named, docs, shingle, text_col, form):
    """(_h, _set) of the texts that ``named`` (_h) names; ``form`` makes bytes of the sorted hashes."""
    _, h, text = row_key(text_col, text_col)
    rows = docs.select(h, text).join(named, "_h", "left_semi").groupBy("_h").agg(F.first("_text").alias("_text"))

    def work(batches):
        for batch in batches:
            found = [form(shingle_set(t or b"", shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["_h", "_set"])

    return rows.select("_h", F.col("_text").cast("binary")).mapInArrow(work, "_h long, _set binary")


def distinct_texts(docs, shingle, lanes, least, id_col, text_col):
    """(_id, _h, _fp, _cell) of every row: text hash, fingerprint, and the fingerprint's population count."""

    def work(batches):
        for batch in batches:
            prints = [fingerprint(t or b"", shingle, lanes, least) for t in batch.column(2).to_pylist()]
            raw = np.frombuffer(b"".join(prints), np.uint8).reshape(-1, 8 * lanes)
            cells = cell_of(raw, 1) if len(raw) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.binary()), pa.array(cells, pa.int64())], ["_id", "_h", "_fp", "_cell"]
            )

    ident, h, text = row_key(id_col, text_col)
    return docs.select(ident, h, text.cast("binary")).mapInArrow(work, "_id long, _h long, _fp binary, _cell long")


def tiles_of(texts, sizes):
    """Texts (_h, _fp, _cell, _label, _sketch) of each tile as one value: fingerprint, text hash, label and sketch in a row of longs."""
    row = F.concat(F.hex("_fp"), F.lpad(F.hex("_h"), 16, "0"), F.lpad(F.hex("_label"), 16, "0"), F.hex("_sketch"))
    dealt = texts.join(F.broadcast(sizes), "_cell").withColumn("_sub", F.pmod(F.xxhash64("_h"), F.col("_subs")))
    return dealt.groupBy("_cell", "_sub").agg(F.unhex(F.array_join(F.collect_list(row), "")).alias("_tile"))


def meetings(tiles, sizes, radius, lanes, fan):
    """Each tile at home and up to ``fan`` visiting tiles of each cell under one key; two tiles meet once."""
    most = sizes.agg(F.max("_subs")).first()[0] or 0
    chunks = F.sequence(F.lit(0), F.lit(max(0, (most - 1) // fan)).cast("long"))
    home = tiles.select(F.col("_cell").alias("_c"), F.col("_sub").alias("_s"), F.explode(chunks).alias("_k"), F.lit(0).alias("_side"), "_cell", "_sub", "_tile")
    steps = F.array(*[F.lit(d).cast("long") for d in neighbours(1, 64 * lanes, radius) if d >= 0])
    visit = tiles.select("_cell", "_sub", "_tile", F.explode(F.transform(steps, lambda d: F.col("_cell") - d)).alias("_c"))
    visit = visit.join(F.broadcast(sizes.select(F.col("_cell").alias("_c"), "_subs")), "_c")
    visit = visit.select("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_subs") - 1)).alias("_s"), "_cell", "_sub", "_tile")
    visit = visit.where("_cell != _c or _sub >= _s").select("_c", "_s", F.floor(F.col("_sub") / fan).alias("_k"), F.lit(1).alias("_side"), "_cell", "_sub", "_tile")
    return home.unionByName(visit)


def mixed(a, b):
    """Places of text hashes ``b`` in the orders of ``a``; for one ``a`` no two different hashes have one place."""
    x = a ^ b
    for shift, factor in (30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def name_candidates(home, rest, same, active, lanes, radius, similarity, take):
    """Links from rows of ``home`` to rows of ``rest`` within the radius whose labels differ: (i, j), which rows have more, and to which rows of ``rest``.

    Both are arrays (fingerprint, text hash, label, sketch if any) in the order of text hashes; pairs that sketches tell
    not to be alike are no links. ``same`` marks rows of ``rest`` that are of the home
    tile, of which only later ones count. ``active`` has the rows that look, and the place each begins at. Each row
    goes through ``rest`` in an order of its own, mixed from both text hashes: no row is named by all others, and links
    of a group lie so that few steps lead from one text to any other, which keeps the component search short.
    """
    out, more, late = [], [], []
    block = max(1, (1 << 20) // max(1, len(rest)))
    others = [np.ascontiguousarray(rest[:, k]) for k in range(lanes)]
    h, label, sketched = lanes, lanes + 1, lanes + 2
    for lo in range(0, len(active), block):
        rows, start = active[lo : lo + block].T
        apart = np.bitwise_count(home[rows, 0, None] ^ others[0])
        for k in range(1, lanes):
            apart += np.bitwise_count(home[rows, k, None] ^ others[k])
        at, j = np.nonzero(apart <= radius)
        i = rows[at]
        steps = mixed(home[i, h], rest[j, h])
        left = (home[i, label] != rest[j, label]) & (steps >= start[at])
        mine = same[j]
        left &= ~mine | (home[i, h] < rest[j, h])
        i, j, steps = i[left], j[left], steps[left]
        if home.shape[1] > sketched:
            left = may_be_alike(home[:, sketched:], rest[:, sketched:], i, j, similarity)
            i, j, steps = i[left], j[left], steps[left]
        order = np.lexsort((steps, i))
        i, j, steps = i[order], j[order], steps[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        kept = rank < take
        out.append(np.stack([i[kept], j[kept]], axis=1))
        last = (rank == take - 1) & np.append(i[1:] == i[:-1], False)
        more.append(np.stack([i[last], steps[last] + 1], axis=1))  # a larger place follows
        late.append(np.unique(j[~kept]))
    none = np.zeros((0, 2), np.int64)
    return np.concatenate([none, *out]), np.concatenate([none, *more]), np.unique(np.concatenate([none[:, 0], *late]))


def candidates(met, cursor, lanes, radius, similarity, take):
    """(a, b, key, start): links between text hashes; rows with a ``start`` tell who has more candidates, and where they begin.

    Rows with neither ``b`` nor ``start`` name those candidates, each once for a key.
    ``cursor`` has the rows with a ``start`` of the round before, or is None in the first round, whose tiles are without sketches.
    """
    width = lanes + 2 + (0 if cursor is None else 1 + BITS // 64)

    def rows_of(blob):
        rows = np.frombuffer(blob, ">u8").astype(np.uint64).reshape(-1, width)
        return rows[np.argsort(rows[:, lanes])]

    def compare(key, pdf, state=None):
        own, rest = pdf[pdf["_side"] == 0], pdf[pdf["_side"] == 1]
        empty = pd.DataFrame({"a": [], "b": [], "_c": [], "_s": [], "_k": [], "start": []}, dtype="Int64")
        if own.empty or rest.empty:
            return empty
        home, visitors = rows_of(own["_tile"].iloc[0]), rows_of(b"".join(rest["_tile"]))
        twin = rest[(rest["_cell"] == rest["_c"]) & (rest["_sub"] == rest["_s"])]
        same = np.isin(visitors[:, lanes], home[:, lanes]) if len(twin) else np.zeros(len(visitors), bool)
        if state is None:
            active = np.stack([np.arange(len(home)), np.full(len(home), np.iinfo(np.int64).min)], axis=1)
        else:
            at = np.searchsorted(home[:, lanes], state["a"].to_numpy(np.int64).view(np.uint64))
            active = np.stack([at, state["start"].to_numpy(np.int64)], axis=1)
        links, more, late = name_candidates(home, visitors, same, active, lanes, radius, similarity, take)
        named = home[:, lanes].copy().view(np.int64)
        found = visitors[:, lanes].copy().view(np.int64)
        a = np.concatenate([named[links[:, 0]], named[more[:, 0]], found[late]])
        b, start = (pd.array(np.zeros(len(a), np.int64), "Int64") for _ in range(2))
        ahead = len(links) + len(more)
        b[: len(links)], b[len(links) :] = found[links[:, 1]], pd.NA
        start[:], start[len(links) : ahead] = pd.NA, more[:, 1]
        out = pd.DataFrame({"a": a, "b": b, "_c": key[0], "_s": key[1], "_k": key[2], "start": start})
        return out

    schema = "a long, b long, _c long, _s long, _k long, start long"
    if cursor is None:
        return met.groupBy(*KEY).applyInPandas(lambda key, pdf: compare(key, pdf), schema)
    met = met.join(cursor.select(*KEY).distinct(), KEY, "left_semi")
    return met.groupBy(*KEY).cogroup(cursor.groupBy(*KEY)).applyInPandas(compare, schema)


def verified(links, docs, shingle, similarity, text_col):
    """The links whose texts are alike: sets of the texts that links name, joined to both ends."""
    named = links.select(F.explode(F.array("a", "b")).alias("_h")).distinct()
    known = materialise(sets_of(named, docs, shingle, text_col, np.ndarray.tobytes), "shingle-sets")
    known = known.select("_h", "_set", F.octet_length("_set").alias("_n"))
    # lengths first: a set moves only where the lengths leave room
    sized = links.join(known.select(F.col("_h").alias("a"), F.col("_n").alias("_na")), "a").join(known.select(F.col("_h").alias("b"), F.col("_n").alias("_nb")), "b")
    sized = sized.where(F.least("_na", "_nb") >= similarity * F.greatest("_na", "_nb")).select("a", "b")
    pairs = sized.join(known.select(F.col("_h").alias("a"), F.col("_set").alias("_x")), "a").join(known.select(F.col("_h").alias("b"), F.col("_set").alias("_y")), "b")

    def decide(batches):
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = pa.array([alike(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), similarity) for p, q in zip(x, y)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], ["a", "b"])

    return pairs.select("a", "b", "_x", "_y").mapInArrow(decide, "a long, b long")


def forest(a, b):
    """Links (node, least) of every node of the links (a, b) to the least node reachable over them, but for the least nodes themselves."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[: len(a)], place[len(a) :]
    label, before = np.arange(len(nodes)), None
    while before is None or (label != before).any():
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], least)  # the root that an end had follows, so that steps grow
        np.minimum.at(label, label[j], least)
        label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def shortened(links, size=SHORTEN):
    """Links (a, b) that connect the same nodes by shorter ways: parts of about ``size`` links become stars, each in a task of its own."""

    def work(batches):
        parts = [(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)) for batch in batches]
        if parts:
            a, b = forest(*(np.concatenate(ends) for ends in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links.select("a", "b").repartition(1 + links.count() // size).mapInArrow(work, "a long, b long")


def relabelled(label, links):
    """(_h, root) after more links: those of a later round connect groups, so that only their roots go through the search."""
    links = shortened(links)
    if label is None:
        return components(links).withColumnRenamed("node", "_h")
    for end in "a", "b":
        roots = label.select(F.col("_h").alias(end), F.col("root").alias("_root"))
        links = links.join(roots, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    new = materialise(components(links.select("a", "b")), "new-roots").select(F.col("node").alias("_h"), F.col("root").alias("_new"))
    old = label.join(new.withColumnRenamed("_h", "root"), "root", "left").select("_h", F.coalesce("_new", "root").alias("root"))
    return old.unionByName(new.join(label, "_h", "left_anti").withColumnRenamed("_new", "root"))


def near_copies(docs, shingle=5, similarity=0.8, lanes=2, radius=28, least=7, tile=4096, fan=8, id_col="doc_id", text_col="text"):
    """(_id, _h, root) of every row; rows share ``root`` if links lead from one to the other.

    Two different texts link if their fingerprints differ by ``radius`` bits or fewer and their sets of ``shingle`` words
    share ``similarity`` of their union. Words are as in ``simhash``; a text with fewer words is one shingle, texts without
    words (null too) are alike. Rows with one text always share a root, whatever their ids. An empty table gives no rows.

    Texts meet tile by tile. In each round a text names a few candidates that no verified link connects with it yet,
    and goes on behind them in the next round if there are more; rounds end when no text has any left. So a group
    of copies needs links in proportion to its texts, not its pairs, and a pair is left out only where it
    could connect nothing new. From the second round on tiles hold only the texts that have candidates
    left or are such candidates, with sketches of their sets, so that in a group of texts that are near but not alike nearly
    all pairs end in their tiles; a sketch rules out only what the sets would.
    """
    prints = materialise(distinct_texts(docs, shingle, lanes, least, id_col, text_col), "fingerprints")
    texts = materialise(prints.groupBy("_h").agg(F.first("_fp").alias("_fp"), F.first("_cell").alias("_cell")), "texts")
    sizes = materialise(texts.groupBy("_cell").agg(F.ceil(F.count("*") / tile).alias("_subs")), "cells")
    own = texts.withColumn("_label", F.col("_h")).withColumn("_sketch", F.lit(b""))
    label, cursor, known, take = None, None, None, FIRST
    while True:
        met = meetings(materialise(tiles_of(own, sizes), "tiles"), sizes, radius, lanes, fan)
        found = materialise(candidates(met, cursor, lanes, radius, similarity, take), "candidates")
        links = materialise(verified(found.where("b is not null").select("a", "b"), docs, shingle, similarity, text_col), "near-links")
        if label is None or not links.isEmpty():
            label = materialise(relabelled(label, links), "roots")
        cursor, take = found.where("start is not null"), take * GROWTH
        if cursor.isEmpty():
            return prints.join(label, "_h", "left").select("_id", "_h", F.coalesce("root", "_h").alias("root"))
        dense = materialise(found.where("b is null").select(F.col("a").alias("_h")).distinct(), "dense")
        if known is None:
            known = materialise(sets_of(dense, docs, shingle, text_col, sketch), "sketches").withColumnRenamed("_set", "_sketch")
        own = texts.join(dense, "_h", "left_semi").join(label, "_h", "left").join(known, "_h")
        own = own.select("_h", "_fp", "_cell", F.coalesce("root", "_h").alias("_label"), "_sketch")


def one_of_each(docs, id_col="doc_id", text_col="text", **options):
    """One row of each group of near copies: the one with the smallest (id, text hash), null ids first, the columns as they were.

    The choice is a minimum summed before the shuffle. Rows with the same id and text are copies too: one stays.
    """
    marked = near_copies(docs, id_col=id_col, text_col=text_col, **options)
    best = marked.groupBy("root").agg(F.min(F.struct("_id", "_h")).alias("_best")).select("_best.*")
    ident, h, _ = row_key(id_col, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), ident, h)
    # copies of one row would meet under one key: first one of each partition, then one in all
    once = rows.join(best, ["_id", "_h"], "left_semi").groupBy("_id", "_h").agg(F.first("_row").alias("_row"))
    return once.select(with_fields("_row", docs.columns))
