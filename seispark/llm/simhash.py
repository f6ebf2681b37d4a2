"""Near-duplicates by SimHash: every two fingerprints are compared, tile by tile."""

from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from seispark.llm.components import components
from seispark.llm.text import NULL_ID, row_key, with_fields
from seispark.session import materialise

SEED = 42
BLOCK = 1 << 16


def _digests(shingles, lanes):
    """Hash bytes of the shingles, 8 for each lane; None at the end."""
    found = [np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED + lane))), np.uint8).reshape(-1, 8) for lane in range(lanes)]
    return np.concatenate(found, axis=1)


def _ones(digests):
    """How often each bit is set."""
    total = np.zeros(digests.shape[1] * 8, np.int64)
    for lo in range(0, len(digests), 255):  # so many fit a byte
        total += np.unpackbits(digests[lo : lo + 255], axis=1).sum(axis=0, dtype=np.uint8)
    return total


def fingerprint(text, shingle, lanes, least=None):
    """Majority bits over all shingles of a text given as bytes; with fewer than ``least`` words it is one shingle."""
    words = text.lower().split()  # of bytes: A-Z alone, and blanks of ASCII alone
    if not words:
        return bytes(8 * lanes)
    if len(words) < (least or shingle):
        count, ones = 1, _ones(_digests([b" ".join(words)], lanes))
    else:
        count, ones = len(words) - shingle + 1, np.zeros(64 * lanes, np.int64)
        every = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle))))
        while block := list(islice(every, BLOCK)):
            ones += _ones(_digests(block, lanes))
    return np.packbits(2 * ones > count).tobytes()


def cell_of(prints, blocks):
    """Population counts of equal parts of the fingerprints, one byte each in a long."""
    parts = np.unpackbits(prints, axis=1).reshape(len(prints), blocks, -1).sum(axis=2, dtype=np.int64)
    return parts @ (256 ** np.arange(blocks, dtype=np.int64))


def fingerprints(docs, shingle=3, lanes=1, blocks=4, least=None, id_col="doc_id", text_col="text"):
    """(_id, _h, _fp, _cell) of every row: fingerprint of 64 bits a lane and the population counts of its parts."""

    def work(batches):
        for batch in batches:
            prints = [fingerprint(t or b"", shingle, lanes, least) for t in batch.column(2).to_pylist()]
            raw = np.frombuffer(b"".join(prints), np.uint8).reshape(-1, 8 * lanes)
            cells = cell_of(raw, blocks) if len(raw) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.binary()), pa.array(cells, pa.int64())], ["_id", "_h", "_fp", "_cell"]
            )

    ident, h, text = row_key(id_col, text_col)
    return docs.select(ident, h, text.cast("binary")).mapInArrow(work, "_id long, _h long, _fp binary, _cell long")


def neighbours(blocks, width, radius):
    """Differences between packed population counts that are within the radius, as pairs of longs."""
    found = [(0, 0)]  # (packed, distance used)
    for k in range(blocks):
        found = [(p + d * 256**k, used + abs(d)) for p, used in found for d in range(-width, width + 1) if used + abs(d) <= radius]
    return [p for p, _ in found]


def close_pairs(a, b, radius, same):
    """Links between fingerprints of two tiles that keep whole what they connect.

    ``a`` and ``b`` are arrays of words (rows x lanes); ``same`` if both are one tile. Returns index
    pairs, fewer than the fingerprints: a hot group never gives all its pairs.
    """
    label = np.arange(len(a) if same else len(a) + len(b))
    shift, links = (0 if same else len(a)), []
    rows = max(1, (1 << 20) // max(1, len(b)))
    for lo in range(0, len(a), rows):
        part = a[lo : lo + rows]
        i, j = np.nonzero(np.bitwise_count(part[:, 0, None] ^ b[None, :, 0]) <= radius)
        if a.shape[1] > 1:  # the other words only where the first one leaves room
            near = np.bitwise_count(part[i] ^ b[j]).sum(axis=1) <= radius
            i, j = i[near], j[near]
        ends = np.searchsorted(i, np.arange(len(part) + 1))
        for k in np.flatnonzero(np.diff(ends) > same):
            met = j[ends[k] : ends[k + 1]]
            own = label[lo + k]
            groups, first = np.unique(label[met + shift], return_index=True)
            new = groups != own
            if new.any():
                links += [(lo + k, m) for m in met[first[new]]]
                label[np.isin(label, groups[new])] = own
    return links


def link_tiles(prints, lanes, blocks, radius, tile, fan=8):
    """(a, b) links between distinct fingerprints (_fp, _cell) at most ``radius`` bits apart.

    Fingerprints with equal population counts of their ``blocks`` parts are a cell, cut into tiles of
    about ``tile``. Tiles meet only if the counts differ by the radius or less in all, for each
    differing bit changes one count by one. A task has one tile and up to ``fan`` tiles of each
    neighbouring cell, so its memory does not grow with the input.
    """
    width = 64 * lanes // blocks
    sizes = materialise(prints.groupBy("_cell").agg(F.ceil(F.count("*") / tile).alias("_subs")), "cells")
    most = sizes.agg(F.max("_subs")).first()[0] or 0
    # at most (width + 1) ** blocks cells
    packed = (
        prints.join(F.broadcast(sizes), "_cell")
        .withColumn("_sub", F.pmod(F.xxhash64("_fp"), F.col("_subs")))
        .groupBy("_cell", "_sub")
        .agg(F.unhex(F.array_join(F.collect_list(F.hex("_fp")), "")).alias("_tile"))
    )
    packed = materialise(packed, "tiles")
    chunks = F.sequence(F.lit(0), F.lit(max(0, (most - 1) // fan)).cast("long"))
    home = packed.select(F.col("_cell").alias("_c"), F.col("_sub").alias("_s"), F.explode(chunks).alias("_k"), F.lit(0).alias("_side"), "_cell", "_sub", "_tile")
    steps = F.array(*[F.lit(d).cast("long") for d in neighbours(blocks, width, radius) if d >= 0])
    visit = packed.select("_cell", "_sub", "_tile", F.explode(F.transform(steps, lambda d: F.col("_cell") - d)).alias("_c"))
    visit = visit.join(F.broadcast(sizes.select(F.col("_cell").alias("_c"), "_subs")), "_c")
    visit = visit.select("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_subs") - 1)).alias("_s"), "_cell", "_sub", "_tile")
    visit = visit.where("_cell != _c or _sub >= _s").select("_c", "_s", F.floor(F.col("_sub") / fan).alias("_k"), F.lit(1).alias("_side"), "_cell", "_sub", "_tile")

    def words(blob):
        return np.frombuffer(blob, np.uint64).reshape(-1, lanes)

    def compare(pdf):
        own, rest = pdf[pdf["_side"] == 0], pdf[pdf["_side"] == 1]
        if own.empty or rest.empty:
            return pd.DataFrame({"a": [], "b": []}, dtype=object)
        a = words(own["_tile"].iloc[0])
        twin = (rest["_cell"] == rest["_c"]) & (rest["_sub"] == rest["_s"])
        links = [(a[i].tobytes(), a[j].tobytes()) for blob in rest.loc[twin, "_tile"] for i, j in close_pairs(a, a, radius, True)]
        others = rest.loc[~twin, "_tile"]
        if len(others):
            b = words(b"".join(others))
            links += [(a[i].tobytes(), b[j].tobytes()) for i, j in close_pairs(a, b, radius, False)]
        return pd.DataFrame(links, columns=["a", "b"], dtype=object)

    return home.unionByName(visit).groupBy("_c", "_s", "_k").applyInPandas(compare, "a binary, b binary")


def near_duplicates(docs, shingle=3, radius=3, lanes=1, blocks=4, tile=4096, least=None, id_col="doc_id", text_col="text"):
    """(_id, _h, _fp, component, root) of every row; component is the smallest id reachable over links, root the smallest fingerprint.

    Texts are lower-cased (A-Z), cut into words at blanks and into shingles of ``shingle`` words,
    repeats included; a text with fewer words (or than ``least``) is one shingle, one without words (null too) has
    fingerprint zero. Fingerprints link at ``radius`` or fewer differing bits. Equal fingerprints are
    merged before tiles meet, so exact copies cost nothing; null ids count as one id below all others.
    Components may have their smallest id in common (null ids, repeated ids), but never their root.
    """
    prints = materialise(fingerprints(docs, shingle, lanes, blocks, least, id_col, text_col), "fingerprints")
    distinct = prints.groupBy("_fp", "_cell").agg(F.min("_id").alias("_first"))
    links = link_tiles(distinct.select("_fp", "_cell"), lanes, blocks, radius, tile)
    member = components(links).join(distinct.select(F.col("_fp").alias("node"), "_first"), "node")
    least = member.groupBy("root").agg(F.min("_first").alias("_least"))
    label = member.join(least, "root").select(F.col("node").alias("_fp"), "_least", "root")
    label = distinct.join(label, "_fp", "left").select("_fp", F.coalesce("_least", "_first").alias("component"), F.coalesce("root", "_fp").alias("root"))
    label = materialise(label, "labels")  # dealt for the next join alone, in which a hot fingerprint can be split
    return prints.join(label, "_fp").select("_id", "_h", "_fp", "component", "root")


def one_of_each(docs, id_col="doc_id", text_col="text", **options):
    """One row of each component: the one with the smallest (id, text hash), the columns as they were.

    The choice is a minimum summed before the shuffle. Rows with the same id and text are copies too: one stays.
    """
    marked = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    best = marked.groupBy("root").agg(F.min(F.struct("_id", "_h")).alias("_best")).select("_best.*")
    ident, h, _ = row_key(id_col, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), ident, h)
    # copies of one row would meet under one key: first one of each partition, then one in all
    rows = rows.join(best, ["_id", "_h"], "left_semi")
    once = rows.groupBy("_id", "_h").agg(F.first("_row").alias("_row"))
    return once.select(with_fields("_row", docs.columns))


def public_id(col):
    return F.when(F.col(col) != NULL_ID, F.col(col))
