"""Benchmark decontamination: training passages as queries on an index of test items."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from seispark.llm.ngrams import CLASSES, buffers, groups, token_hashes, tokens
from seispark.llm.text import row_key
from seispark.session import materialise

K1, B = 1.2, 0.75
#: Words of a passage; passages start every half of that.
PASSAGE = 128
#: Share of an item's own BM25 score that a passage must reach, and share of its five-word runs to be found.
LEAST_SCORE, LEAST_OVERLAP, RUN = 0.5, 0.8, 5
#: Words of a piece of an item at most: any so many words in a row lie in one passage.
PIECE_WORDS = PASSAGE // 2
#: Pieces of items in one part of the index (parts are read one after another), in a block, and under one bound in it.
PART, BLOCK, FEW = 4_000, 64, 4
WORDS_ONLY = np.where(CLASSES == 1, 1, 0).astype(np.uint8)


def word_hashes(texts):
    """(hash, row) of the lower-cased words of an Arrow array of texts."""
    return tokens(*buffers(pc.utf8_lower(texts)), WORDS_ONLY)


def parts_of(text):
    """Question and answer of an item: the last sentence, if there are several, is the answer."""
    found = [s for s in re.split(r"(?<=[.!?])\s+|\n+", (text or "").strip()) if s]
    return (" ".join(found[:-1]), found[-1]) if len(found) > 1 else (" ".join(found), "")


def runs(hashes, width):
    """Hashes of the runs of ``width`` words that follow each other."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + (hashes[k : len(hashes) - width + 1 + k] ^ np.uint64(k + 1))
    return total


def pieces(sizes):
    """(item, piece, first, last) words of equal pieces of at most PIECE_WORDS; each run of an item is in one of them."""
    shared = RUN - 1
    room = sizes - shared
    count = np.maximum(1, -(-room // (PIECE_WORDS - shared)))
    item = np.repeat(np.arange(len(sizes)), count)
    piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    room, count = room[item], count[item]
    return item, piece, piece * room // count, (piece + 1) * room // count + shared


def item_terms(items, id_col, text_col):
    """(item, piece, term, tf, size): word hashes of every piece of every item."""

    def work(batches):
        for batch in batches:
            h, row = word_hashes(batch.column(1))
            sizes = np.bincount(row, minlength=batch.num_rows)
            item, piece, first, last = pieces(sizes)
            size = last - first
            at = np.arange(size.sum()) + np.repeat((np.cumsum(sizes) - sizes)[item] + first - (np.cumsum(size) - size), size)
            pdf = pd.DataFrame({"item": np.repeat(np.asarray(batch.column(0))[item], size), "piece": np.repeat(piece, size), "term": h[at].view(np.int64)})
            found = pdf.groupby(["item", "piece", "term"], sort=True).size().rename("tf").reset_index()
            found["size"] = found.groupby(["item", "piece"])["tf"].transform("sum")
            yield pa.RecordBatch.from_pandas(found.astype("int64"), preserve_index=False)

    rows = items.groupBy(F.col(id_col).cast("long").alias("_item")).agg(F.min(F.col(text_col).cast("string")).alias("_text"))
    rows = rows.where("_item is not null and _text is not null")
    return rows, rows.mapInArrow(work, "item long, piece long, term long, tf long, size long")


def impacts(terms):
    """(item, piece, term, impact): BM25 weight of a term in a piece over the piece's own score, from counts over all pieces."""
    n, mean = terms.select("item", "piece", "size").distinct().agg(F.count("*"), F.avg("size")).first()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.lit(mean or 1.0)))
    raw = terms.join(df, "term").select("item", "piece", "term", (idf * tf).alias("w"))
    own = raw.groupBy("item", "piece").agg(F.sum("w").alias("own"))
    return raw.join(own, ["item", "piece"]).select("item", "piece", "term", (F.col("w") / F.col("own")).alias("impact"))


class Block:
    """Inverted lists of some items that follow each other: local terms, exact impacts, and the best of each few items."""

    def __init__(self, first, terms, slots, impacts, size, width):
        self.first = first
        self.own, at = np.unique(terms, return_inverse=True)
        self.exact = np.zeros((len(self.own), size))
        self.exact[at, slots - first] = impacts
        padded = np.pad(self.exact, ((0, 0), (0, -size % FEW)))
        self.most = padded.reshape(len(self.own), -1, FEW).max(axis=2).astype(np.float32)
        self.lists = np.full(width, -1, np.int32)
        self.lists[self.own] = np.arange(len(self.own), dtype=np.int32)


class Index:
    """BM25 index of one part of the items, in blocks of pieces that are alike in length; ``items`` has the item of each piece."""

    def __init__(self, postings, texts):
        known = list(zip(postings["item"].tolist(), postings["piece"].tolist())) if len(postings) else []
        size = Counter(known)
        order = sorted(size, key=lambda p: (size[p], p))
        self.items = np.array([i for i, _ in order], np.int64)
        place = {p: k for k, p in enumerate(order)}
        slot = np.array([place[p] for p in known], np.int64)
        self.vocabulary, term = np.unique(postings["term"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        impact = postings["impact"].to_numpy(float)
        self.most = np.zeros(len(self.vocabulary))
        np.maximum.at(self.most, term, impact)
        self.blocks = []
        for first in range(0, len(self.items), BLOCK):
            own = (slot >= first) & (slot < first + BLOCK)
            count = min(BLOCK, len(self.items) - first)
            self.blocks.append(Block(first, term[own], slot[own], impact[own], count, len(self.vocabulary)))
        self.low = np.zeros(1 << 20, bool)  # which low bits of a hash occur at all
        self.low[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        checks = {i: self._check(text) for i, text in texts.items()}
        self.checks = [checks[i] for i in self.items.tolist()]

    @staticmethod
    def _check(text):
        """(width, distinct runs) of the question and of the answer, and how far from a piece the item reaches."""
        found, size = [], 0
        for part in parts_of(text):
            h, _ = word_hashes(pa.array([part]))
            width = min(RUN, len(h))
            size += len(h)
            found.append((width, np.unique(runs(h, width)) if width else np.zeros(0, np.uint64)))
        reach = sum(len(w) for _, w in found) + 2 * RUN
        return found, reach if size <= PIECE_WORDS else size + size // 4 + 2 * RUN  # a copy may have words of its own

    def terms(self, hashes):
        """Term of each hash, -1 where no item has it."""
        found = np.full(len(hashes), -1, np.int64)
        if not len(self.vocabulary):
            return found
        maybe = np.flatnonzero(self.low[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        hit = self.vocabulary[at] == hashes[maybe]
        found[maybe[hit]] = at[hit]
        return found

    def retrieve(self, passage, term, count, least):
        """All (passage, slot, score) of ``least`` or more: block-max WAND for many passages at once.

        ``passage`` and ``term`` are the distinct terms of each of ``count`` passages, in order. A passage whose
        lists' best impacts do not add up to the threshold has no pivot in any list and ends there. The others move
        from block to block; the best impacts of every few items in the block tell whether these are scored or jumped over.
        """
        near = least - 1e-6
        hopeful = np.bincount(passage, self.most[term], count) >= near
        kept = hopeful[passage]
        passage, term = passage[kept], term[kept]
        found = []
        for block in self.blocks:
            local = block.lists[term]
            at = np.flatnonzero(local >= 0)
            if not len(at):
                continue
            who, local = passage[at], local[at]
            first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            live = (np.add.reduceat(block.most[local], first, axis=0) >= near).any(axis=1)
            if not live.any():
                continue
            here = np.repeat(live, np.diff(np.append(first, len(who))))
            who, local = who[here], local[here]
            first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            score = np.add.reduceat(block.exact[local], first, axis=0)
            k, slot = np.nonzero(score >= least)
            found += zip(who[first[k]].tolist(), (slot + block.first).tolist(), score[k, slot].tolist())
        return found


def passages(row):
    """(first, last) token of each passage; ``row`` is the text of each token."""
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(row)))
    half = PASSAGE // 2
    count = np.maximum(1, -(-(sizes - half) // half))
    first = np.repeat(starts, count) + half * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    return first, np.minimum(first + PASSAGE, np.repeat(starts + sizes, count))


def candidates(index, hashes, row, least):
    """{(row, item): [(score, first, last, slot)]} of all passages of each text that reach the threshold of a piece of the item."""
    term = index.terms(hashes)
    first, last = passages(row)
    # distinct terms of each passage, by keys passage * terms + term
    size, terms = last - first, len(index.vocabulary)
    start = np.cumsum(size) - size
    token = term[np.arange(size.sum()) + np.repeat(first - start, size)]
    keys = np.repeat(np.arange(len(first)) * terms, size)[token >= 0] + token[token >= 0]
    if len(first) * terms < 1 << 32:
        keys = keys.astype(np.uint32)
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    passage = (keys // terms).astype(np.int64) if terms else keys
    found = {}
    for k, slot, score in index.retrieve(passage, (keys - passage * terms).astype(np.int64), len(first), least):
        found.setdefault((int(row[first[k]]), int(index.items[slot])), []).append((score, int(first[k]), int(last[k]), slot))
    return found


def overlaps(index, slot, hashes):
    """Shares of the question's and of the answer's runs that a stretch of words holds; 1 for a part without words."""
    found = []
    for width, wanted in index.checks[slot][0]:
        found.append(float(np.isin(wanted, runs(hashes, width)).mean()) if len(wanted) else 1.0)
    return found


def search(docs, index, names, least, overlap):
    """(_id, _h, item_id, score, question_overlap, answer_overlap) of verified hits in (_id, _h, _text); ``names`` has the id of each item."""

    def in_text(hashes, row):
        for (r, item), met in candidates(index, hashes, row, least).items():
            lo, hi = np.searchsorted(row, [r, r + 1])
            # the best score may be of the same words in another order: passages are tried until one is verified
            for score, first, last, slot in sorted(met, key=lambda m: (-m[0], m[1])):
                reach = index.checks[slot][1]  # the item goes on beside the piece
                question, answer = overlaps(index, slot, hashes[max(lo, first - reach) : min(hi, last + reach)])
                if question >= overlap and answer >= overlap:
                    yield r, names[item], score, question, answer
                    break

    def work(batches):
        for batch in batches:
            texts = pc.utf8_lower(batch.column(2))
            data, offsets = buffers(texts)
            rows = []
            for lo, hi in groups(offsets):
                rows += [(lo + r, *rest) for r, *rest in in_text(*token_hashes(data, offsets[lo : hi + 1], WORDS_ONLY))]
            at = pa.array([r[0] for r in rows], pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), *[pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()), (4, pa.float64()))]]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_h", "item_id", "score", "question_overlap", "answer_overlap"])

    return docs.mapInArrow(work, "_id long, _h long, item_id long, score double, question_overlap double, answer_overlap double")


def find_leaks(docs, items, least=LEAST_SCORE, overlap=LEAST_OVERLAP, part=PART, id_col="doc_id", text_col="text", item_col="item_id"):
    """(_id, _h, item_id, score, question_overlap, answer_overlap): which documents hold which test items.

    Every passage of every text (128 words, one starting every 64) is a query on a BM25 index of the items;
    items of more than 64 words are indexed as equal pieces of at most so many, for these always lie in one passage.
    All pieces above the threshold are retrieved, a share ``least`` of the piece's own score. A hit counts if the
    words around a passage, as far as the whole item reaches, hold at least ``overlap`` of the question's and of the answer's five-word runs
    (of fewer words: that run); the best such passage is reported. Words are runs of letters and digits, lower-cased; document counts are those of all pieces.

    The index is cut into parts of about ``part`` pieces (an item's pieces are in one); one part at a time is sent to the tasks, so its
    size is bounded whatever the number of items and their length, and no document is ever grouped. Null and empty texts have
    no hits, items without words are none; each text of an id is an item, also if the id is null, and gives its own row; equal rows hit alike.
    """
    spark = docs.sparkSession
    name, text = F.col(item_col).cast("long"), F.col(text_col).cast("string")
    items = items.select(F.xxhash64(name, text).alias("_key"), name.alias("_name"), text.alias("_text"))
    texts, terms = item_terms(items, "_key", "_text")
    weights = materialise(impacts(materialise(terms, "item-terms")), "impacts")
    parts = max(1, -(-weights.select("item", "piece").distinct().count() // part))
    rows = docs.select(*row_key(id_col, text_col))
    found = None
    for k in range(parts):
        def mine(col):
            return F.pmod(F.xxhash64(col), F.lit(parts)) == k

        own = {r["_item"]: r["_text"] for r in texts.where(mine("_item")).collect()}
        postings = weights.where(mine("item")).toPandas()
        own = {i: own[i] for i in postings["item"].unique().tolist()}
        names = {r["_key"]: r["_name"] for r in items.where(mine("_key")).distinct().select("_key", "_name").collect()}
        hits = search(rows, Index(postings, own), names, least, overlap)
        found = hits if found is None else materialise(found, "hits").unionByName(hits)
    return found


def without_leaks(docs, items, id_col="doc_id", text_col="text", **options):
    """The documents that hold no test item, columns as they were."""
    ident, h, _ = row_key(id_col, text_col)
    bad = materialise(find_leaks(docs, items, id_col=id_col, text_col=text_col, **options).select("_id", "_h").distinct(), "leaks")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), ident, h)
    return rows.join(bad, ["_id", "_h"], "left_anti").select([F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
