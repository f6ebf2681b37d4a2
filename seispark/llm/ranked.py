"""Ranked lexical search: summed accumulators of short lists as one iterator beside the long lists."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.llm.ngrams import buffers, groups, mix, token_hashes
from seispark.session import materialise

#: Documents and postings of a block, at most about; items that search a block together.
DOCS, POSTINGS, TOGETHER = 8_192, 1 << 20, 4_096
#: A list is short if it holds at most one of so many documents of a block; documents under one bound; bounds in a stride.
RARE, FEW, STRIDE = 16, 32, 16
#: Bits of the table that tells which terms may be of an item; its size does not depend on the items.
BITS = 22

#: Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
TERM = np.zeros(256, np.uint8)
TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def terms_of(array):
    """For each group of rows of an Arrow array: (lo, hi, hash, row in group) of all terms; a longer text is read in pieces that cut no term."""
    data, offsets = buffers(array)
    for lo, hi in groups(offsets):
        start, end = int(offsets[lo]), int(offsets[hi])
        yield lo, hi, *token_hashes(LOWER[data[start:end]], offsets[lo : hi + 1] - start, TERM)


def frequencies(hashes, row):
    """(row, term, tf), each pair once, by row."""
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])])) if len(row) else np.zeros(0, np.int64)
    return row[first], hashes[first].view(np.int64), np.diff(np.append(first, len(row)))


def item_terms(items, id_col, text_col):
    """(_item, item_id, term, qtf): terms of each item and how often it has them; equal items are one."""

    def work(batches):
        for batch in batches:
            for lo, hi, hashes, row in terms_of(batch.column(2)):
                at, term, tf = frequencies(hashes, row)
                at = pa.array(at + lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(term), pa.array(tf)], ["_item", "item_id", "term", "qtf"])

    ident, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    rows = items.select(F.xxhash64(ident, text).alias("_item"), ident.alias("item_id"), text.alias("_text")).distinct()
    return rows.mapInArrow(work, "_item long, item_id long, term long, qtf long")


def postings(docs, wanted, id_col, text_col):
    """(doc_id, _r, n, k, terms, tfs) of every document: its length, and the terms that an item may have as arrays of numbers; ``_r`` numbers the rows."""

    def work(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, hashes, row in terms_of(batch.column(1)):
                n = np.bincount(row, minlength=hi - lo)
                own = wanted[mix(hashes, BITS)]
                at, term, tf = frequencies(hashes[own], row[own])
                count = np.bincount(at, minlength=hi - lo)
                ends = np.concatenate([[0], np.cumsum(count)])
                lists = [
                    pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(ends * x.itemsize), pa.py_buffer(x)]).cast(pa.binary())
                    for x in (np.ascontiguousarray(term), tf.astype(np.int32))
                ]
                number = (part << 40) + seen + np.arange(hi - lo)
                seen += hi - lo
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], *[pa.array(x) for x in (number, n, count)], *lists], ["doc_id", "_r", "n", "k", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(work, "doc_id long, _r long, n long, k long, terms binary, tfs binary")


def document_counts(table):
    """(term, df): in how many documents each term is, counted within batches first."""

    def work(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            term, df = np.unique(data[int(offsets[0]) : int(offsets[-1])].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df)], ["term", "df"])

    return table.select("terms").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Lists:
    """Inverted lists of one block: documents are places in order of preference among equal scores."""

    def __init__(self, docs, term, weight, place, tf, norm):
        self.docs, self.terms = docs, term
        impact = weight[place[0]] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[place[1]]))
        order = np.argsort(place[0] * np.int64(docs) + place[1], kind="stable")
        self.doc, self.impact = place[1][order], impact[order]
        self.starts = np.searchsorted(place[0][order], np.arange(len(term) + 1))
        self.bounds = {}

    def slice(self, t):
        return slice(self.starts[t], self.starts[t + 1])

    def blocks(self, t):
        """(first posting of every few documents, best impact among them) of a long list."""
        if t not in self.bounds:
            own = self.slice(t)
            at = self.doc[own] // FEW
            count = -(-self.docs // FEW)
            most = np.zeros(count, np.int64)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            most[at[first]] = np.maximum.reduceat(self.impact[own], first)
            self.bounds[t] = own.start + np.searchsorted(at, np.arange(count + 1)), most
        return self.bounds[t]


def ranges(first, last):
    """All numbers of the ranges, one range after another."""
    size = last - first
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def best_of(places, scores, k):
    order = np.lexsort((places, -scores))[:k]
    return places[order], scores[order]


def hybrid_search(lists, terms, times, k):
    """(places, scores) of the k best documents with a score above 0, ties to lower places.

    The short lists are summed up term by term. What they gave is one iterator from there on, which has bounds like a
    list; its kth sum is a first threshold, for scores only grow. Then all iterators move together from few
    documents to the next few: where the bounds of all of them do not reach the threshold, nobody is scored. At
    equality documents are scored, for a lower place may tie.
    """
    sizes = lists.starts[terms + 1] - lists.starts[terms]
    short = sizes * RARE <= lists.docs
    sums = np.zeros(-(-lists.docs // FEW) * FEW, np.int64)
    for t, c in zip(terms[short], times[short]):
        own = lists.slice(t)
        sums[lists.doc[own]] += c * lists.impact[own]
    met = np.flatnonzero(sums)
    long = [(c, *lists.blocks(t)) for t, c in zip(terms[~short], times[~short])]
    if not long:
        return best_of(met, sums[met], k)
    places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = np.partition(sums[met], len(met) - k)[len(met) - k] if len(met) >= k else 1
    bound = sums.reshape(-1, FEW).max(axis=1)
    for c, _, most in long:
        bound = bound + c * most
    live = np.flatnonzero(bound >= max(least, 1))
    while len(live):
        here, live = live[:STRIDE], live[STRIDE:]
        score = sums.reshape(-1, FEW)[here]
        place = np.zeros(len(bound), np.int64)
        place[here] = np.arange(len(here))
        flat = score.ravel()
        for c, first, _ in long:
            at = ranges(first[here], first[here + 1])
            doc = lists.doc[at]
            flat[place[doc // FEW] * FEW + doc % FEW] += c * lists.impact[at]
        doc = (here[:, None] * FEW + np.arange(FEW)).ravel()
        good = (flat >= least) & (flat > 0)
        places, scores = best_of(np.concatenate([places, doc[good]]), np.concatenate([scores, flat[good]]), k)
        if len(scores) == k and scores[-1] > least:
            least = scores[-1]
            live = live[bound[live] >= least]
    return places, scores


def search_block(docs, items, documents, length, k):
    """Rows (_item, item_id, doc_id, _r, score) of the k best documents of a block for every item."""
    schema = pa.schema([(c, pa.int64()) for c in ("_item", "item_id", "doc_id", "_r", "score")])
    if not docs.num_rows or not items.num_rows:
        return schema.empty_table()
    docs = docs.combine_chunks().sort_by([("_r", "ascending")])
    # lowest ids first, null before all, and equal ids in the order of their rows
    ids = docs["doc_id"].combine_chunks()
    known = np.asarray(ids.is_valid())
    order = np.lexsort((np.asarray(ids.fill_null(0)), known))
    docs = docs.take(pa.array(order))
    n, count = np.asarray(docs["n"]), np.asarray(docs["k"])
    norm = 25 + (75 * n * documents) // length
    data, offsets = buffers(docs["terms"])
    term = data[int(offsets[0]) : int(offsets[-1])].view(np.int64)
    data, offsets = buffers(docs["tfs"])
    tf = data[int(offsets[0]) : int(offsets[-1])].view(np.int32).astype(np.int64)
    doc = np.repeat(np.arange(len(n)), count)

    vocabulary, first, wanted = np.unique(np.asarray(items["term"]), return_index=True, return_inverse=True)
    weight = np.asarray(items["w"])[first]
    at = np.searchsorted(vocabulary, term)
    at[at == len(vocabulary)] = 0
    own = (vocabulary[at] == term) & (weight[at] > 0)
    lists = Lists(len(n), vocabulary, weight, (at[own], doc[own]), tf[own], norm)

    keys, where = np.unique(np.asarray(items["_item"]), return_inverse=True)
    order, times = np.argsort(where, kind="stable"), np.asarray(items["qtf"])
    ends = np.cumsum(np.bincount(where))
    found = []
    for q, end in enumerate(ends):
        mine = order[ends[q - 1] if q else 0 : end]
        places, scores = hybrid_search(lists, wanted[mine], times[mine], k)
        found.append((np.full(len(places), mine[0]), places, scores))
    asked, places, scores = (np.concatenate(x) for x in zip(*found))
    asked, places = pa.array(asked), pa.array(places)
    return pa.Table.from_arrays([items["_item"].take(asked), items["item_id"].take(asked), docs["doc_id"].take(places), docs["_r"].take(places), pa.array(scores)], schema=schema)


def top_documents(docs, items, k=10, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", block=(DOCS, POSTINGS), together=TOGETHER):
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 for every item.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased. A term's weight
    is floor(1000 ln((2N+2)/(2df+1))) and m = 25 + 75nN div L, from counts over all documents; a document has the sum of
    w * (10^9 tf div (1000 tf + 8m)) over the item's terms, repeats included.

    One pass writes each document's counts of terms that an item may have (a table of 2^22 bits tells, whatever the number of items). Blocks of
    documents hold inverted lists, and groups of items search each block once (``hybrid_search``); the best k of all
    blocks are ranked in the end. Both are dealt by numbers of rows, so neither copies nor a hot id meet in one task.

    Equal scores go by ascending doc_id, null first. Every row is a document, also if its id or the whole row is repeated, and
    its copies have ranks of their own; documents without terms are none. Each text of an item id is an item of its
    own, equal items are one; a null or empty item finds nothing. Other columns play no part; empty tables give no rows.
    """
    asked = materialise(item_terms(items, item_col, item_text), "item-terms")
    wanted = np.zeros(1 << BITS, bool)

    def spread(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(mix(np.asarray(batch.column(0)).view(np.uint64), BITS)))], ["bucket"])

    for r in asked.select("term").mapInArrow(spread, "bucket long").distinct().collect():  # 2^22 numbers at most
        wanted[r["bucket"]] = True
    table = materialise(postings(docs, wanted, id_col, text_col), "postings")
    documents, length, most, rows = table.where("n > 0").agg(F.count("*"), F.sum("n"), F.sum("k"), F.count("*")).first()
    count = asked.select("_item").distinct().count()
    blocks, parts = max(1, -(-rows // block[0]), -(-(most or 0) // block[1])), max(1, -(-count // together))

    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("df") + 1))).alias("w")
    asked = asked.join(document_counts(table), "term").select("_item", "item_id", "term", "qtf", weight)

    def dealt(rows, number, own, size, other, others):
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))) if others > 1 else F.lit(0)
        return rows.withColumn(own, F.pmod(F.xxhash64(number), F.lit(size)).cast("int")).withColumn(other, every)

    left = dealt(table.where("k > 0"), "_r", "_b", blocks, "_p", parts)
    right = dealt(asked, "_item", "_p", parts, "_b", blocks)

    def search(docs, items):
        return search_block(docs, items, documents, length, k)

    found = left.groupBy("_b", "_p").cogroup(right.groupBy("_b", "_p")).applyInArrow(search, "_item long, item_id long, doc_id long, _r long, score long")
    rank = F.row_number().over(Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "_r"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
