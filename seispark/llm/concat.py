"""Concatenate and cut: token sequences of one length, filled without a gap."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.llm.ngrams import buffers
from seispark.llm.wordpieces import encoder
from seispark.session import materialise

LENGTH = 2048
#: Partitions whose totals are summed up together.
BUCKET = 64


def tokenised(docs, config, end, id_col="doc_id", text_col="text"):
    """(doc_id, part, before, doc_tokens, ids): token ids of every row, little-endian, with the end mark, and how many its partition has before it."""

    def work(batches):
        part, before = TaskContext.get().partitionId(), 0
        encode = encoder(config).encode
        narrow = max(encoder(config).tokenizer.get_vocab_size(), end + 1) <= 1 << 16
        for batch in batches:
            for lo, hi, ids, sizes in encode(batch.column(1)):
                ends = np.cumsum(sizes + 1)
                marked = np.full(int(ends[-1]), end, "<u2" if narrow else "<u4")
                own = np.ones(len(marked), bool)
                own[ends - 1] = False
                marked[own] = ids
                offsets = np.concatenate([[0], ends]) * marked.itemsize
                found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(marked)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], *[pa.array(x) for x in (np.full(hi - lo, part, np.int32), before + ends - sizes - 1, sizes + 1, np.full(hi - lo, marked.itemsize, np.int32))], found.cast(pa.binary())],
                    ["doc_id", "part", "before", "doc_tokens", "width", "ids"],
                )
                before += int(ends[-1])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, part int, before long, doc_tokens long, width int, ids binary")


def partition_starts(tokens):
    """(part, first): where each partition's tokens begin among all; totals are summed up in buckets of partitions and over the buckets."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    totals = totals.withColumn("bucket", F.floor(F.col("part") / BUCKET))
    within = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = totals.groupBy("bucket").agg(F.sum("n").alias("n"))
    buckets = buckets.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = totals.withColumn("before_part", F.coalesce(F.sum("n").over(within), F.lit(0))).join(buckets, "bucket")
    return placed.select("part", (F.col("start") + F.col("before_part")).alias("first"))


class Windows:
    """Where the sequences begin: every ``length`` tokens, and the rest behind the last full one cut at powers of two."""

    def __init__(self, total, length, powers=True):
        self.length, self.full = length, total // length
        rest = total % length
        parts = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1] if powers else [rest] * bool(rest)
        self.rest = self.full * length + np.concatenate([[0], np.cumsum(parts)]).astype(np.int64)

    def of(self, place):
        """Number of the sequence that a token is in."""
        late = self.full + np.searchsorted(self.rest, place, "right") - 1
        return np.where(place < self.full * self.length, place // self.length, late)

    def start(self, sequence):
        return np.where(sequence < self.full, sequence * self.length, self.rest[np.clip(sequence - self.full, 0, len(self.rest) - 1)])


def pack(docs, tokenizer, end=1, length=LENGTH, powers=True, id_col="doc_id", text_col="text"):
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): pieces of documents in sequences of ``length`` tokens.

    ``tokenizer`` is the path of a tokenizer file; its text goes to the tasks. All documents, each with
    its end mark ``end``, stand one after another in the order of the input's partitions and are cut every ``length``
    tokens; a document that crosses a boundary gives a piece on both sides. Two passes: the first writes
    ids with the count of tokens before each document in its partition, then the totals of the partitions (one row
    each, which alone are broadcast) give global places. No document is shuffled or grouped.

    The last tokens, fewer than ``length``, are cut at powers of two (at most log2(length) shorter sequences) unless ``powers`` is
    off, when they are one sequence. ``ids`` are unsigned 32-bit little-endian numbers. A null or empty text is its end mark alone;
    null ids stay null; equal rows are packed once each; other columns play no part. An empty table gives no rows.
    """
    with open(tokenizer, encoding="utf-8") as f:
        config = f.read()
    tokens = materialise(tokenised(docs, config, end, id_col, text_col), "token-ids")
    total = tokens.agg(F.sum("doc_tokens")).first()[0] or 0
    windows = Windows(total, length, powers)
    placed = tokens.join(F.broadcast(partition_starts(tokens)), "part")
    placed = placed.select("doc_id", (F.col("first") + F.col("before")).alias("first"), "doc_tokens", "width", "ids")

    def cut(batches):
        for batch in batches:
            first, count = (np.asarray(batch.column(k), np.int64) for k in (1, 2))
            if not len(first):
                continue
            data, offsets = buffers(batch.column(4))
            width = int(batch.column(3)[0].as_py())
            ids = data[int(offsets[0]) : int(offsets[-1])].view(f"<u{width}").astype("<u4")
            low, high = windows.of(first), windows.of(first + count - 1)
            pieces = high - low + 1
            row = np.repeat(np.arange(len(first)), pieces)
            sequence = np.repeat(low, pieces) + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.maximum(windows.start(sequence), first[row])
            stop = np.minimum(np.where(sequence == high[row], first[row] + count[row], windows.start(sequence + 1)), first[row] + count[row])
            sizes = stop - begin
            edges = np.concatenate([[0], np.cumsum(sizes)]) * 4
            own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), *[pa.array(x) for x in (begin - first[row], sizes)], own.cast(pa.binary()), *[pa.array(x) for x in (count[row], sequence, begin - windows.start(sequence))]],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces):
    """(sequence_id, length, ids): the token sequences themselves, ``ids`` as in the pieces; a sequence has at most as many pieces as tokens."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(part, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
