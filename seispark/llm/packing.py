"""Best-fit packing of documents into sequences of several permitted lengths."""

from bisect import bisect_left, bisect_right, insort
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.llm.text import NULL_ID, row_key
from seispark.session import materialise

#: Permitted sequence lengths in words.
SIZES = (512, 1024, 2048, 4096)

#: A word with the blanks behind it; the first one also takes the blanks before it.
WORD = r"\S+\s*|^\s+\S*\s*"
BUCKETS = 256
#: Copies of one row that are told apart at once.
COPIES = 1 << 12


def pieces(docs, longest, id_col="doc_id", text_col="text"):
    """(_id, _h, piece, start, length): whole documents, or parts of ``longest`` words.

    A document has its words and one end mark, so that one without words has a piece as well.
    """
    ident, h, text = row_key(id_col, text_col)
    total = docs.select(ident, h, (F.regexp_count(text, F.lit(r"\S+")) + 1).cast("long").alias("_n"))
    part = total.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(longest).cast("long"))).alias("piece", "start"))
    return part.select("_id", "_h", "piece", "start", F.least(F.lit(longest).cast("long"), F.col("_n") - F.col("start")).alias("length"))


def preview(length, left, size, lengths, supply):
    """What a new bin of this size will hold: {length: pieces}, falling lengths first of ``left`` pieces, then of those nobody has claimed."""
    held, room, below = {length: min(size // length, left)}, size - min(size // length, left) * length, length
    while (at := bisect_right(lengths, min(room, below - 1)) - 1) >= 0:
        below = lengths[at]
        held[below] = min(supply[below], room // below)
        room -= held[below] * below
    return held


def choose(length, left, sizes, lengths, supply, overhead):
    """(size, contents, bins): the size whose bin costs least for the words it will hold, and how many such bins to open alike.

    A bin costs the least permitted size that holds its contents, and ``overhead``. The larger size on ties. The number of bins is
    that for which no size's contents change as pieces are claimed, so the choice is the same as bin by bin.
    """
    views = {}
    for size in sizes:
        if size >= length:
            held = preview(length, left, size, lengths, supply)
            words = sum(k * n for k, n in held.items())
            views[size] = held, (min(s for s in sizes if s >= words) + overhead) / words
    size = min(views, key=lambda s: (views[s][1], -s))
    held = views[size][0]
    steps = [((left if k == length else supply[k]) - other[k]) // n for other, _ in views.values() for k, n in held.items() if k in other]
    return size, held, 1 + min(steps)


def plan(histogram, sizes, overhead=64):
    """Placements of pieces known by length and rank: (length, first rank, pieces, first bin, offset), and the number of bins.

    Best fit in order of falling length, on counts: bins with the same room are one entry, as ranges of bin numbers, so
    the work follows the number of lengths and not the number of pieces. A piece goes where the least room is
    left over, the first such bin on ties. If no open bin has room, the size is opened that costs least for what the
    lengths still to come will fill (``choose``); these pieces are claimed, so that later bins do not count on them.
    """
    rooms, open_bins = [], {}  # rooms in order; room -> ranges (first bin, bins, words used)
    placed, bins = [], 0

    def keep(room, span):
        if span[1] and room:
            if room not in open_bins:
                insort(rooms, room)
                open_bins[room] = []
            heappush(open_bins[room], span)

    def fill(length, rank, left, room, first, count, used):
        """Fill ``count`` bins with up to ``left`` pieces, each bin as far as it goes; returns the next rank."""
        each = min(room // length, left)
        full = left // each if left < count * each else count
        for k in range(each if full else 0):
            placed.append((length, rank + k * full, full, first, used + k * length))
        rank += full * each
        keep(room - each * length, (first, full, used + each * length))
        rest, over = (left - full * each, count - full) if full < count else (0, 0)
        if over and rest:
            for k in range(rest):
                placed.append((length, rank + k, 1, first + full, used + k * length))
            rank += rest
            keep(room - rest * length, (first + full, 1, used + rest * length))
            full += 1
        keep(room, (first + full, count - full, used))
        return rank

    supply, lengths = dict(histogram), sorted(k for k, n in histogram if n)
    for length, number in sorted(histogram, reverse=True):
        rank = 0
        if lengths and lengths[-1] == length:
            lengths.pop()
        while rank < number:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count, used = heappop(open_bins[room])
                if not open_bins[room]:
                    rooms.pop(at)
                    del open_bins[room]
                rank = fill(length, rank, number - rank, room, first, count, used)
            else:
                size, held, count = choose(length, number - rank, sizes, lengths, supply, overhead)
                for k, n in held.items():
                    if k != length:
                        supply[k] -= n * count
                        if not supply[k]:
                            lengths.pop(bisect_left(lengths, k))
                rank = fill(length, rank, min(number - rank, held[length] * count), size, bins, count, 0)
                bins += count
    return placed, bins


def place(docs, sizes=SIZES, overhead=64, id_col="doc_id", text_col="text"):
    """(_id, _h, piece, start, length, bin_id, offset): where each piece lies.

    Only the number of pieces of each length (at most the longest size) goes to the driver, which plans by it. A
    piece is found by its rank among those of its length: ranks are counted within 256 buckets of a hash of the
    piece and shifted by the bucket's start, and equal rows are counted as one, so that neither a common length
    nor a common row meets in one task.
    """
    longest = max(sizes)
    found = pieces(docs, longest, id_col, text_col)
    same = found.groupBy("_id", "_h", "piece", "start", "length").agg(F.count("*").alias("_copies"))
    same = materialise(same.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_h", "piece"), F.lit(BUCKETS))), "pieces")
    counts = same.groupBy("length", "_bucket").agg(F.sum("_copies").alias("_sum"))
    histogram = [(r["length"], r["n"]) for r in counts.groupBy("length").agg(F.sum("_sum").alias("n")).collect()]
    placed, _ = plan(histogram, sorted(sizes), overhead)
    table = np.array(sorted(placed), np.int64).reshape(-1, 5)

    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_from"))
    order = Window.partitionBy("length", "_bucket").orderBy("_id", "_h", "piece").rowsBetween(Window.unboundedPreceding, -1)
    ranked = same.withColumn("_in", F.coalesce(F.sum("_copies").over(order), F.lit(0))).join(starts, ["length", "_bucket"])
    ranked = ranked.withColumn("_first", F.col("_from") + F.col("_in"))
    # a row repeated very often is exploded block by block, so that no array holds all its copies
    last = F.col("_first") + F.col("_copies") - 1
    ranked = ranked.withColumn("_last", last).withColumn("_at", F.explode(F.sequence("_first", "_last", F.lit(COPIES).cast("long"))))
    ranked = ranked.withColumn("_rank", F.explode(F.sequence("_at", F.least("_last", F.col("_at") + COPIES - 1))))

    def look_up(frames):
        wide = np.int64(1) << np.int64(44)
        keys = table[:, 0] * wide + table[:, 1]
        for pdf in frames:
            at = np.searchsorted(keys, pdf["length"].to_numpy(np.int64) * wide + pdf["_rank"].to_numpy(np.int64), "right") - 1
            bin_id = table[at, 3] + pdf["_rank"].to_numpy(np.int64) - table[at, 1] if len(pdf) else np.zeros(0, np.int64)
            yield pdf.drop(columns="_rank").assign(bin_id=bin_id, offset=table[at, 4] if len(pdf) else np.zeros(0, np.int64))

    columns = "_id", "_h", "piece", "start", "length"
    return ranked.select(*columns, "_rank").mapInPandas(look_up, "_id long, _h long, piece int, start long, length long, bin_id long, offset long")


def bins(placed, sizes=SIZES):
    """One row per bin: bin_id, size, used, pieces (doc_id, piece, start, length, offset) in order.

    ``size`` is the least permitted length that holds what the bin has in the end. A bin has at most as many pieces as words.
    """
    fit = F.least(*[F.when(F.col("used") <= s, s) for s in sorted(sizes)]) if len(sizes) > 1 else F.lit(sizes[0])
    ident = F.when(F.col("_id") != NULL_ID, F.col("_id")).alias("doc_id")
    part = F.struct("offset", ident, "piece", "start", "length", *(["text"] if "text" in placed.columns else []))
    found = placed.groupBy("bin_id").agg(F.sum("length").alias("used"), F.sort_array(F.collect_list(part)).alias("pieces"))
    return found.select("bin_id", fit.cast("int").alias("size"), "used", "pieces")


def pack(docs, sizes=SIZES, overhead=64, id_col="doc_id", text_col="text", texts=False):
    """Packed sequences of all documents, one row per bin as ``bins`` gives them; with ``texts`` each piece has its text.

    Lengths are in words, an end mark for each document included. A text with null or no words is its end mark
    alone; equal rows are packed once each. An empty table gives no bins. The texts of a document's pieces, in
    order, are the document.
    """
    placed = place(docs, sizes, overhead, id_col, text_col)
    if texts:
        # texts move once to meet their places and once to their bins; a document is cut before its places come
        ident, h, text = row_key(id_col, text_col)
        longest = max(sizes)
        words = docs.select(ident, h, text).groupBy("_id", "_h").agg(F.first("_text").alias("_text"))
        words = words.select("_id", "_h", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_words"))
        starts = F.sequence(F.lit(0), F.size("_words"), F.lit(longest))
        cuts = F.transform(starts, lambda k: F.array_join(F.slice(F.col("_words"), k + 1, F.lit(longest)), ""))
        placed = placed.join(words.select("_id", "_h", cuts.alias("_cuts")), ["_id", "_h"])
        placed = placed.withColumn("text", F.get("_cuts", F.col("piece"))).drop("_cuts")
    return bins(placed, sizes)
