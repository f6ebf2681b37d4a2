"""Shards of bounded size by extendible hashing."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.llm.text import row_key
from seispark.session import materialise

BITS = 60


def key_hash(key):
    """The first 60 bits of the key's MD5 as a long; a null key is the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _directory(rows, low, high, limit):
    """Directory entries for prefixes of ``high`` bits below buckets that ``low`` bits could not hold.

    Sums of the finest prefixes are added up bit by bit; a bucket is a leaf if it fits and its
    parent does not. Returns (_fine, _depth, _prefix, shard_bytes, _fits).
    """
    fine = rows.groupBy(F.shiftright("_hash", BITS - high).alias("_fine")).agg(F.sum("_bytes").alias("_sum"))
    up = fine.select("_fine", "_sum", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("_depth"))
    up = up.withColumn("_prefix", F.expr(f"shiftright(_fine, {high} - _depth)"))
    nodes = up.groupBy("_depth", "_prefix").agg(F.sum("_sum").alias("shard_bytes"))
    leaf = nodes.where((F.col("shard_bytes") <= limit) | (F.col("_depth") == high))
    found = up.join(leaf, ["_depth", "_prefix"]).groupBy("_fine").agg(
        F.min_by(F.struct("_depth", "_prefix", "shard_bytes"), "_depth").alias("_leaf")
    )
    return found.select("_fine", "_leaf.*", (F.col("_leaf.shard_bytes") <= limit).alias("_fits"))


def _pages(rows, limit):
    """Rows whose hash bits are used up: cut into pages of at most ``limit`` bytes.

    Rows are numbered within the parts of a written table, so one key may hold any number of them.
    A row over half the limit has a page of its own, the others fill pages to half and one row more.
    """
    rows = materialise(rows, "overflow").withColumn("_n", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_n", 33))
    large = 2 * F.col("_bytes") > limit
    order = Window.partitionBy("_hash", "_part").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(large, 0).otherwise(F.col("_bytes"))).over(order), F.lit(0))
    page = F.when(large, F.concat(F.lit("x"), F.col("_n"))).otherwise(F.concat_ws(".", "_part", F.floor(2 * before / F.lit(limit))))
    name = F.concat_ws("-", F.lpad(F.bin("_hash"), BITS, "0"), page)
    paged = materialise(rows.select("_id", "_bytes", name.alias("shard"), F.lit(BITS).alias("depth")), "pages")
    return paged.join(paged.groupBy("shard").agg(F.sum("_bytes").alias("shard_bytes")), "shard")


def shard(docs, limit, key=None, id_col="doc_id", text_col="text", step=16):
    """Shard of every document: (_id, shard, depth, n_bytes, shard_bytes).

    A shard is named by its hash prefix, bit by bit; a bucket over ``limit`` text bytes is split
    on its next bit, all others stay. ``step`` bits are looked at in one round, so that a
    directory part has at most 2**step rows for each bucket that is still too large; rows of
    buckets that fit take no part in later rounds. Rows that share all bits (copies of one key)
    go to pages; only a single row over the limit can then exceed it.
    A null key counts as the empty text, a null text as 0 bytes; equal rows each have a shard.
    """
    spark = docs.sparkSession
    ident, _, text = row_key(id_col, text_col)
    hashed = key_hash(F.col(id_col) if key is None else key).alias("_hash")
    rows = docs.select(ident, hashed, F.octet_length(text).cast("long").alias("_bytes"))
    done, low = [], 0
    while True:
        high = min(low + step, BITS)
        directory = materialise(_directory(rows, low, high, limit), "directory")
        placed = rows.withColumn("_fine", F.shiftright("_hash", BITS - high)).join(directory, "_fine")
        name = F.expr("case when _depth = 0 then '' else lpad(bin(_prefix), _depth, '0') end")
        done.append(placed.where("_fits").select("_id", "_bytes", name.alias("shard"), F.col("_depth").alias("depth"), "shard_bytes"))
        if directory.where("not _fits").isEmpty():
            break
        rows, low = placed.where("not _fits").select("_id", "_hash", "_bytes"), high
        if high == BITS:
            done.append(_pages(rows, limit).select(done[0].columns))
            break
    return reduce(lambda a, b: a.unionByName(b), done).withColumnRenamed("_bytes", "n_bytes")


def write_shards(rows, path, shard_col="shard"):
    """One folder per shard."""
    rows.repartition(shard_col).write.partitionBy(shard_col).parquet(path)
    return path
