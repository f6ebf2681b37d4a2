"""Drop lines that several documents share."""

from pyspark.sql import functions as F

from seispark.llm.text import BLANKS, ascii_lower, carried, with_fields
from seispark.session import materialise


def _lines(rows, min_chars):
    """(_id, _h, _pos, key hash in two halves) of every line long enough to count."""
    split = rows.select("_id", "_h", F.posexplode(F.split(ascii_lower("_text"), "\n", -1)).alias("_pos", "_line"))
    key = split.select("_id", "_h", "_pos", F.btrim("_line", F.lit(BLANKS)).alias("_key")).where(F.char_length("_key") >= min_chars)
    return key.select("_id", "_h", "_pos", F.xxhash64("_key").alias("_k1"), F.xxhash64(F.lit(1), "_key").alias("_k2"))


def drop_repeated_lines(docs, id_col="doc_id", text_col="text", min_docs=2, min_chars=10):
    """Documents without the lines that at least ``min_docs`` documents hold.

    A line's key is the line stripped of blanks, A-Z lower-cased. Only the smallest id that
    holds a shared key keeps its lines, all of them. Returns (_row, kept text ``kept``,
    ``n_lines``, ``n_dropped``); ``_row`` is the row as it came.

    Hashes of lines are counted with map-side sums, and only places of dropped lines go
    back to their documents, so a line in a third of all documents makes no large group.
    A null or empty text is one empty line. Rows with the same id are one document when
    documents are counted, and each comes back; null ids are one document below all others.
    """
    rows = carried(docs, id_col, text_col)
    lines = _lines(rows, min_chars)
    if min_docs == 2:  # two documents hold it exactly if its least and greatest id differ
        shared = lines.groupBy("_k1", "_k2").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where("_first < _last")
    else:
        held = lines.groupBy("_k1", "_k2", "_id").agg(F.lit(1).alias("_one"))
        shared = held.groupBy("_k1", "_k2").agg(F.count("*").alias("_docs"), F.min("_id").alias("_first")).where(F.col("_docs") >= min_docs)
    # as a written table it is dealt for the join alone, so that adaptive execution can split a hot line
    shared = materialise(shared.select("_k1", "_k2", "_first"), "shared-lines")
    lost = (
        lines.join(shared, ["_k1", "_k2"])
        .where("_id != _first")
        .groupBy("_id", "_h")
        .agg(F.collect_set("_pos").alias("_lost"))
    )
    parts = rows.join(lost, ["_id", "_h"], "left").withColumn("_parts", F.split("_text", "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_lost"))
    kept = F.array_join(F.transform(left, lambda i: F.col("_parts")[i]), "\n")
    return parts.select(
        "_row",
        F.when(F.col("_lost").isNull(), F.col("_text")).otherwise(kept).alias("kept"),
        F.size("_parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def stage(docs, id_col="doc_id", text_col="text", **options):
    """The documents with their kept lines; ``n_chars`` follows the text where there is one."""
    new = {text_col: F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return drop_repeated_lines(docs, id_col, text_col, **options).select(with_fields("_row", docs.columns, **new))
