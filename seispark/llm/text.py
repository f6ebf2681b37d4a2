"""Column expressions shared by the corpus operators."""

import string

from pyspark.sql import functions as F

#: Blanks as the contracts name them: space and the code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
NULL_ID = -(2**63)


def ascii_lower(col):
    """A-Z lower-cased, every other character as it is.

    ``lower`` is quick but changes other letters too, so it serves texts of ASCII alone.
    """
    col = F.col(col) if isinstance(col, str) else col
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def row_key(id_col, text_col, *others):
    """(id, text hash) columns that tell rows apart; equal rows share them, which no operator minds.

    A null id counts as one id below all others, a null text as empty.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text")


def carried(docs, id_col="doc_id", text_col="text"):
    """The rows as a struct ``_row`` beside their key and text, so that no column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *row_key(id_col, text_col))


def with_fields(row, columns, **new):
    """Columns of the carried row, those in ``new`` replaced."""
    return [new[c].alias(c) if c in new else F.col(f"{row}.`{c}`").alias(c) for c in columns]


def sample_hash(id_col):
    """crc32 of the id as text, which deals rows into folds."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))
