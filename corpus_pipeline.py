"""Corpus pipeline: each stage works on what the one before it kept."""

from seispark.llm import decontaminate, line_dedup, near_copies, packing, quality
from seispark.session import materialise

#: Near copies share 0.8 of their five-word shingles or more. Candidates have 128-bit fingerprints at most 28 bits apart: those of texts
#: with that share differ by 19 bits on average, a deviation of 4. In a fingerprint a text of fewer than seven words is one shingle.
NEAR = {"shingle": 5, "similarity": 0.8, "lanes": 2, "radius": 28, "least": 7}


def classify_quality(spark, docs, sf_dir):
    """Documents that the classifier, learned from the labels, accepts."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_lines(spark, docs, sf_dir):
    """Documents without the lines that several of them share; ``n_chars`` follows."""
    return line_dedup.stage(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies: the one with the smallest id (null first). Empty texts are copies of each other."""
    return near_copies.one_of_each(docs, **NEAR)


def drop_leaks(spark, docs, sf_dir):
    """Documents that hold no test item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark, docs, sf_dir):
    """Packed sequences with their pieces' texts; ``doc_id`` and place of each piece are in ``pieces``."""
    return packing.pack(docs, texts=True)


STAGES = [
    ("quality classifier", classify_quality),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack_sequences),
]

#: Training, fingerprints and packing are not expressed in plain SQL; tests compare with loops.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents; each result is a written table, from which the next stage starts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
