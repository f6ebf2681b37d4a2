"""Exact top-k search by the threshold algorithm."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from seispark.session import materialise


def sorted_lists(vectors):
    """One list per dimension: places of the vectors in ascending order of that component."""
    return np.argsort(vectors, axis=0, kind="stable").T.copy()


def threshold_search(query, vectors, ids, lists, k, first=16):
    """(scores, ids) of the k best inner products, ties to smaller ids; ids equal to none is the caller's matter.

    Reads the lists from their best end for this query, to equal depth; each vector met is scored
    once. The bound is the score of a vector with the last component read in every list: nothing
    unseen can beat it. Reading stops when it is below the kth score (not at equality, for a smaller
    id may tie). Depth doubles, so a search reads at most twice what it needs.
    """
    n = len(vectors)
    up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
    seen = np.zeros(n, bool)
    score, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo, hi = 0, min(first, n)
    while lo < hi:
        met = np.zeros(n, bool)
        met[lists[up, lo:hi]] = True
        met[lists[down, n - hi : n - lo]] = True
        if not len(up) and not len(down):
            met[:] = True  # a query of zeros has no list to read
        new = np.flatnonzero(met & ~seen)
        seen[new] = True
        found = vectors[new] @ query
        if len(score) == k:
            near = found >= score[-1]
            new, found = new[near], found[near]
        score, best = np.concatenate([score, found]), np.concatenate([best, ids[new]])
        order = np.lexsort((best, -score))[:k]
        score, best = score[order], best[order]
        bound = query[up] @ vectors[lists[up, hi - 1], up] + query[down] @ vectors[lists[down, n - hi], down]
        if len(score) == k and bound < score[-1] or not (len(up) or len(down)):
            break
        lo, hi = hi, min(2 * hi, n)
    return score, best


def whole_vectors(table, id_col, vector_col, scale):
    """(_r, _id, _v, _d): vectors turned into floor(scale * x), rows numbered; those that take no part are left out."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    rows = rows.select(F.monotonically_increasing_id().alias("_r"), F.col(id_col).cast("long").alias("_id"), whole.alias("_v"))
    return rows.withColumn("_d", F.size("_v"))


def top_k(table, is_query, k=5, scale=256, id_col="vec_id", vector_col="embedding", block=16_384, together=2_048):
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query.

    Queries are the rows for which ``is_query`` holds; candidates all other rows with as many
    components. Vectors that are null or hold a null or non-finite component take no part, nor do
    null ids. Rows that share an id, or are equal, are rows of their own: each is a candidate of the others, and each query row
    has its own ranks. Ties go to the smaller id; a query without candidates gives no row.

    Candidates are dealt into blocks of about ``block`` vectors and queries into groups of about
    ``together``; each group meets each block once, where the threshold algorithm runs over the
    block's sorted lists. A block's results are k a query, ranked in a last step.
    """
    whole = materialise(whole_vectors(table, id_col, vector_col, scale), "vectors")
    asked = whole.where(is_query(F.col("_id")))
    n, q = whole.count(), asked.count()
    if not q:
        blocks = parts = 1
    else:
        blocks, parts = -(-n // block), -(-q // together)

    def dealt(rows, own, count, other, others):
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return rows.withColumn(own, F.pmod(F.xxhash64("_r"), F.lit(count)).cast("int")).withColumn(other, every)

    candidates = dealt(whole, "_b", blocks, "_p", parts)
    queries = dealt(asked, "_p", parts, "_b", blocks)

    def search(left, right):
        rows = []
        if len(left) and len(right):
            left = left.sort_values(["_id", "_r"])  # places in this order settle ties
            ids, numbers, vectors = left["_id"].to_numpy(np.int64), left["_r"].to_numpy(np.int64), np.stack(left["_v"].to_numpy()).astype(np.int64)
            lists, places = sorted_lists(vectors), np.arange(len(left))
            for own, name, query in zip(right["_r"], right["_id"], right["_v"]):
                score, best = threshold_search(np.asarray(query, np.int64), vectors, places, lists, k + 1)
                other = numbers[best] != own
                score, best = score[other][:k], best[other][:k]
                rows += [(own, name, i, r, s) for s, i, r in zip(score.tolist(), ids[best].tolist(), numbers[best].tolist())]
        return pd.DataFrame(rows, columns=["_q", "query_id", "vec_id", "_r", "score"]).astype("int64")

    keys = ["_d", "_b", "_p"]
    found = candidates.groupBy(keys).cogroup(queries.groupBy(keys)).applyInPandas(search, "_q long, query_id long, vec_id long, _r long, score long")
    rank = F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id", "_r"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
