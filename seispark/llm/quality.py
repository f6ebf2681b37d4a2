"""Quality classifier: support vectors on naive-Bayes features."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from seispark.llm.ngrams import indicators
from seispark.llm.text import row_key, sample_hash

#: Labelled rows that the classifier is fitted to, at most; those with the smallest hash of their id.
SAMPLE = 20_000
BITS = 18


class Indicators:
    """Indicator sets of many documents in one flat array; item i is a set scaled to unit length."""

    def __init__(self, sets):
        self.at = np.concatenate([*sets, np.zeros(0, np.int32)])
        self.ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        self.ratio = self.inverse = None

    def __len__(self):
        return len(self.ends) - 1

    def counts(self, rows, size):
        """In how many of the rows each bucket occurs."""
        total = np.zeros(size, np.int64)
        for i in rows:
            total[self.at[self.ends[i] : self.ends[i + 1]]] += 1  # a set holds a bucket once
        return total

    def scale(self, ratio):
        self.ratio = ratio
        square = [(ratio[self.at[a:b]] ** 2).sum() for a, b in zip(self.ends, self.ends[1:])]
        self.inverse = 1 / np.maximum(np.sqrt(square), 1e-12)

    def __getitem__(self, i):
        at = self.at[self.ends[i] : self.ends[i + 1]]
        return at, self.ratio[at] * self.inverse[i]


def log_count_ratios(good, bad, alpha=1.0):
    """log of each bucket's share of the good over its share of the bad documents' indicators."""
    good, bad = good + alpha, bad + alpha
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def dual_descent(vectors, signs, size, cost=1.0, rounds=12, seed=42):
    """Weights of the linear hinge-loss model over unit vectors (buckets, values); the last weight is the bias.

    One dual variable at a time takes its best value within [0, cost]; stops when no variable
    moves by more than a thousandth in a round.
    """
    w, dual = np.zeros(size + 1), np.zeros(len(vectors))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(vectors)):
            at, x = vectors[i]
            slope = signs[i] * (w[at] @ x + w[-1]) - 1
            new = min(cost, max(0.0, dual[i] - slope / 2))  # a unit vector and a one for the bias
            if step := new - dual[i]:
                w[at] += step * signs[i] * x
                w[-1] += step * signs[i]
                dual[i], moved = new, max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def fit(frames, bits=BITS):
    """Model rows (bucket, weight, square) of all labelled rows (label, buckets); bucket -1 has the bias."""
    pdf = pd.concat(frames, ignore_index=True)
    labels = pdf["label"].to_numpy(np.int64) if len(pdf) else np.zeros(0, np.int64)
    if len(set(labels)) < 2:
        bias = 0.0 if not len(labels) else 1.0 if labels[0] == 1 else -1.0
        return pd.DataFrame({"bucket": [-1], "weight": [bias], "square": [0.0]})
    vectors = Indicators([np.frombuffer(b, np.int32) for b in pdf["buckets"]])
    good, bad = (vectors.counts(np.flatnonzero(labels == k), 1 << bits) for k in (1, 0))
    ratio = log_count_ratios(good, bad)
    vectors.scale(ratio)
    w = dual_descent(vectors, 2 * labels - 1, 1 << bits)
    at = np.flatnonzero(good + bad)
    return pd.DataFrame(
        {"bucket": np.append(at, -1), "weight": np.append(w[at] * ratio[at], w[-1]), "square": np.append(ratio[at] ** 2, 0.0)}
    )


def labelled(docs, labels, sample, id_col, text_col, label_col):
    """(label, buckets) of at most ``sample`` labelled rows outside the held-out fold, in a fixed order."""
    known = labels.where(F.col(label_col).isin(0, 1) & (F.pmod(sample_hash(id_col), F.lit(3)) != 1))
    known = known.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).distinct()
    known = known.orderBy(F.xxhash64("_id"), "_id", "label").limit(sample)

    def work(batches):
        for batch in batches:
            sets = [b""] * len(batch)
            for lo, hi, row, bucket in indicators(batch.column(3), BITS):
                ends = np.searchsorted(row, np.arange(hi - lo + 1))
                for k in range(hi - lo):
                    sets[lo + k] = bucket[ends[k] : ends[k + 1]].astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], ["_id", "_h", "label", "buckets"])

    # at most ``sample`` rows of three numbers are broadcast
    rows = docs.select(*row_key(id_col, text_col)).join(F.broadcast(known), "_id").select("_id", "_h", "label", "_text")
    found = rows.mapInArrow(work, "_id long, _h long, label int, buckets binary")
    return found.orderBy(F.xxhash64("_id"), "_id", "_h", "label").limit(sample).select("label", "buckets")


def train(docs, labels, sample=SAMPLE, id_col="doc_id", text_col="text", label_col="quality"):
    """Model arrays (weights, squares, bias) learned from labelled documents outside the held-out fold.

    Indicators of words, signs and pairs of them are scaled by class log-count ratios and brought to
    unit length. The classifier, its ratios included, is fitted to the ``sample`` labelled rows with
    the smallest hash of their id; so few go through one task. Labels other than 0 and 1, null ids
    and labels without a document teach nothing. With one class alone every score is the same.
    """
    rows = labelled(docs, labels, sample, id_col, text_col, label_col)
    model = rows.repartition(1).sortWithinPartitions("label", "buckets").mapInPandas(lambda f: [fit([pd.DataFrame({"label": [], "buckets": []}), *f])], "bucket long, weight double, square double")
    pdf = model.toPandas()  # a row for each bucket at most
    weights, squares = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = float(pdf.loc[pdf["bucket"] < 0, "weight"].sum())
    at = pdf[pdf["bucket"] >= 0]
    weights[at["bucket"]], squares[at["bucket"]] = at["weight"], at["square"]
    return weights, squares, bias


def scores(array, model):
    """Score from 0 to 1 of each text of an Arrow array; 0.5 is the border."""
    weights, squares, bias = model
    margin = np.full(len(array), bias)
    for lo, hi, row, bucket in indicators(array, BITS):
        size = np.sqrt(np.bincount(row, squares[bucket], hi - lo))
        margin[lo:hi] += np.bincount(row, weights[bucket], hi - lo) / np.maximum(size, 1e-12)
    return pa.array(1 / (1 + np.exp(-np.clip(2 * margin, -500, 500))), pa.float64())


def scorer(model):
    """Column function text -> score; null and empty texts are scored by the bias alone."""
    return F.arrow_udf(lambda text: scores(text, model), "double")


def score(docs, model, id_col="doc_id", text_col="text"):
    """(id, held_out, score, predicted) of every row; a null id is held out as crc32 of the empty text says, that is not."""
    found = docs.select(F.col(id_col), F.coalesce(F.pmod(sample_hash(id_col), F.lit(3)) == 1, F.lit(False)).alias("held_out"), scorer(model)(F.col(text_col).cast("string")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs, model, text_col="text"):
    """The documents that the classifier accepts, columns as they were."""
    return docs.where(scorer(model)(F.col(f"`{text_col}`").cast("string")) >= 0.5)
