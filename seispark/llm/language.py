"""Language of a document as a mixture of languages."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from seispark.llm.ngrams import trigram_counts
from seispark.llm.text import sample_hash

BITS = 16
FOLDS = 5


def corpus_counts(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """(lang, bucket, n): letter trigrams of all documents outside the held-out fold that name their language."""

    def work(batches):
        total = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, row, bucket, n in trigram_counts(batch.column(1), BITS):
                names, code = np.unique(langs[lo:hi].astype(str), return_inverse=True)
                for k, name in enumerate(names):
                    own = code[row] == k
                    total.setdefault(name, np.zeros(1 << BITS, np.int64))
                    total[name] += np.bincount(bucket[own], n[own], 1 << BITS).astype(np.int64)
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["lang", "bucket", "n"]
            )

    learn = F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.coalesce(F.pmod(sample_hash(id_col), F.lit(FOLDS)), F.lit(1)) != 0)
    rows = docs.where(learn).select(F.col(lang_col).cast("string"), F.col(text_col).cast("string"))
    return rows.mapInArrow(work, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs, smooth=0.1, **columns):
    """(languages, log-likelihoods): one row of the array for each trigram bucket, one column for each language.

    All documents outside the held-out fold are counted; the model has 2**16 numbers for each language.
    """
    pdf = corpus_counts(docs, **columns).toPandas()
    langs = sorted(pdf["lang"].unique())
    counts = np.full((1 << BITS, len(langs)), smooth)
    if len(langs):
        np.add.at(counts, (pdf["bucket"].to_numpy(np.int64), np.searchsorted(langs, pdf["lang"])), pdf["n"].to_numpy(float))
    return langs, np.log(counts / counts.sum(axis=0))


def _summed(values, row, rows):
    """Sums over the entries of each row; entries are in order of their row."""
    out = np.zeros((rows, *values.shape[1:]))
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else []
    if len(row):
        out[row[first]] = np.add.reduceat(values, first, axis=0)
    return out


def expectation_maximisation(like, n, row, start, rounds=12):
    """(proportions, log-likelihood) of each document; ``start`` has zeros for languages that are left out.

    like: likelihood of each entry's trigram in each language; n: its count; row: its document.
    """
    rows = len(start)
    size = np.maximum(_summed(n, row, rows), 1e-300)[:, None]
    share = start
    for _ in range(rounds):
        part = like * share[row]
        part *= (n / np.maximum(part.sum(axis=1), 1e-300))[:, None]
        share = _summed(part, row, rows) / size
    total = (like * share[row]).sum(axis=1)
    return share, _summed(n * np.log(np.maximum(total, 1e-300)), row, rows)


def mixtures(row, bucket, n, rows, logs, penalty=1.0):
    """Proportions of the chosen languages of each document (rows x languages).

    A fit of all languages orders them; sets of the first one, two, ... are fitted anew as long as the
    likelihood gains more than ``penalty`` half logs of the number of trigrams for the added language.
    """
    langs = logs.shape[1]
    logs = logs[bucket]
    top = logs.max(axis=1, keepdims=True)
    like, n = np.exp(logs - top), n.astype(float)
    full, _ = expectation_maximisation(like, n, row, np.full((rows, langs), 1 / langs))
    order = np.argsort(-full, axis=1, kind="stable")
    cost = penalty * 0.5 * np.log(np.maximum(_summed(n, row, rows), 2))
    best = np.zeros((rows, langs))
    best[np.arange(rows), order[:, 0]] = 1
    alone = like[np.arange(len(row)), order[row, 0]]
    value = _summed(n * np.log(np.maximum(alone, 1e-300)), row, rows)
    going = np.arange(rows)
    for k in range(2, langs + 1):
        kept = np.isin(row, going) if len(going) < rows else slice(None)
        at = np.searchsorted(going, row[kept])
        start = np.zeros((len(going), langs))
        np.put_along_axis(start, order[going, :k], 1 / k, axis=1)
        share, gained = expectation_maximisation(like[kept], n[kept], at, start)
        better = gained - cost[going] * (k - 1) > value[going]
        best[going[better]] = share[better]
        value[going[better]] = (gained - cost[going] * (k - 1))[better]
        going = going[better]
        if not len(going):
            break
    return best


def predict(docs, model, id_col="doc_id", text_col="text"):
    """(id, held_out, lang_pred, score) of every row.

    ``lang_pred`` has the greatest proportion of the document's languages, ties to the first by name;
    score is that proportion. A text that is null or has no letter is ``und`` with score 0, as is every
    text if nothing was learned; a text with letters but no trigram takes the language whose trigrams are most frequent.
    """
    langs, logs = model

    def work(batches):
        for batch in batches:
            pred, score = np.full(len(batch), "und", object), np.zeros(len(batch))
            for lo, hi, row, bucket, n in trigram_counts(batch.column(3), BITS):
                if langs:
                    share = mixtures(row, bucket, n, hi - lo, logs)
                    pred[lo:hi] = np.array(langs, object)[share.argmax(axis=1)]
                    score[lo:hi] = np.minimum(share.max(axis=1), 1.0)
            letter = np.array(batch.column(2).to_pylist(), bool)
            pred[~letter], score[~letter] = "und", 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(pred, pa.string()), pa.array(score, pa.float64())], [id_col, "held_out", "lang_pred", "score"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    held = F.coalesce(F.pmod(sample_hash(id_col), F.lit(FOLDS)) == 0, F.lit(False)).alias("held_out")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), held, text.rlike(r"\p{L}").alias("_letter"), text.alias("_text"))
    return rows.mapInArrow(work, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")
