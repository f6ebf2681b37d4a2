"""Correlations of whole traces."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seispark.operators import fourier
from seispark.operators.chunks import CHUNK, attach, blocks, with_halo


def cross_correlation(pair, f="d", g="s", size=CHUNK):
    """(trace, lag, position, c): c is the sum over m of f[m+lag]*g[m]; position puts lag 0 first."""
    return fourier.transform(pair, [f, g], fourier.Correlation(), size).select("trace", "lag", "position", "c")


def best_shift(pair, most, size=CHUNK):
    """Lag within +-most samples at which s[m+lag]*d[m] sums to the most; the first one on a tie.

    Every chunk of d meets its chunk of s with a halo of ``most`` samples in one call, which returns its
    share for each lag; the shares of a trace are summed by lag.
    """

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def shares(d: pd.Series, s: pd.Series, lo: pd.Series, chunk: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for x, y, first, c, count in zip(d, s, lo, chunk, n):
            start, stop = c * size, min((c + 1) * size, count)
            wide = np.zeros(stop - start + 2 * most)  # s from start - most, nothing outside the trace
            at = first - start + most
            wide[at : at + len(y)] = np.asarray(y)[: len(wide) - at]
            out.append(np.correlate(wide, np.asarray(x)[start - first : stop - first], "valid"))
        return pd.Series(out)

    lengths = pair.groupBy("trace").agg(F.count("*").alias("_n"))
    known = attach(pair.select("trace", "chunk", "i", "d", "s"), lengths, "_n", size)
    edged = with_halo(known, most, most, size).where(f"chunk <= (_n - 1) div {size}")
    parts = blocks(edged, ["d", "s"], extra=["_n"]).select("trace", F.posexplode(shares("d", "s", "lo", "chunk", "_n")).alias("p", "c"))
    sums = parts.groupBy("trace", "p").agg(F.sum("c").alias("c"))
    top = sums.groupBy("trace").agg(F.max(F.struct("c", (-F.col("p")).alias("p"))).alias("top"))
    return top.select("trace", (-F.col("top.p") - most).cast("bigint").alias("lag"), F.col("top.c").alias("c"))
