"""Circular transforms of whole traces, each spread over many tasks.

The transform of a trace of n samples is one of m = 2**k >= 2n - 1 points, laid out as a grid of rows and columns with
place row * columns + column. Four steps make it: transforms down the columns, a twist of every point by
its place, transforms along the rows, and there the spectrum is at hand. The way back is the same in reverse.
A task holds some whole columns or some whole rows, about two chunks of points; only pieces of the grid
(some rows of some columns) move between them. A trace of one chunk is a grid of one row, so its columns are
the samples themselves and one piece moves.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seispark.functions import kernels
from seispark.operators.chunks import CHUNK, attach, blocks, spread


class Grid:
    """Layout of the transform of one trace of ``n`` samples."""

    def __init__(self, n, size):
        bits = max(1, (2 * n - 2).bit_length())
        self.n, self.points, self.whole = n, 1 << bits, n <= size
        if self.whole:
            self.rows, self.columns = 1, self.points
            self.wide, self.tall = self.points, 1
            return
        area = 1 << ((2 * size).bit_length() - 1)
        self.rows, self.columns = 1 << (bits - bits // 2), 1 << bits // 2
        self.wide, self.tall = min(self.columns, max(1, area // self.rows)), min(self.rows, max(1, area // self.columns))

    @staticmethod
    def column_block(size, n="_n"):
        """SQL text: which block of columns sample i is in."""
        bits, area = f"length(bin(greatest(2 * {n} - 2, 1)))", (2 * size).bit_length() - 1
        wide = f"least({bits} div 2, greatest({area} - ({bits} - {bits} div 2), 0))"
        return f"if({n} <= {size}, 0L, cast(shiftright(i & (shiftleft(1L, cast({bits} div 2 as int)) - 1), cast({wide} as int)) as bigint))"

    def twist(self, block, first_row, rows, back=False):
        """Factors between the two steps for some rows of the spectrum and a block of columns (None: all)."""
        columns = np.arange(self.columns) if block is None else np.arange(block * self.wide, (block + 1) * self.wide)
        turn = np.outer(np.arange(first_row, first_row + rows), columns) % self.points
        return np.exp((2j if back else -2j) * np.pi / self.points * turn)

    def places(self, block):
        """Places of a block of columns, row by row."""
        return (np.arange(self.rows)[:, None] * self.columns + np.arange(block * self.wide, (block + 1) * self.wide)).ravel()

    def lags(self, places):
        """Signed distance that each place stands for."""
        return np.where(places < self.n, places, places - self.points)


@lru_cache(64)
def grid_of(n, size):
    return Grid(n, size)


@lru_cache(256)
def hilbert_spectrum(n, size):
    grid = grid_of(n, size)
    return np.fft.fft(Hilbert.kernel(grid, np.arange(grid.points)))[None]


class Hilbert:
    """h_<c> of every column: pairs of columns are one complex series; the kernel of the trace's length goes through the same steps."""

    def __init__(self, columns):
        self.columns = columns
        self.fields = [T.StructField("i", T.LongType()), *[T.StructField(f"h_{c}", T.DoubleType()) for c in columns]]

    def series(self, values):
        values = [*values, *[np.zeros(len(values[0]))] * (len(values) % 2)]
        return np.stack([a + 1j * b for a, b in zip(values[::2], values[1::2])])

    kernel_spectrum = staticmethod(hilbert_spectrum)

    @staticmethod
    def kernel(grid, places):
        lag = grid.lags(places)
        return np.where(np.abs(lag) < grid.n, kernels.hilbert_kernel(lag, grid.n), 0.0)

    def combine(self, spectra):
        return spectra[:-1] * spectra[-1]

    def kept(self, grid, places):
        return np.flatnonzero(places < grid.n)

    def rows(self, grid, places, y):
        parts = [p for z in y for p in (z.real, z.imag)][: len(self.columns)]
        return [places, *parts]


class Correlation:
    """(lag, position, c): sums of f[m + lag] * g[m] for every lag; position puts lag 0 first."""

    def __init__(self):
        self.fields = [T.StructField("lag", T.LongType()), T.StructField("position", T.LongType()), T.StructField("c", T.DoubleType())]

    def series(self, values):
        return np.stack(values).astype(complex)

    @staticmethod
    def kernel_spectrum(n, size):
        return None

    @staticmethod
    def kernel(grid, places):
        return None

    def combine(self, spectra):
        return spectra[:1] * np.conj(spectra[1:])

    def kept(self, grid, places):
        return np.flatnonzero((places < grid.n) | (places > grid.points - grid.n))

    def rows(self, grid, places, y):
        lag = grid.lags(places)
        return [lag, lag % (2 * grid.n - 1), y[0].real]


def _lists(column):
    """Arrays of one Arrow list column."""
    ends, values = np.asarray(column.offsets), np.asarray(column.values)
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _batch(schema, batch, row, columns):
    """Result batch: the trace of each result row, and the other columns."""
    trace = batch.column("trace").take(pa.array(row, pa.int64()))
    return pa.RecordBatch.from_arrays([trace, *columns], [f.name for f in schema])


def transform(samples, columns, what, size=CHUNK):
    """(trace, ...) as ``what`` makes them from the spectra of the columns of whole traces; samples are numbered from 0 without gaps."""
    trace = T.StructField("trace", samples.schema["trace"].dataType)
    names = [T.StructField("b", T.LongType()), T.StructField("q", T.LongType()), T.StructField("_n", T.LongType()), T.StructField("z", T.BinaryType())]
    pieces, final = T.StructType([trace, *names]), T.StructType([trace, *what.fields])

    def emit(batch, found):
        """found: (row of the batch, b, q, n, piece)."""
        row, *rest = zip(*found) if found else [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return _batch(pieces, batch, row, [pa.array(x, t) for x, t in zip(rest, types)])

    def down(batches):
        for batch in batches:
            values = [_lists(batch.column(c)) for c in columns]
            for row, (b, n) in enumerate(zip(batch.column("chunk").to_pylist(), batch.column("_n").to_pylist())):
                grid, series = grid_of(n, size), what.series([v[row] for v in values])
                if grid.whole:
                    yield emit(batch, [(row, 0, 0, n, series.tobytes())])
                    continue
                kernel = what.kernel(grid, grid.places(b))
                full = np.zeros((len(series) + (kernel is not None), grid.rows * grid.wide), complex)
                full[: len(series), : series.shape[1]] = series  # a block's samples in order are its places in order
                if kernel is not None:
                    full[-1] = kernel
                full = np.fft.fft(full.reshape(len(full), grid.rows, grid.wide), axis=1) * grid.twist(b, 0, grid.rows)
                yield emit(batch, [(row, b, q, n, np.ascontiguousarray(full[:, q * grid.tall : (q + 1) * grid.tall]).tobytes()) for q in range(grid.rows // grid.tall)])

    def along(batches):
        for batch in batches:
            met = batch.column("pieces")
            ends, blobs, n_of = np.asarray(met.offsets), met.values.field("z"), batch.column("_n").to_pylist()
            for row, (q, n) in enumerate(zip(batch.column("q").to_pylist(), n_of)):
                grid, own = grid_of(n, size), [np.frombuffer(blobs[int(k)].as_buffer(), complex) for k in range(ends[row], ends[row + 1])]
                if grid.whole:
                    spectra = np.fft.fft(own[0].reshape(-1, n), grid.points, axis=1)
                    if (kernel := what.kernel_spectrum(n, size)) is not None:
                        spectra = np.concatenate([spectra, kernel])
                    y = np.fft.ifft(what.combine(spectra), axis=1)[:, what.kept(grid, np.arange(grid.points))]
                    yield emit(batch, [(row, 0, 0, n, np.ascontiguousarray(y).tobytes())])
                    continue
                full = np.concatenate([o.reshape(-1, grid.tall, grid.wide) for o in own], axis=2)
                y = np.fft.ifft(what.combine(np.fft.fft(full, axis=2)), axis=2) * grid.twist(None, q * grid.tall, grid.tall, back=True)
                yield emit(batch, [(row, b, q, n, np.ascontiguousarray(y[:, :, b * grid.wide : (b + 1) * grid.wide]).tobytes()) for b in range(grid.columns // grid.wide)])

    def back(batches):
        for batch in batches:
            met = batch.column("pieces")
            ends, blobs, n_of = np.asarray(met.offsets), met.values.field("z"), batch.column("_n").to_pylist()
            rows, found = [], []
            for row, (b, n) in enumerate(zip(batch.column("b").to_pylist(), n_of)):
                grid, own = grid_of(n, size), [np.frombuffer(blobs[int(k)].as_buffer(), complex) for k in range(ends[row], ends[row + 1])]
                places = grid.places(b)
                kept = what.kept(grid, places)
                if grid.whole:
                    y = own[0].reshape(-1, len(kept))
                else:
                    full = np.concatenate([o.reshape(-1, grid.tall, grid.wide) for o in own], axis=1)
                    y = np.fft.ifft(full, axis=1).reshape(len(full), -1)[:, kept]
                rows.append(np.full(len(kept), row))
                found.append(what.rows(grid, places[kept], y))
            if found:
                arrays = [pa.array(np.ascontiguousarray(np.concatenate(x))) for x in zip(*found)]
                yield _batch(final, batch, np.concatenate(rows), arrays)

    def met(table, key, order):
        """All pieces of a block of rows or columns, in the order of the other."""
        parts = F.sort_array(F.collect_list(F.struct(order, "z"))).alias("pieces")
        return spread(table, "trace", key).groupBy("trace", key, "_n").agg(parts)

    counts = samples.groupBy("trace").agg(F.count("*").alias("_n"))
    dealt = attach(samples.select("trace", "chunk", "i", *columns), counts, "_n", size)
    dealt = dealt.withColumn("chunk", F.expr(Grid.column_block(size)))
    first = blocks(dealt, columns, extra=["_n"]).mapInArrow(down, pieces)
    second = met(first, "q", "b").mapInArrow(along, pieces)
    return met(second, "b", "q").mapInArrow(back, final)
