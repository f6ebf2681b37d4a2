"""N-gram features of Arrow text arrays, counted on the bytes of many texts at once."""

import numpy as np
import pyarrow as pa

#: Bytes worked on at once; a longer text is taken in pieces, so that memory stays bounded.
PIECE = 1 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x100000001B3


def buffers(array):
    """(bytes, offsets) of a string or binary array; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def groups(offsets, limit=None):
    """Row ranges (lo, hi) of at most ``limit`` bytes, or of one longer row."""
    lo, n, limit = 0, len(offsets) - 1, limit or PIECE
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def cuts(data, lo, hi, limit=None, *, classes=None):
    """Ends of the pieces of one long text: behind the last byte of class 0 in a piece, or behind the first one after it, so that no token is cut."""
    blank, limit = (CLASSES if classes is None else classes) == 0, limit or PIECE
    ends = []
    while hi - lo > limit:
        found = np.flatnonzero(blank[data[lo : lo + limit]])
        at = lo + limit
        if len(found):
            lo += int(found[-1]) + 1
        else:
            while at < hi and not len(found := np.flatnonzero(blank[data[at : min(at + limit, hi)]])):
                at += limit
            lo = at + int(found[0]) + 1 if at < hi else hi
        if lo < hi:
            ends.append(lo)
    return [*ends, hi]


def _powers(n, cache={}):  # noqa: B006
    """Powers of an odd base and of its inverse modulo 2**64, at least n of each."""
    if len(cache.get("up", ())) < n:
        inverse = pow(_BASE, -1, 2**64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(max(n, PIECE + 1), base, np.uint64)
            steps[0] = 1
            cache[name] = np.multiply.accumulate(steps)
    return cache["up"], cache["down"]


#: Class of a byte: 0 blank, 1 letter, digit or part of a longer character, 2 another sign.
CLASSES = np.full(256, 2, np.uint8)
CLASSES[[9, 10, 11, 12, 13, 32]] = 0
CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def tokens(data, offsets, classes=CLASSES):
    """(hash, row) of each run of bytes of one class other than 0, in order; runs end with their text."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    part = data[lo:hi]
    if not len(part):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = classes[part]
    edge = np.empty(len(part) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets - lo] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    word = kind[starts] > 0
    starts, ends = starts[word], ends[word]
    up, down = _powers(len(part) + 1)
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return hashes, np.searchsorted(offsets - lo, starts, "right") - 1


def mix(hashes, bits):
    """Well-spread buckets of ``bits`` bits."""
    h = hashes * _MUL
    h ^= h >> np.uint64(32)
    return ((h * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def token_hashes(data, offsets, classes=CLASSES):
    """``tokens`` of some texts, or of one text longer than a piece, whose tokens are hashed piece by piece."""
    start, end = int(offsets[0]), int(offsets[-1])
    if len(offsets) != 2 or end - start <= PIECE:
        return tokens(data, offsets, classes)
    hashes = []
    for cut in cuts(data, start, end, classes=classes):
        hashes.append(tokens(data, np.array([start, cut]), classes)[0])
        start = cut
    hashes = np.concatenate(hashes)
    return hashes, np.zeros(len(hashes), np.int64)


def _indicators(data, offsets, bits):
    """Distinct keys row << bits | bucket of words, signs and pairs of them."""
    h, row = token_hashes(data, offsets)
    if not len(h):
        return np.zeros(0, np.int64)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    h = np.where(again, np.uint64(1), h)  # a repeated token counts as a mark of its own
    pair = row[1:] == row[:-1]
    both = (h[:-1] * _MIX + h[1:] + np.uint64(7))[pair]
    keys = np.concatenate([row << bits | mix(h, bits), row[1:][pair] << bits | mix(both, bits)])
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def indicators(array, bits):
    """For each group of rows: (lo, hi, row in group, bucket), each pair once and in order.

    A bucket stands for a word, a run of signs or two of them that follow each other. The words of a text longer
    than a piece are hashed piece by piece, cut where no word runs; marks and pairs go over all of them.
    """
    data, offsets = buffers(array)
    for lo, hi in groups(offsets):
        keys = _indicators(data, offsets[lo : hi + 1], bits)
        yield lo, hi, keys >> bits, keys & ((1 << bits) - 1)


#: Bytes for language n-grams: letters of ASCII as they are, all other ASCII as a blank.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[97:123] = range(97, 123)
LETTERS[65:91] = range(97, 123)
LETTERS[128:] = range(128, 256)


def _trigrams(part, bits):
    """Bucket at each place of three bytes whose middle one is no blank; -1 elsewhere."""
    b = LETTERS[part].astype(np.uint64)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    found = mix((b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]) + np.uint64(1), bits)
    found[b[1:-1] == 32] = -1
    return found


def trigram_counts(array, bits):
    """For each group of rows: (lo, hi, row in group, bucket, count) of letter trigrams, in order."""
    data, offsets = buffers(array)
    for lo, hi in groups(offsets):
        start, end = int(offsets[lo]), int(offsets[hi])
        if end - start > PIECE:
            counts = np.zeros(1 << bits, np.int64)
            for at in range(start, end, PIECE):  # two bytes over, so that each place is seen once
                found = _trigrams(data[at : min(at + PIECE + 2, end)], bits)
                counts += np.bincount(found[found >= 0], minlength=1 << bits)
            bucket = np.flatnonzero(counts)
            yield lo, hi, np.zeros(len(bucket), np.int64), bucket, counts[bucket]
            continue
        found = _trigrams(data[start:end], bits)
        row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo : hi + 1]))
        # places whose three bytes lie in one text
        whole = (found >= 0) & (row[:-2] == row[2:]) if len(found) else np.zeros(0, bool)
        keys = (row[:-2][whole] << bits | found[whole]).astype(np.int64) if len(found) else np.zeros(0, np.int64)
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        yield lo, hi, keys[first] >> bits, keys[first] & ((1 << bits) - 1), np.diff(np.append(first, len(keys)))
