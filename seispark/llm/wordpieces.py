"""Token ids of Arrow text arrays by a tokenizer file, with every distinct piece of text encoded once."""

import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from seispark.llm.ngrams import buffers, groups

#: Bytes of text that are cut up at once.
TOGETHER = 1 << 21
#: Pieces whose ids a worker keeps.
KNOWN = 400_000

#: Classes of bytes: 0 blank, 1 letter, 2 digit or sign, 3 apostrophe, 4 part of a longer character; 5 marks the letters of two bytes from U+00C0 to U+02BF.
KINDS = np.full(256, 2, np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = 0
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[39] = 3
KINDS[128:] = 4

#: Whether a text may be cut between bytes of two classes: at blanks, behind letters and between signs and letters, but not
#: behind an apostrophe ('ll is one token) nor beside a character that could combine with its neighbour.
CUT = np.zeros((6, 6), bool)
CUT[0, 1:] = CUT[1:, 0] = True
for _letter in (1, 5):
    CUT[_letter, [2, 3]] = CUT[2, _letter] = True


def kinds(data):
    """Class of each byte of whole characters."""
    kind = KINDS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xCA))
    after = data[lead + 1]
    lead = lead[~((data[lead] == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (data[lead] == 0xC4) & (after == 0xB0))]  # two signs, and the I whose lower case has a mark
    kind[lead] = kind[lead + 1] = 5
    return kind


def byte_letters():
    """Byte-level writing of the lower case of single letters: each UTF-8 byte is one printable character."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    symbol = {b: chr(b) if b in printable else chr(next(other)) for b in range(256)}
    letters = [c for c in map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x2C0)]) if c.isalpha() and len(c.lower()) == 1 and unicodedata.is_normalized("NFC", c)]
    return {ord(c): "".join(symbol[b] for b in c.lower().encode()) for c in letters}


BYTES_OF = byte_letters()
PLAIN = frozenset(map(chr, BYTES_OF))

#: The steps before the pair merges under which cutting changes no token.
CUTTING = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def may_cut(config):
    """Whether the tokenizer drops blanks and ends every run of letters, so that a text may be encoded in pieces."""
    before, steps = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    split = (steps.get("pretokenizers") or [{}])[0]
    return (
        before.get("normalizers") == CUTTING and split.get("pattern") == {"Regex": SPLIT} and split.get("behavior") == "Removed" and split.get("invert") is True
        and not config.get("truncation") and not any(t.get("lstrip") or t.get("rstrip") for t in config.get("added_tokens") or [])
    )


class Encoder:
    """Ids of texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    Where the tokenizer allows it, texts are cut at blanks and at the ends of words, distinct pieces are
    encoded once and remembered. Texts that hold the string of an added token are encoded whole, and so
    are all texts for other tokenizers.
    """

    def __init__(self, config):
        self.tokenizer = Tokenizer.from_str(config)
        parsed = json.loads(config)
        self.pieces = may_cut(parsed)
        self.added = [t["content"].encode() for t in parsed.get("added_tokens") or []]
        self.forget()

    def forget(self):
        self.place, self.flat, self.sizes = {}, array("I"), array("I")

    def whole(self, texts):
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words):
        """Places of pieces (bytes) among those known."""
        if len(self.place) > KNOWN:
            self.forget()
        new = [w for w in words if w not in self.place]
        if new:
            texts = [w.decode() for w in new]
            plain = [PLAIN.issuperset(t) for t in texts]  # such a piece is one run of letters: only the pair merges are left
            model = self.tokenizer.model
            other = iter(self.whole([t for t, p in zip(texts, plain) if not p]))
            for w, t, p in zip(new, texts, plain):
                ids = [x.id for x in model.tokenize(t.translate(BYTES_OF))] if p else next(other)
                self.place[w] = len(self.sizes)
                self.sizes.append(len(ids))
                self.flat.extend(ids)
        return np.array([self.place[w] for w in words], np.int64)

    def cut(self, data, offsets):
        """(ids, ends): ids of all texts in one array and where each text's ids end."""
        lo = int(offsets[0])
        data, offsets = data[lo : int(offsets[-1])], offsets - lo
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        kind = kinds(data)
        wide = np.append(kind[1:] == 4, False)
        wide[offsets[1:-1][offsets[1:-1] > 0] - 1] = False
        data = np.where((data >= 65) & (data <= 90) & ~wide, data + np.uint8(32), data)
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = CUT.ravel()[kind[:-1] * np.uint8(6) + kind[1:]]
        edge[offsets] = True
        at = np.flatnonzero(edge).astype(np.int64)
        full = kind[at[:-1]] > 0
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        found = found.filter(pa.array(full)).dictionary_encode()
        place = self.learn(found.dictionary.to_pylist())[found.indices.to_numpy()]
        flat, sizes = np.array(self.flat, np.uint32), np.array(self.sizes, np.int64)
        firsts, sizes = (np.cumsum(sizes) - sizes)[place], sizes[place]
        behind = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.arange(behind[-1]) + np.repeat(firsts - behind[:-1], sizes)] if behind[-1] else np.zeros(0, np.uint32)
        starts = at[:-1][full]
        return ids, behind[np.searchsorted(starts, offsets[1:])]

    def encode(self, array):
        """For each group of rows: (lo, hi, ids, sizes), all ids of its texts one after another and the number of each text's; null is empty."""
        data, offsets = buffers(array)
        for lo, hi in groups(offsets, TOGETHER):
            start, end = int(offsets[lo]), int(offsets[hi])
            joined = data[start:end].tobytes()
            if not self.pieces or any(a in joined for a in self.added):
                found = self.whole([data[a:b].tobytes().decode() for a, b in zip(offsets[lo:hi].tolist(), offsets[lo + 1 : hi + 1].tolist())])
                yield lo, hi, np.array([x for f in found for x in f], np.uint32), np.array([len(f) for f in found], np.int64)
            elif hi - lo == 1 and end - start > TOGETHER:
                ids = np.concatenate([self.cut(data, np.array([first, last]))[0] for first, last in long_cuts(data, start, end)])
                yield lo, hi, ids, np.array([len(ids)], np.int64)
            else:
                ids, ends = self.cut(data, offsets[lo : hi + 1])
                yield lo, hi, ids, np.diff(ends, prepend=0)


def long_cuts(data, start, end, limit=TOGETHER):
    """Ranges of a long text that end before a blank, of ``limit`` bytes or as many more as there are up to the next blank."""
    while start < end:
        last = start + limit
        while last < end:
            blank = np.flatnonzero(KINDS[data[last : last + limit]] == 0)
            if len(blank):
                last += int(blank[0])
                break
            last += limit
        last = min(last, end)
        yield start, last
        start = last


_LAST = {}


def encoder(config):
    """The worker's encoder for the text of a tokenizer file; it is kept for later tasks."""
    if config not in _LAST:
        _LAST.clear()
        _LAST[config] = Encoder(config)
    return _LAST[config]
