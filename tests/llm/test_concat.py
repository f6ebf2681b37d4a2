"""Concatenate and cut against whole-text encoding and plain loops."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import awkward, with_clash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seispark.llm import concat, wordpieces

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
CONFIG = open(PATH, encoding="utf-8").read()
OTHER = public_tokenizers.path("byte_bpe_50k.json")


def whole(text, tokenizer=TOKENIZER):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def encoded(texts, config=CONFIG):
    return ids_of(wordpieces.encoder(config), pa.array(texts, pa.string()))


def ids_of(encoder, array):
    found = []
    for lo, hi, ids, sizes in encoder.encode(array):
        assert lo == len(found) and hi - lo == len(sizes)
        ends = np.cumsum(sizes)
        found += [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]
    return found


PARTS = ["It's", "'start", "I'LL", " ", "\n\t", "Ab", "é", "E", "́", "J̌", "×", "ñ", "Ǆ", "İ", "ʰ", "ÿ'll", "Ÿ,", "ŉ", "1", "23", "=", "̸", "!?", "'", "''s", "ß", "İ", "Σ", "<|endoftext|>", "<|end", "日本", " ", " ", "x" * 30, "a.b", "-"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    assert encoded(texts) == [whole(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert encoded(texts) == [whole(t) for t in texts]


def test_long_texts_nulls_and_slices(monkeypatch):
    monkeypatch.setattr(wordpieces, "TOGETHER", 64)
    monkeypatch.setattr(wordpieces, "KNOWN", 5)
    texts = ["It's a LONG text, isn't it? " * 20, None, "", "x" * 300, "one\ntwo\t" * 50, "é" * 100 + " b", " " * 200]
    assert encoded(texts) == [whole(t) for t in texts]
    part = pa.array(texts, pa.string()).slice(2, 3)
    assert ids_of(wordpieces.Encoder(CONFIG), part) == [whole(t) for t in texts[2:5]]


def test_other_tokenizers_encode_whole_texts():
    texts = ["It's a text,  isn't it?", "two\n lines", None]
    config = open(OTHER, encoding="utf-8").read()
    assert not wordpieces.Encoder(config).pieces
    assert encoded(texts, config) == [whole(t, Tokenizer.from_file(OTHER)) for t in texts]


def check(rows, pieces, length, powers=True, end=1, tokenizer=TOKENIZER):
    """Every document whole, every sequence without a gap, padding none."""
    documents, sequences = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert len(ids) == p["length"] > 0
        documents.setdefault(p["doc_id"], []).append((p["start"], p["length"], p["doc_tokens"], ids))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    expected = {}
    for i, t in rows:
        expected.setdefault(i, []).append([*whole(t, tokenizer), end])
    assert set(documents) == set(expected)
    for i, own in expected.items():
        assert sorted(x for d in documents[i] for x in d[3]) == sorted(x for o in own for x in o)
        if len(own) == 1:
            at, ids = 0, []
            for start, n, total, part in sorted(documents[i]):
                assert start == at and total == len(own[0])
                at += n
                ids += part
            assert ids == own[0]
    sizes = []
    for k in sorted(sequences):
        at = 0
        for offset, n in sorted(sequences[k]):
            assert offset == at
            at += n
        sizes.append(at)
    assert sorted(sequences) == list(range(len(sizes)))
    total = sum(len(d) for own in expected.values() for d in own)
    assert sum(sizes) == total and sizes[: total // length] == [length] * (total // length)
    rest = sizes[total // length :]
    assert all(n & (n - 1) == 0 for n in rest) if powers else len(rest) <= 1
    return sizes


@pytest.mark.parametrize("length, powers", [(16, True), (2048, True), (100, False)])
def test_documents_and_sequences_are_whole(spark, length, powers):
    rows = awkward() + [(20 + k, "word " * k) for k in range(40)]
    found = concat.pack(with_clash(spark, rows).repartition(7), PATH, length=length, powers=powers)
    pieces = found.collect()
    check(rows, pieces, length, powers)
    joined = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        joined[p["sequence_id"]] = joined.get(p["sequence_id"], b"") + bytes(p["ids"])
    assert {r["sequence_id"]: bytes(r["ids"]) for r in concat.sequences(found).collect()} == joined


def test_wide_ids_and_other_end(spark):
    rows = [(1, "some text"), (2, None), (3, "more text of three")]
    check(rows, concat.pack(with_clash(spark, rows), OTHER, end=70_000, length=4).collect(), 4, end=70_000, tokenizer=Tokenizer.from_file(OTHER))


def test_empty_table(spark):
    assert concat.pack(with_clash(spark, []), PATH).collect() == []


def test_sums_over_many_partitions(spark):
    rows = spark.range(1000).selectExpr("cast(id % 150 as int) as part", "id % 7 as doc_tokens")
    got = {r["part"]: r["first"] for r in concat.partition_starts(rows).collect()}
    totals = np.zeros(150, np.int64)
    for k in range(1000):
        totals[k % 150] += k % 7
    assert [got[p] for p in range(150)] == (np.cumsum(totals) - totals).tolist()


def test_query(spark, small):
    from seispark.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = QUERIES["op13_concatenate_and_cut"](spark, small).collect()
    ids = {i: [*whole(t), 1] for i, t in rows}
    padded = 0
    for p in got:
        own = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4")
        assert zlib.crc32(own.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        padded += p["length"]
    assert padded == sum(map(len, ids.values()))
