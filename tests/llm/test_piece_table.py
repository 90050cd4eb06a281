"""Chunk-wise SentencePiece ids and decoded texts equal the library's."""

import numpy as np
import pyarrow as pa
import pytest
from explain import SMALL

from tallyhouse.llm.piece_table import _put_back, decode_documents, encode_documents, marked_chunks, packed, piece_processor, unpacked
from tallyhouse.llm.queries import op13_distinct_chunk_pieces

AWKWARD = [
    "", " ", "   ", "a ", " a", "  a   b ", "▁a", "a▁b ▁", "\x00a\tb\n c", "<s> hi </s><unk>", "é é Ａ　x​",
    "日本語のテキスト" * 50, "x" * 30_000, "ab " * 20_000, "🙂 🙂🙂", "﻿x", "word word word", "l'été d'où",
]


@pytest.fixture(scope="module")
def library():
    return piece_processor(None)


def expected(library, text):
    ids = library.encode(text or "")
    return ids, library.decode(ids)


@pytest.mark.parametrize(("block_bytes", "bucket_bytes"), [(64, 1 << 24), (1 << 24, 5_000)])
def test_awkward_texts(documents, library, block_bytes, bucket_bytes):
    rows = [(i, text) for i, text in enumerate(AWKWARD)] + [(7, None), (None, "a b"), (3, "a "), (3, "a ")]
    found = decode_documents(encode_documents(documents(rows), block_bytes=block_bytes, bucket_bytes=bucket_bytes)).collect()
    both = encode_documents(documents(rows), block_bytes=block_bytes, with_text=True).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, both))
    want = [(i, *expected(library, text)) for i, text in rows]
    assert sorted(map(repr, ((r.doc_id, list(r.ids), r.text) for r in found))) == sorted(map(repr, want))


def test_every_chunk_is_encoded_once_and_put_back(documents, library, sample):
    found = {r.doc_id: list(r.ids) for r in encode_documents(documents(sample)).collect()}
    assert found == {i: library.encode(text or "") for i, text in sample}


def test_empty_table(documents):
    assert decode_documents(encode_documents(documents([]))).collect() == []


def test_chunks_join_to_the_marked_text():
    for text in AWKWARD:
        assert "".join(marked_chunks(text)) == ("▁" + text.replace(" ", "▁") if text else "")


@pytest.mark.parametrize("top", [0, 255, 256, 65_536, 1 << 40])
def test_packed_numbers(top):
    values = np.array([0, top, 3, top // 2], np.uint64)
    assert unpacked(packed(values)).tolist() == values.tolist()
    assert unpacked(packed(values[:0])).tolist() == []


def test_a_changed_read_is_refused():
    one = pa.array([packed(np.array([0], np.uint64))])
    texts = pa.table({"doc_id": [1], "seen": [5], "places": one, "bucket": one})
    lists = pa.table({"digest": [6], "bucket": [0], "sizes": [b"\x01\x01"], "ids": [b"\x01\x07"]})
    with pytest.raises(ValueError, match="changed"):
        _put_back(None, False)(None, texts, lists)


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [(r.doc_id, r.text) for r in decode_documents(rows).orderBy("doc_id").collect()] == [(1, ""), (2, "")]


def test_query(spark, library):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in op13_distinct_chunk_pieces(spark, SMALL).collect():
        ids, text = expected(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
