import zlib

import brute
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyhouse.llm.packing import WordIds, byte_level_encoder, pack_documents, token_ids

SPACES = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n \nY", "x \ny", "x\n y", "x \t y", "a\xa0 b", "a\xa0b c", "x\n ", "don't  'll s", "a b\u2003 c", "12 34 5x<|endoftext|> y", "é 𝒳 ü", "a \x1c b", "\x85 x"]


def library_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_library(sample):
    texts = [*SPACES, *(t or "" for _, t in brute.awkward()), *(t for _, t in sample)]
    known = WordIds(byte_level_encoder(None), 1000)
    assert [np.frombuffer(token_ids(t, known), np.uint32).tolist() for t in texts] == library_ids(texts)


def check(rows, pieces, tokens=2048, segments=64):
    ids = {}
    for (i, t), x in zip(rows, library_ids([t or "" for _, t in rows]), strict=True):
        ids.setdefault(i, []).append([*x, 1])
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        assert sum(p.length for p in own) == sum(map(len, ids[i]))
        if len(ids[i]) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                part = np.array(ids[i][0][at : at + p.length], np.uint32)
                assert p.start == at and p.doc_tokens == len(ids[i][0]) and p.ids_crc32 == zlib.crc32(part.tobytes())
                at += p.length
            assert at == len(ids[i][0])
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= tokens and len(own) <= segments
        padding += 0 if at & (at - 1) == 0 else tokens - at
    return padding, sum(map(len, (x for v in ids.values() for x in v)))


def test_every_id_is_packed_once_with_little_padding(documents, sample):
    rows = brute.awkward() + [(1000 + i, t) for i, t in sample]
    padding, total = check(rows, pack_documents(documents(rows)).collect())
    assert padding <= 0.01 * total


def test_limits_on_segments_and_loss(documents, spark):
    rows = [(i, "word " * (i % 9)) for i in range(300)]
    check(rows, pack_documents(documents(rows), max_tokens=64, max_segments=3).collect(), 64, 3)
    table = spark.createDataFrame([(i, "one two three four five six seven " * 3, 10 if i % 2 else 0) for i in range(60)], "doc_id long, text string, prompt int")
    out = pack_documents(table, max_tokens=64, max_loss=30, loss_start="prompt", with_ids=True).collect()
    start = {i: 10 if i % 2 else 0 for i in range(60)}
    loss, sizes = {}, {}
    for p in out:
        bearing = max(0, p.start + p.length - max(p.start, start[p.doc_id]))
        loss[p.sequence_id] = loss.get(p.sequence_id, 0) + bearing
        sizes[p.sequence_id] = sizes.get(p.sequence_id, 0) + p.length
        assert len(p.ids) == p.length
    assert max(loss.values()) <= 30 and max(sizes.values()) <= 64
    assert sum(sizes.values()) == sum({p.doc_id: p.doc_tokens for p in out}.values())


def test_very_short_documents_need_no_padding(documents):
    for n, words in ((20_000, 4), (20_000, 9), (3_000, 1)):
        rows = [(i, " ".join(["word"] * words)) for i in range(n)]
        padding, total = check(rows, pack_documents(documents(rows)).collect())
        assert padding <= 0.01 * total, (words, padding, total)


def test_loss_limit_needs_no_padding(documents):
    rows = [(i, "word " * (50 + i % 300)) for i in range(300)]
    pieces = pack_documents(documents(rows), max_loss=1500).collect()
    padding, total = check(rows, pieces)
    sizes = {}
    for p in pieces:
        sizes[p.sequence_id] = sizes.get(p.sequence_id, 0) + p.length
    assert padding == 0 and max(sizes.values()) <= 1500


def test_empty_table(documents):
    assert pack_documents(documents([(1, "x")]).where("false")).collect() == []
    assert [(p.doc_id, p.length, p.offset) for p in pack_documents(documents([(None, None)])).collect()] == [(None, 1, 0)]
