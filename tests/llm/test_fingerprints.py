import hashlib

import brute
import pytest

from tallyhouse.llm import chunk_fingerprint as c
from tallyhouse.llm.queries import QUERIES


def brute_chunks(text):
    return brute.chunks(text, c._GEAR, c.LEAST, c.NORMAL, c.MOST, c.HARD_BITS, c.EASY_BITS)


def test_chunks_equal_a_byte_by_byte_version(sample):
    texts = ["", "a", "é" * 500, "x" * 5000, *(t for _, t in sample[:12])]
    for text, found in zip(texts, c.fingerprints([t[:3000] for t in texts]), strict=True):
        plain = brute_chunks(text[:3000])
        assert b"".join(plain) == text[:3000].encode()
        assert sorted(found.values()) == sorted({p: len(p) for p in plain}.values())


@pytest.mark.parametrize("partitions", [1, 7])
def test_edits_and_neighbours(documents, sample, partitions):
    rows = [*{i: (i, t) for i, t in brute.awkward() if i is not None}.values(), *((1000 + i, t) for i, t in sample)]
    expected = brute.edited_texts(rows)
    out = c.chunk_fingerprints(documents(rows), partitions).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    prints = c.fingerprints([texts[i] or "" for i in texts])
    own = dict(zip(texts, prints, strict=True))
    for r in out:
        n, changed, following = expected[r.doc_id]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == c.written_out(own[r.doc_id])
        other, after = c.fingerprints([changed]), c.fingerprints([following])
        assert r.edited_fingerprint == c.written_out(other[0])
        assert r.near_edited == pytest.approx(c.containment(own[r.doc_id], other[0]))
        assert r.near_next == pytest.approx(c.containment(own[r.doc_id], after[0]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_likeness_tells_edits_from_neighbours(spark):
    out = QUERIES["op3_chunk_fingerprints"](spark, "/root/testdata/sf0.001").where("n_chars > 400").collect()
    assert sum(r.near_edited > r.near_next for r in out) > 0.9 * len(out)


def test_ties_nulls_and_empty_tables(documents):
    assert c.chunk_fingerprints(documents([(1, "x")]).where("false")).collect() == []
    alone = c.chunk_fingerprints(documents([(7, "abcdef")])).collect()
    assert [(r.doc_id, r.edited_sha256) for r in alone] == [(7, hashlib.sha256(b"abcabc").hexdigest())]
    out = c.chunk_fingerprints(documents([(None, None), (3, "same"), (3, "same"), (None, "x")])).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in out) == [("3", 4), ("3", 4), ("None", 0), ("None", 1)]


def test_ranges_of_a_small_sample_keep_every_document(spark):
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", "2")
    try:
        docs = spark.range(0, 5000, 1, 8).selectExpr("id * 7919 % 5003 AS doc_id", "concat('text of ', id) AS text")
        out = c.chunk_fingerprints(docs, 7).select("doc_id", "edited_sha256").collect()
    finally:
        spark.conf.unset("spark.sql.execution.rangeExchange.sampleSizePerPartition")
    texts = sorted(((i * 7919 % 5003, f"text of {i}") for i in range(5000)), reverse=True)
    expected = {d: hashlib.sha256(c.edited(t, texts[(k + 1) % 5000][1]).encode()).hexdigest() for k, (d, t) in enumerate(texts)}
    assert len(out) == 5000 and {r.doc_id: r.edited_sha256 for r in out} == expected
