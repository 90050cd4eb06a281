"""Alignment of the tokens of two vocabularies over the bytes of the same texts, on Arrow tables.

A block of texts is two list columns of ids. Flattened with their parent indices, the token
lengths become byte offsets by a running sum that starts anew in every document. An Acero full
outer join of both sides on (document, end offset) yields every end in the text: ends of both
sides close a group, and the span before any end lies in exactly one token of either side, so
each row of the join is one link and no overlaps are searched. `Table.group_by` counts the
documents of every linked pair of ids within a block; Spark adds the counts of all blocks,
finds the best partner of each id, and sends the totals back to the blocks as one row per
distinct pair of a block, where they are summed over the links of each document.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .packing import CACHE_WORDS, WordIds, byte_level_encoder, byte_level_ranks, token_ids
from .piece_table import MARK, chunk_encoder, marked_chunks, piece_processor
from .tables import written
from .words import slices

BLOCK_BYTES = 2 << 20

_GROUP = pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
_SUMS = "doc_id long, n_a long, n_b long, n_groups long, n_links long"
_ROWS = f"block long, {_SUMS}, groups_sha256 string, codes array<int>, times array<int>, code int, a int, b int, docs long"
_GROUPS = ", groups array<struct<a: array<int>, b: array<int>>>"


class PieceIds:
    """Ids of marked chunks as little-endian 32-bit integers; equal chunks are segmented once."""

    def __init__(self, processor, limit: int = CACHE_WORDS):
        self.encode, self.limit, self.known = chunk_encoder(processor), limit, {}

    def of(self, texts: list[str]) -> list[bytes]:
        chunks = [marked_chunks(text) for text in texts]
        if len(self.known) > self.limit:
            self.known.clear()
        new = list({chunk for text in chunks for chunk in text if chunk not in self.known})
        self.known.update((chunk, array("i", ids).tobytes()) for chunk, ids in zip(new, self.encode(new), strict=True))
        return [b"".join(map(self.known.__getitem__, text)) for text in chunks]


class Vocabulary:
    """Token bytes and lengths by id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = pa.array(tokens, pa.binary())
        self.length = pc.binary_length(self.tokens).cast(pa.int64())


def byte_vocabulary(path: str | None) -> Vocabulary:
    ranks = byte_level_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return Vocabulary(tokens)


def piece_vocabulary(processor) -> Vocabulary:
    def piece(i: int) -> bytes:
        text = processor.id_to_piece(i)
        return bytes([int(text[3:-1], 16)]) if processor.is_byte(i) else text.replace(MARK, " ").encode()

    return Vocabulary([piece(i) for i in range(processor.get_piece_size())])


def _lists(ids: list[bytes]) -> pa.ListArray:
    edges = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _joined(ids: pa.ListArray, tokens: pa.Array, between: bytes | str) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values)), between)


def _ends(ids: pa.ListArray, vocabulary: Vocabulary, name: str) -> pa.Table:
    """(doc, end, place) of every token: running sums of the lengths, started anew in every document."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    running = pc.cumulative_sum(vocabulary.length.take(flat))
    total = pa.concat_arrays([pa.array([0], pa.int64()), running])
    before = total.take(ids.offsets[:-1])
    return pa.table({"doc": doc, "end": pc.subtract(running, before.take(doc)), name: pa.array(np.arange(len(flat)))})


class Alignment:
    """All ends, groups and links of one block of texts."""

    def __init__(self, a: pa.ListArray, b: pa.ListArray, first: Vocabulary, second: Vocabulary):
        self.a, self.b, self.docs = a, b, len(a)
        ends = _ends(a, first, "a").join(_ends(b, second, "b"), ["doc", "end"], join_type="full outer", use_threads=False)
        ends = ends.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
        common = pc.and_(pc.is_valid(ends["a"]), pc.is_valid(ends["b"]))
        closing = ends.filter(common)
        self.group_doc = np.asarray(closing["doc"])
        # the groups of either side, and the groups of every document, as list offsets
        self.a_edges, self.b_edges = (self._edges(closing[side]) for side in "ab")
        self.group_edges = pa.array(np.searchsorted(self.group_doc, np.arange(self.docs + 1)).astype(np.int32))
        # before any end lies the token that ends there or next; the last end of a document ends both sides
        self.link_doc = ends["doc"]
        self.link_a, self.link_b = (
            ids.values.take(pc.fill_null_backward(ends[side]).combine_chunks()) for ids, side in ((a, "a"), (b, "b"))
        )

    @staticmethod
    def _edges(last: pa.ChunkedArray) -> pa.Array:
        return pa.array(np.concatenate([[0], np.asarray(last) + 1]).astype(np.int32))

    def groups(self) -> pa.Array:
        sides = [pa.ListArray.from_arrays(self.a_edges, self.a.values), pa.ListArray.from_arrays(self.b_edges, self.b.values)]
        return pa.ListArray.from_arrays(self.group_edges, pa.StructArray.from_arrays(sides, fields=list(_GROUP)))

    def digests(self) -> list[str]:
        """SHA-256 of `a1,a2|b1;a3|b2,b3` per document; empty without tokens."""
        sides = [
            pc.binary_join(pa.ListArray.from_arrays(edges, ids.values.cast(pa.string())), ",")
            for edges, ids in ((self.a_edges, self.a), (self.b_edges, self.b))
        ]
        each = pc.binary_join_element_wise(*sides, "|")
        texts = pc.binary_join(pa.ListArray.from_arrays(self.group_edges, each), ";")
        return [hashlib.sha256(text.as_buffer()).hexdigest() if len(text.as_buffer() or b"") else "" for text in texts]

    def counted(self) -> tuple[pa.Table, pa.Table, pa.Array]:
        """(doc, code, times) of every pair in a document, (code, docs), and the pairs (a << 32 | b) by code."""
        key = pc.bit_wise_or(pc.shift_left(self.link_a.cast(pa.int64()), 32), self.link_b.cast(pa.int64()))
        pairs = key.dictionary_encode()
        links = pa.table({"doc": self.link_doc, "code": pairs.indices})
        held = links.group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
        held = held.rename_columns(["doc", "code", "times"]).sort_by("doc")
        docs = held.group_by("code", use_threads=False).aggregate([([], "count_all")]).rename_columns(["code", "docs"])
        return held, docs, pairs.dictionary


def _align(a_path: str | None, b_path: str | None, block_bytes: int, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces = WordIds(byte_level_encoder(a_path), CACHE_WORDS), piece_processor(b_path)
        first, second, known = byte_vocabulary(a_path), piece_vocabulary(pieces), PieceIds(pieces)
        blocks = 0
        for batch in batches:
            for part in slices(batch, "text", block_bytes):
                block = (part.column("part")[0].as_py() << 33) + blocks
                blocks += 1
                texts = part.column("text").to_pylist()
                a = _lists([token_ids(" " + text, words) if text else b"" for text in texts])
                b = _lists(known.of(texts))
                whole = pa.array([b" " + text.encode() if text else b"" for text in texts], pa.binary())
                fits = np.ones(len(texts), bool)
                for ids, side in ((a, first), (b, second)):
                    fits &= np.asarray(pc.equal(_joined(ids, side.tokens, b""), whole))
                if not fits.all():
                    kept = pa.array(fits)
                    none = pa.scalar([], a.type)
                    a, b = (pa.concat_arrays([pc.if_else(kept, ids, none)]) for ids in (a, b))
                    a, b = (pa.ListArray.from_arrays(pa.array(np.cumsum([0, *pc.list_value_length(x).to_pylist()]).astype(np.int32)), pc.list_flatten(x)) for x in (a, b))
                yield from _rows(block, part.column("doc_id"), Alignment(a, b, first, second), with_groups)

    return run


def _rows(block: int, doc_id: pa.Array, found: Alignment, with_groups: bool) -> Iterator[pa.RecordBatch]:
    """The rows of the documents of a block, then those of its distinct pairs."""
    held, docs, pairs = found.counted()
    n, edges = found.docs, np.searchsorted(np.asarray(held["doc"]), np.arange(found.docs + 1)).astype(np.int32)
    per_doc = {
        "doc_id": doc_id,
        "n_a": pc.list_value_length(found.a),
        "n_b": pc.list_value_length(found.b),
        "n_groups": pa.array(np.diff(np.asarray(found.group_edges))),
        "n_links": pa.array(np.bincount(np.asarray(found.link_doc), minlength=n)),
        "groups_sha256": pa.array(found.digests(), pa.string()),
        "codes": pa.ListArray.from_arrays(pa.array(edges), held["code"].combine_chunks().cast(pa.int32())),
        "times": pa.ListArray.from_arrays(pa.array(edges), held["times"].combine_chunks().cast(pa.int32())),
    }
    if with_groups:
        per_doc["groups"] = found.groups()
    key = pairs.take(docs["code"].combine_chunks())
    per_pair = {
        "code": docs["code"].cast(pa.int32()).combine_chunks(),
        "a": pc.shift_right(key, 32).cast(pa.int32()),
        "b": pc.bit_wise_and(key, (1 << 32) - 1).cast(pa.int32()),
        "docs": docs["docs"].combine_chunks(),
    }
    lists = {"codes": pa.list_(pa.int32()), "times": pa.list_(pa.int32()), "groups": pa.list_(_GROUP), "groups_sha256": pa.string()}
    small = dict.fromkeys(("code", "a", "b"), pa.int32())
    names = [*(field.split()[0] for field in _ROWS.split(", ")), *["groups"] * with_groups]
    for columns, rows in ((per_doc, n), (per_pair, len(key))):
        columns["block"] = pa.array(np.full(rows, block))
        kinds = {name: (lists | small).get(name, pa.int64()) for name in names}
        arrays = [columns[c].cast(kinds[c]) if c in columns else pa.nulls(rows, kinds[c]) for c in names]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _totals(with_groups: bool):
    names = [field.split()[0] for field in _SUMS.split(", ")] + ["groups_sha256"] + ["groups"] * with_groups

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, pairs: pa.Table) -> pa.Table:
        """Sums over the links of every document of a block, from the corpus-wide counts of its pairs."""
        pairs = pairs.sort_by("code").combine_chunks()
        codes, times = (docs.column(c).combine_chunks() for c in ("codes", "times"))
        code, often = pc.list_flatten(codes), pc.list_flatten(times).cast(pa.int64())
        links = pa.table({
            "doc": pc.list_parent_indices(codes),
            "sum": pc.multiply(often, pairs["n"].take(code)),
            "best": pc.multiply(often, pairs["best"].take(code).cast(pa.int64())),
        })
        summed = links.group_by("doc", use_threads=False).aggregate([("sum", "sum"), ("best", "sum")])
        out = docs.select(names)
        for name, source in (("n_best", "best_sum"), ("count_sum", "sum_sum")):
            total = np.zeros(docs.num_rows, np.int64)
            total[np.asarray(summed["doc"])] = np.asarray(summed[source])
            out = out.append_column(name, pa.array(total))
        return out

    return run


def align_tokens(
    documents: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    with_groups: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum (and groups).

    A are the ids of a blank and the text by a byte-level vocabulary, B those of the text by a
    SentencePiece vocabulary, which adds the blank itself; names of special tokens in a text are plain
    text. Byte offsets where tokens of both sides end cut them into `groups`, an array of (a, b) id
    lists; its digest is taken of `a1,a2|b1;a3|b2,b3`. A link is a token of A and one of B that share a
    byte. The count of a pair of ids is the number of documents, repeated rows included, in which it is
    linked; `count_sum` adds it up over the links and `n_best` counts those links whose pair has the
    highest count of its A id, ties included.

    Null and empty texts, and texts whose tokens do not spell them (a marker character inside),
    have no tokens: zeros and an empty digest. Only doc_id and text are read, so other columns may have any
    name. A text longer than `block_bytes` is a block of its own; a task holds one block.
    """
    docs = documents.select(
        F.spark_partition_id().cast("long").alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    extra = _GROUPS if with_groups else ""
    rows = written(docs.mapInArrow(_align(a_path, b_path, block_bytes, with_groups), _ROWS + extra), "alignments")
    pairs = rows.where("code is not null").select("block", "code", "a", "b", "docs")
    # an A id has at most as many partners as the vocabulary of B has ids
    counted = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    counted = counted.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))
    totals = pairs.select("block", "code", "a", "b").join(counted.hint("merge"), ["a", "b"]).select("block", "code", "n", "best")
    columns = [c for c in rows.columns if c not in ("block", "code", "a", "b", "docs")]
    texts = rows.where("code is null").select(F.col("block").alias("of"), *columns)
    result = f"{_SUMS}, groups_sha256 string{extra}, n_best long, count_sum long"
    return texts.groupBy("of").cogroup(totals.groupBy("block")).applyInArrow(_totals(with_groups), result)
