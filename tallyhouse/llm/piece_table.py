"""SentencePiece ids through a table of distinct chunks, and their decoding.

No piece of the vocabulary holds a white-space marker after another character, so a text
in which blanks are markers can be cut before every run of markers without changing its
pieces. A corpus repeats such marked words very often. So every block of texts is reduced to the
list of its distinct chunks, and every text to the places of its chunks in that list. The lists
are dealt out by the chunks' hashes: what blocks share meets in one bucket of the table, where each
distinct chunk is segmented once. The ids go back to the blocks as lists in the same order and
replace the places. A frequent chunk is sent once per block, not once per occurrence.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import slices

MARK = "▁"
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def piece_processor(path: str | None):
    """The processor of a vocabulary file; refuses one whose pieces a cut before a marker could change."""
    import public_tokenizers
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    crossing = next((p for p in map(processor.id_to_piece, range(processor.get_piece_size())) if MARK in p.lstrip(MARK)), None)
    if crossing is not None:
        raise ValueError(f"a piece crosses a white-space marker: {crossing!r}")
    if processor.decode(processor.encode(" a  Ａ ")) != " a  Ａ ":
        raise ValueError("the vocabulary's normaliser changes texts, so chunks cannot be encoded apart")
    return processor


def marked_chunks(text: str) -> list[str]:
    """A text as the chunks that are segmented apart: runs of markers with what follows them."""
    return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


def chunk_encoder(processor) -> Callable[[list[str]], list[list[int]]]:
    """Ids of chunks that each begin with a marker, which the library itself puts before a text."""
    alone = [processor.piece_to_id(MARK)]

    def encode(chunks: list[str]) -> list[list[int]]:
        ids = processor.encode([chunk[1:].replace(MARK, " ") for chunk in chunks], num_threads=1)
        return [alone if chunk == MARK else found for chunk, found in zip(chunks, ids, strict=True)]

    return encode


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes each, byte by byte, so that equal high bytes lie together."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    return np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T.copy().view(f"<u{width}")[:, 0]


class _Block:
    """The distinct chunks of some texts by bucket, and the places of each text's chunks among them.

    Places count chunks as they first occur, so that frequent ones have small numbers; `bucket` has
    their buckets in that order.
    """

    def __init__(self, part: pa.RecordBatch, number: int, buckets: int):
        self.id = (part.column("part")[0].as_py() << 33) + number
        known: dict[str, int] = {}
        self.places = [
            packed(np.array([known.setdefault(c, len(known)) for c in marked_chunks(text.as_py())], np.uint64)) for text in part.column("text")
        ]
        chunks = [chunk.encode() for chunk in known]
        self.bucket = np.array([zlib.crc32(chunk) % buckets for chunk in chunks], np.uint64)
        order = np.argsort(self.bucket, kind="stable")
        self.chunks = [chunks[i] for i in order]
        self.buckets, self.begin = np.unique(self.bucket[order].astype(np.int64), return_index=True)
        self.digest = zlib.crc32(b"\x00".join(self.chunks))


def _read(block_bytes: int, buckets: int, rows_of: Callable, names: list[str], kinds: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = 0
        for batch in batches:
            for part in slices(batch, "text", block_bytes):
                columns = rows_of(_Block(part, blocks, buckets), part)
                blocks += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


_LISTS = "bucket long, block long, digest long, sizes binary, chunks binary"
_TEXTS = "of long, seen long, doc_id long, places binary, bucket binary"
_IDS = "block long, digest long, bucket long, sizes binary, ids binary"
_BINARY_LISTS = [pa.int64()] * 3 + [pa.binary()] * 2


def _list_rows(block: _Block, part: pa.RecordBatch):
    edges = [*block.begin.tolist(), len(block.chunks)]
    lists = [block.chunks[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    n = len(lists)
    sizes = [packed(np.array([len(c) for c in chunks], np.uint64)) for chunks in lists]
    return block.buckets, [block.id] * n, [block.digest] * n, sizes, [b"".join(chunks) for chunks in lists]


def _text_rows(block: _Block, part: pa.RecordBatch):
    n = part.num_rows
    once = [packed(block.bucket)] + [None] * (n - 1)
    return [block.id] * n, [block.digest] * n, part.column("doc_id").to_pylist(), block.places, once


def _segment(path: str | None):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """The ids of all lists of one bucket; a chunk that several blocks hold is segmented once."""
        known: dict[bytes, int] = {}
        lists = []
        for sizes, chunks in zip(rows.column("sizes").to_pylist(), rows.column("chunks").to_pylist(), strict=True):
            end = np.cumsum(unpacked(sizes).astype(np.int64)).tolist()
            lists.append([known.setdefault(chunks[a:b], len(known)) for a, b in zip([0, *end], end, strict=False)])
        found = chunk_encoder(piece_processor(path))([chunk.decode() for chunk in known])
        size = np.array([len(ids) for ids in found], np.int64)
        flat, end = np.array([i for ids in found for i in ids], np.uint64), np.cumsum(size)
        out = rows.select(["block", "digest", "bucket"])
        out = out.append_column("sizes", pa.array([packed(size[codes].astype(np.uint64)) for codes in lists], pa.binary()))
        return out.append_column("ids", pa.array([packed(_taken(flat, size, end, np.array(codes))) for codes in lists], pa.binary()))

    return run


def _taken(flat: np.ndarray, size: np.ndarray, end: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs of `flat` with the given numbers, one after the other."""
    count = size[codes]
    stop = np.cumsum(count)
    return flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(end[codes] - stop, count)]


def _put_back(path: str | None, with_text: bool):
    def run(key: tuple[pa.Scalar, ...], texts: pa.Table, lists: pa.Table) -> pa.Table:
        """The ids of the texts of one block, and the texts they decode to."""
        lists = lists.sort_by("bucket")
        if set(texts.column("seen").to_pylist()) | set(lists.column("digest").to_pylist()) > {texts.column("seen")[0].as_py()}:
            raise ValueError("the documents changed between two reads; write them to a table first")
        bucket = unpacked(next(b for b in texts.column("bucket").to_pylist() if b is not None))
        order = np.argsort(bucket, kind="stable")
        size, end = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        size[order] = np.concatenate([np.zeros(0, np.int64), *(unpacked(x).astype(np.int64) for x in lists.column("sizes").to_pylist())])
        end[order] = np.cumsum(size[order])
        flat = np.concatenate([np.zeros(0, np.int32), *(unpacked(x).astype(np.int32) for x in lists.column("ids").to_pylist())])
        ids = [_taken(flat, size, end, unpacked(p).astype(np.int64)) for p in texts.column("places").to_pylist()]
        edges = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
        values = pa.array(np.concatenate(ids) if ids else flat, pa.int32())
        out = pa.table({"doc_id": texts.column("doc_id"), "ids": pa.ListArray.from_arrays(edges, values)})
        if with_text:
            decode = piece_processor(path).decode
            out = out.append_column("text", pa.array([decode(x.tolist()) for x in ids], pa.string()))
        return out

    return run


def encode_documents(
    documents: DataFrame,
    path: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, ids (array of int), exactly what the library's `encode` returns.

    With `with_text` also the text that its `decode` makes of the ids, in the same pass.

    Null and empty texts have no ids. The marker character itself is read as a blank, as the
    library does. Repeated rows are encoded each on its own; other columns are not read, so their
    names may clash with nothing. A text longer than `block_bytes` is a block of its own, and a text
    without blanks one chunk. An empty table gives an empty one.

    The documents are read three times (their size, the lists, the places), so they must be the same rows
    in the same order each time, as a table in files is; the blocks' digests are compared, and a change
    raises an error. The number of buckets grows with the text: `bucket_bytes` of text make one.
    """
    docs = documents.select(
        F.spark_partition_id().cast("long").alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    read = partial(_read, block_bytes, buckets)
    lists = docs.mapInArrow(read(_list_rows, [c.split()[0] for c in _LISTS.split(", ")], _BINARY_LISTS), _LISTS)
    texts = docs.mapInArrow(read(_text_rows, [c.split()[0] for c in _TEXTS.split(", ")], [*[pa.int64()] * 3, *[pa.binary()] * 2]), _TEXTS)
    ids = lists.groupBy("bucket").applyInArrow(_segment(path), _IDS)
    result = "doc_id long, ids array<int>" + ", text string" * with_text
    return texts.groupBy("of").cogroup(ids.groupBy("block")).applyInArrow(_put_back(path, with_text), result)


def _decode(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = piece_processor(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column("ids")
                edges = np.cumsum([0, *ids.value_lengths().to_pylist()]).tolist()
                flat = np.asarray(ids.flatten()).tolist()
                texts = [processor.decode(flat[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return run


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): the library's `decode` of every row's ids; null ids are none and give an empty text."""
    ids = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.expr("array()")).cast("array<int>").alias("ids"))
    return ids.mapInArrow(_decode(path), "doc_id long, ids array<int>, text string")
