"""Document fingerprints from content-defined chunks."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import written
from .words import SLICE_BYTES, range_hash

#: Bytes of a chunk: at least, the size around which the boundary rule eases, at most.
LEAST, NORMAL, MOST = 32, 96, 384
#: Bits of the gear hash that must be zero before and after the normal size.
HARD_BITS, EASY_BITS = 8, 5
_GEAR = np.random.default_rng(0x6EA2).integers(0, 1 << 16, 256, dtype=np.uint16)


def chunk_ends(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk boundaries of texts that lie one after another: ends of all chunks, and their texts.

    The gear hash of 16 bytes is computed for all positions at once by doubling the number
    of bytes it covers. A boundary needs HARD_BITS zero bits before the normal size and
    EASY_BITS after it, so sizes stay close to normal; it depends on nothing but
    the bytes before it, so chunks reappear after an insertion. No boundary is taken in the
    first LEAST bytes of a chunk, so the hash never sees the text before.
    """
    gear = _GEAR[data]
    for shift in (1, 2, 4, 8):
        wider = gear.copy()
        wider[shift:] += gear[:-shift] << np.uint16(shift)
        gear = wider
    hard = (np.flatnonzero((gear >> np.uint16(16 - HARD_BITS)) == 0) + 1).tolist()
    easy = (np.flatnonzero((gear >> np.uint16(16 - EASY_BITS)) == 0) + 1).tolist()
    ends, owner = [], []
    h = e = 0
    for text, (start, stop) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        while stop - start > LEAST:
            h = bisect_left(hard, start + LEAST, h)
            if h < len(hard) and hard[h] <= min(start + NORMAL, stop):
                start = hard[h]
            else:
                e = bisect_left(easy, start + NORMAL, e)
                start = min(easy[e] if e < len(easy) else stop, start + MOST, stop)
            ends.append(start)
            owner.append(text)
        if start < stop:
            ends.append(stop)
            owner.append(text)
    return np.array(ends, np.int64), np.array(owner, np.int64)


def fingerprints(texts: list[str]) -> list[dict[str, int]]:
    """Of each text: the lengths of its distinct chunks by their digests."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends, owner = chunk_ends(data, at)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    digests = (range_hash(data, starts, ends) >> np.uint64(16)).tolist()
    out: list[dict[str, int]] = [{} for _ in texts]
    for text, digest, length in zip(owner.tolist(), digests, (ends - starts).tolist(), strict=True):
        out[text][f"{digest:012x}"] = length
    return out


def written_out(chunks: dict[str, int]) -> str:
    return ",".join(f"{digest}:{chunks[digest]}" for digest in sorted(chunks))


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Bytes in shared chunks, as a share of the smaller fingerprint; 1 for two empty ones."""
    least = min(sum(a.values()), sum(b.values()))
    if least == 0:
        return 1.0 if a == b else 0.0
    if len(a) > len(b):
        a, b = b, a
    return sum(length for digest, length in a.items() if digest in b) / least


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of a text replaced by as many first characters of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROWS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [field.split()[0] for field in _ROWS.split(", ")]


def _rows(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Result rows; following[i] is the text after texts[i]."""
    changed = [edited(t, n) for t, n in zip(texts, following, strict=True)]
    n = len(texts)
    # texts[i + 1] usually is following[i]: its fingerprint is made once
    chain = all(following[i] is texts[i + 1] for i in range(n - 1))
    tail = following[-1:] if chain else following
    own = fingerprints([*texts, *changed, *tail])
    mine, other = own[:n], own[n : 2 * n]
    after = [*mine[1:], own[-1]] if chain else own[2 * n :]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode("utf-8", "replace")).hexdigest() for c in changed]),
            pa.array(map(written_out, mine)),
            pa.array(map(written_out, other)),
            pa.array([containment(a, b) for a, b in zip(mine, other, strict=True)], pa.float64()),
            pa.array([containment(a, b) for a, b in zip(mine, after, strict=True)], pa.float64()),
        ],
        _NAMES,
    )


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition but its last, whose next text is at hand; then the partition's end: its first text and last row."""
    ids: list = []
    texts: list[str] = []
    size = 0
    part = head = None
    for batch in batches:
        for doc, text, number in zip(batch.column("doc_id"), batch.column("text"), batch.column("part"), strict=True):
            ids.append(doc.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if part is None:
                part, head = number.as_py(), texts[0]
            if size > SLICE_BYTES and len(ids) > 1:
                yield _with_end(_rows(ids[:-1], texts[:-1], texts[1:]))
                ids, texts = ids[-1:], texts[-1:]
                size = len(texts[0])
    if len(ids) > 1:
        yield _with_end(_rows(ids[:-1], texts[:-1], texts[1:]))
    if ids:
        yield pa.RecordBatch.from_pylist([{"part": part, "head": head, "doc_id": ids[-1], "text": texts[-1]}], _RANGED_SCHEMA)


def _with_end(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Result rows with the (empty) columns of a range's end."""
    nothing = [pa.nulls(rows.num_rows, field.type) for field in _END_FIELDS]
    return pa.RecordBatch.from_arrays([*rows.columns, *nothing], schema=_RANGED_SCHEMA)


_END_FIELDS = [pa.field("part", pa.int32()), pa.field("head", pa.string()), pa.field("text", pa.string())]
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
_RANGED_SCHEMA = pa.schema([*(pa.field(n, _TYPES[t]) for n, t in (field.split() for field in _ROWS.split(", "))), *_END_FIELDS])


def _outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _rows([row["doc_id"]], [row["text"]], [row["following"]])


def chunk_fingerprints(documents: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A fingerprint is the sorted set of a text's chunk digests with the chunks' lengths;
    `near_*` is the containment of the smaller set, weighted by length. The next document
    is the one with the next smaller doc_id; the last is followed by the first. Equal
    doc_ids are ordered by text; a null doc_id comes last.

    Texts are shuffled once, into `partitions` ranges of doc_id (default: the session's
    shuffle partitions); neighbours meet inside a range, and only one row per range
    waits for the first text of the next one. Rows and ends of the ranges are written once. Null texts are empty; an empty text
    has the empty fingerprint, like only another empty one.
    """
    spark = documents.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = docs.withColumns({"tie": order[1], "row": order[2]})
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("row")]
    ranges = keyed.repartitionByRange(count, *order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))
    # ranges are cut by a sample that differs from run to run, so rows and ends must come from one run
    ranged = written(ranges.mapInArrow(_ranged, _ROWS + ", part int, head string, text string"), "ranges", "zstd")
    inner = ranged.where("part is null").select(*_NAMES)
    ends = ranged.where("part is not null").select("part", "head", "doc_id", "text")
    # which range comes after which: the numbers of the ranges that have rows are sorted alone, texts are joined to them
    in_order = Window.orderBy("part")
    first = F.first("part").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = ends.select("part").withColumn("next", F.coalesce(F.lead("part").over(in_order), first))
    heads = ends.select(F.col("part").alias("next"), F.col("head").alias("following"))
    outer = ends.select("part", "doc_id", "text").join(after, "part").join(heads, "next")
    outer = outer.select("doc_id", "text", "following").mapInArrow(_outer, _ROWS)
    return inner.unionByName(outer)
