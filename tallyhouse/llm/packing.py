"""Packing tokenized documents into training sequences under several limits at once."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 2048
MAX_SEGMENTS = 64
END_ID = 1
#: Examples that wait for a place at once, in each task.
WAITING = 256
#: Words whose ids are remembered in each task.
CACHE_WORDS = 1 << 18

# A blank between two other white-space characters (or the end) is not a safe place to
# split a text before tokenizing; every other blank is.
_UNSAFE = re.compile(r"\s (?=\s|\Z)|^ (?=\s|\Z)")


class WordIds(dict):
    """The ids, as little-endian unsigned 32-bit integers, of a blank and the word that follows it."""

    def __init__(self, encode: Callable[[str], list[int]], limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids


def byte_level_ranks(path: str | None) -> dict[bytes, int]:
    """The ids of a byte-level vocabulary in the JSON format of `tokenizers`, by the bytes of their tokens."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        data = json.load(file)
    special = {token["content"] for token in data.get("added_tokens", [])}
    # printable bytes stand for themselves, the others for characters from 256 on, in order
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    return {bytes(byte[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in special}


def byte_level_encoder(path: str | None) -> Callable[[str], list[int]]:
    """Encoder for such a vocabulary.

    The ids equal those of that library (the tests compare them); the ranks of this kind of
    vocabulary are its ids, so the merges can be run by the faster tiktoken.
    """
    import public_tokenizers
    import tiktoken

    ranks = byte_level_ranks(path)
    return tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def token_ids(text: str, known: WordIds) -> bytes:
    """Ids of a text as bytes; equal words after a blank are encoded once."""
    if _UNSAFE.search(text):
        return array("I", known.encode(text)).tobytes()
    first, *rest = text.split(" ")
    return b"".join([array("I", known.encode(first)).tobytes(), *map(known.__getitem__, rest)])


class Packer:
    """Fills one sequence at a time from a bounded set of waiting examples.

    An example's demand is the vector (tokens, one segment, loss-bearing tokens), each as
    a share of its limit. Of the examples that fit, the one with the largest dot product
    of demand and remaining room is placed. When none fits, the longest is cut to fill the
    rest. A sequence that stays short, because its segments or its loss-bearing tokens run out or because
    a task ends, is cut back to a power of two, and what was cut off waits again.
    """

    def __init__(self, tokens: int, segments: int, loss: int, waiting: int, emit: Callable):
        self.limit = np.array([tokens, segments, loss], float)
        self.most, self.emit = waiting, emit
        self.owner: list = []
        self.rows = np.zeros((waiting + 1, 3), np.int64)  # begin, end, first token that bears loss
        self.sequence = 0

    def add(self, owner, n: int, loss_start: int) -> None:
        begin, (tokens, _, loss) = 0, self.limit.astype(int)
        while n - begin >= tokens and n - max(begin, loss_start) >= 0 and self._loss(begin, begin + tokens, loss_start) <= loss:
            self.emit(owner, begin, tokens, self.sequence, 0)
            self.sequence, begin = self.sequence + 1, begin + tokens
        if begin < n:
            self.rows[len(self.owner)] = begin, n, loss_start
            self.owner.append(owner)
            if len(self.owner) > self.most:
                self.fill()

    @staticmethod
    def _loss(begin, end, loss_start):
        return np.maximum(end - np.maximum(begin, loss_start), 0)

    def _place(self, i: int, length: int, used: np.ndarray, placed: list) -> None:
        begin, end, loss_start = (int(x) for x in self.rows[i])
        placed.append((self.owner[i], begin, length, loss_start))
        used += (length, 1, int(self._loss(begin, begin + length, loss_start)))
        if begin + length < end:
            self.rows[i, 0] += length
        else:
            last = len(self.owner) - 1
            self.rows[i], self.owner[i] = self.rows[last], self.owner[last]
            self.owner.pop()

    def _wait(self, owner, begin: int, end: int, loss_start: int) -> None:
        """A part waits (again), as one with what of its example waits already."""
        for i, other in enumerate(self.owner):
            if other is owner and int(self.rows[i, 0]) == end:
                self.rows[i, 0] = begin
                return
        self.rows[len(self.owner)] = begin, end, loss_start
        self.owner.append(owner)

    def _emit(self, placed: list, total: int) -> None:
        """The pieces of a sequence, cut back to a power of two if it is not full."""
        keep = total if total == self.limit[0] else 1 << (total.bit_length() - 1)
        while total > keep:
            owner, begin, length, loss_start = placed.pop()
            rest = max(length - (total - keep), 0)
            self._wait(owner, begin + rest, begin + length, loss_start)
            if rest:
                placed.append((owner, begin, rest, loss_start))
            total -= length - rest
        offset = 0
        for owner, begin, length, _ in placed:
            self.emit(owner, begin, length, self.sequence, offset)
            offset += length
        self.sequence += 1

    def fill(self) -> None:
        """One sequence."""
        used = np.zeros(3, np.int64)
        placed: list = []
        while self.owner and used[0] < self.limit[0] and used[1] < self.limit[1]:
            rows = self.rows[: len(self.owner)]
            begin, end, loss_start = rows.T
            need = np.stack([end - begin, np.ones(len(rows), np.int64), self._loss(begin, end, loss_start)], 1)
            room = self.limit - used
            last_segment = room[1] == 1 and len(rows) > 1
            fits = (need <= room).all(1) & (~last_segment | (need[:, 0] == room[0]))
            if fits.any():
                score = np.where(fits, (need / self.limit) @ (room / self.limit), -1.0)
                i = int(score.argmax())
                self._place(i, int(need[i, 0]), used, placed)
                continue
            # cut the longest possible piece: as many tokens as tokens and loss allow
            free = np.maximum(loss_start - begin, 0)
            length = np.minimum(np.minimum(need[:, 0], room[0]), free + room[2]).astype(np.int64)
            i = int(length.argmax())
            if length[i] <= 0:
                break
            self._place(i, int(length[i]), used, placed)
        self._emit(placed, int(used[0]))

    def finish(self) -> None:
        tokens = int(self.limit[0])
        while (left := int((self.rows[: len(self.owner), 1] - self.rows[: len(self.owner), 0]).sum())) > 0:
            if left < tokens:
                self.limit[0] = 1 << (left.bit_length() - 1)
            self.fill()
        self.limit[0] = tokens


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(path: str | None, limits: tuple[int, int, int], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(byte_level_encoder(path), CACHE_WORDS)
        names = [field.split()[0] for field in _PIECES.split(", ")] + ["ids"] * with_ids
        out: list[list] = [[] for _ in names]
        base = 0
        end = array("I", [END_ID]).tobytes()

        def emit(owner, begin, length, sequence, offset):
            doc, ids = owner
            piece = ids[4 * begin : 4 * (begin + length)]
            row = (doc, begin, length, zlib.crc32(piece), len(ids) // 4, base + sequence, offset)
            for column, value in zip(out, (*row, np.frombuffer(piece, np.uint32).astype(np.int32)), strict=False):
                column.append(value)

        def batch_of():
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
            for column in out:
                column.clear()
            return done

        packer = Packer(*limits, WAITING, emit)
        for batch in batches:
            base = batch.column("part")[0].as_py() << 33 if batch.num_rows else base
            for doc, text, loss in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("loss_start").to_pylist(), strict=True):
                ids = memoryview(token_ids(text.as_py(), known) + end)
                packer.add((doc, ids), len(ids) // 4, loss)
                if len(out[0]) >= 8192:
                    yield batch_of()
        packer.finish()
        yield batch_of()

    return run


def pack_documents(
    documents: DataFrame,
    path: str | None = None,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    loss_start: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Every document is its ids and an end id; each id is in exactly one piece. A sequence
    holds at most `max_tokens` ids, `max_segments` pieces and `max_loss` loss-bearing ids. The
    column named by `loss_start` tells from which id of a document on ids bear loss (default: all).

    Every task packs the rows it reads and numbers its sequences in a range of its own, so
    nothing is shuffled; a task holds a bounded number of waiting examples. Null and empty
    texts are one end id. Sequences that stay short, at the end of a task or because very short documents use
    up all segments, are cut to powers of two, so they need no padding either. Repeated rows
    and rows without doc_id are packed each on its own; of equally good examples the one that waits at the lowest
    place is taken. A very long text fills sequences of its own and is held whole in its task. Other columns
    are not read.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(loss_start).cast("long") if loss_start else F.lit(0), F.lit(0)).cast("long").alias("loss_start"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    limits = (max_tokens, max_segments, max_loss or max_tokens)
    return docs.mapInArrow(_pack(path, limits, with_ids), _PIECES + ", ids array<int>" * with_ids)
