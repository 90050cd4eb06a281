"""Secrets in texts: known shapes, and random strings that a tokenizer compresses badly."""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import LOWER, byte_class, slices, text_bytes

#: Kinds in the order in which spans with one start are listed; the method's own kind is last.
KINDS = ("assign", "access", "hex", "random")
#: A run of at least MIN_RUN characters is random with fewer than MAX_RATIO characters a token.
MIN_RUN = 20
MAX_RATIO = 2.0
PLACEHOLDER = "[SECRET]"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
# what is long and hard to compress without being a secret; of names, the tokenizer knows the words
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}|[0-9A-F]{128})\Z")
_IDENTIFIER = re.compile(r"(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})\Z|[0-9+/_=-]+\Z|(?:sha(?:1|256|384|512)|md5)[-=]")

# gates: which texts may hold anything at all, found on bytes
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_IN_RUN = byte_class(lambda c: c.isalnum() or c in "+/_=-") & (np.arange(256) < 128)
_IN_HEX = byte_class(lambda c: c in "0123456789abcdef") & (np.arange(256) < 128)

Span = tuple[int, int, int]  # start, number of the kind, end


def vocabulary(path: str | None) -> Callable[[str], list[int]]:
    """Encoder for a file of ranks (default: the public 50k byte-level vocabulary)."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def find_secrets(text: str, encode: Callable[[str], list[int]], min_run: int = MIN_RUN, max_ratio: float = MAX_RATIO) -> list[Span]:
    """All spans of a text, by start and then kind, in code points."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if len(m[0]) >= 32]
    known = sorted((a, b) for a, _, b in spans)
    starts, reach = [a for a, _ in known], list(accumulate((b for _, b in known), max))
    for m in _RUN.finditer(text):
        run = m[0]
        if len(run) < min_run or _DIGEST.match(run) or _IDENTIFIER.match(run):
            continue
        earlier = bisect_left(starts, m.end())
        if earlier and reach[earlier - 1] > m.start():
            continue  # a known span begins before its end and ends after its start
        if len(run) < max_ratio * len(encode(run)):
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _suspects(column: pa.Array, min_run: int) -> np.ndarray:
    """Which texts have a keyword, a long hexadecimal run, or a long run: no other text has a span."""
    data, at = text_bytes(column)
    lower = LOWER[data].tobytes()
    places = []
    for word in (*_KEYWORDS, b"akia"):
        i = lower.find(word)
        while i >= 0:
            places.append(i)
            i = lower.find(word, i + 1)
    for member, least in ((_IN_HEX, 32), (_IN_RUN, min_run)):
        inside = np.concatenate([[0], member[data].view(np.int8), [0]])
        edge = np.flatnonzero(np.diff(inside))
        start, end = edge[::2], edge[1::2]
        keep = end - start >= least
        places += start[keep].tolist()
        # a run may begin in one text and go on in the next
        inner = at[1:-1]
        over = np.searchsorted(start[keep], inner, "right") - 1
        across = (over >= 0) & (inner < end[keep][np.maximum(over, 0)]) if keep.any() else np.zeros(len(inner), bool)
        places += inner[across].tolist()
    out = np.zeros(len(column), bool)
    # a place belongs to the last text that begins at or before it
    out[np.searchsorted(at[:-1], np.array(places, np.int64), "right") - 1] = True
    return out if places else np.zeros(len(column), bool)


def _scan(path: str | None, min_run: int, max_ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column("text")
                counts = np.zeros((part.num_rows, len(KINDS)), np.int64)
                digest, spans = [nothing] * part.num_rows, [""] * part.num_rows
                for i in np.flatnonzero(_suspects(column, min_run)):
                    encode = encode or vocabulary(path)
                    found = find_secrets(column[int(i)].as_py(), encode, min_run, max_ratio)
                    for _, kind, _ in found:
                        counts[i, kind] += 1
                    digest[i] = hashlib.sha256(listed([s for s in found if s[1] < 3]).encode()).hexdigest()
                    spans[i] = listed(found)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, counts.T), pa.array(digest), pa.array(spans)], _NAMES)

    return run


_NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(documents: DataFrame, path: str | None = None, min_run: int = MIN_RUN, max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per document: doc_id, the number of spans of each kind, base_sha256, spans.

    Beside the known shapes, a long run of letters, digits and + / _ = - counts as random when the
    vocabulary needs a token for fewer than `max_ratio` of its characters, unless
    it is a digest of a usual length, a UUID, or a number, or overlaps a known shape. Names of known words need fewer
    tokens. Rows are scanned where they are read. Null and empty texts have no
    span; repeated rows are repeated results; spans with one start are listed by kind. Very long texts are scanned
    whole, in time proportional to their length and the logarithm of their spans. Other columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = docs.mapInArrow(
        _scan(path, min_run, max_ratio), "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    )
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def redact(documents: DataFrame, path: str | None = None, min_run: int = MIN_RUN, max_ratio: float = MAX_RATIO) -> DataFrame:
    """The documents with every span replaced by a placeholder, and n_chars counted anew.

    Overlapping spans become one placeholder. Null texts stay null; other columns are untouched.
    """
    docs = documents.withColumn("text", F.col("text").cast("string"))
    docs = docs.withColumn("n_chars", F.col("n_chars").cast("long")) if "n_chars" in docs.columns else docs
    return docs.mapInArrow(_clean(path, min_run, max_ratio), docs.schema)


def _clean(path: str | None, min_run: int, max_ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            names = batch.schema.names
            for part in slices(batch, "text"):
                column = part.column("text")
                suspects = np.flatnonzero(_suspects(column, min_run))
                if len(suspects):
                    encode = encode or vocabulary(path)
                    texts = column.to_pylist()
                    for i in suspects:
                        texts[i] = texts[i] and _replace(texts[i], find_secrets(texts[i], encode, min_run, max_ratio))
                    column = pa.array(texts, column.type)
                columns = dict(zip(names, part.columns, strict=True)) | {"text": column}
                if "n_chars" in columns:
                    columns["n_chars"] = pc.utf8_length(column).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    return run


def _replace(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for start, _, end in spans:
        if start >= done:
            parts += [text[done:start], PLACEHOLDER]
        done = max(done, end)
    return "".join([*parts, text[done:]])
