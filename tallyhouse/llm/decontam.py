"""Benchmark passages in training documents, by suffix arrays over shards of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import LETTER_DIGIT, Words, slices, words

WINDOW = 10
#: Text of one block of benchmark items sent to the executors at once, in bytes.
BLOCK_BYTES = 16 << 20
#: Text of one shard of documents with its own suffix array, in bytes.
SHARD_BYTES = 4 << 20


class Suffixes:
    """A suffix array over numbered words; only suffixes that begin with a known word are kept.

    `codes` holds 0 for words that no test item has: such a suffix can match nothing, and
    a match never runs across one. Texts are separated by a code that never matches.
    """

    def __init__(self, codes: np.ndarray, depth: int):
        self.codes, self.depth = codes, depth
        rank = codes.astype(np.int64)
        at = np.flatnonzero(rank)
        width = 1
        while width < depth:  # prefix doubling: ranks by the first 2, 4, 8 ... words
            later = np.zeros(len(at), np.int64)
            inside = at + width < len(rank)
            later[inside] = rank[at[inside] + width]
            pair = (rank[at] << np.int64(32)) | later
            order = np.argsort(pair, kind="stable")
            step = np.ones(len(at), np.int64)
            step[1:] = pair[order][1:] != pair[order][:-1]
            rank = np.zeros_like(rank)
            rank[at[order]] = np.cumsum(step)
            width *= 2
        self.order = at[np.argsort(rank[at], kind="stable")]

    def _words(self, suffix: np.ndarray, offset: int) -> np.ndarray:
        at = self.order[suffix] + offset
        return np.where(at < len(self.codes), self.codes[np.minimum(at, len(self.codes) - 1)], 0)

    def search(self, code: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each pattern, `lengths` words of `code` from `start` on: the interval of suffixes that share its longest
        prefix, and that length.

        All patterns are narrowed together, one word deeper at a time, each by two binary searches.
        """
        low, high = np.zeros(len(start), np.int64), np.full(len(start), len(self.order), np.int64)
        length, live = np.zeros(len(start), np.int64), np.arange(len(start))
        for offset in range(int(lengths.max(initial=0)) if len(self.order) else 0):
            live = live[lengths[live] > offset]
            if not len(live):
                break
            word = code[start[live] + offset]
            a = self._bisect(low[live], high[live], word, offset, False)
            b = self._bisect(low[live], high[live], word, offset, True)
            found = a < b
            live = live[found]
            low[live], high[live], length[live] = a[found], b[found], offset + 1
        return low, high, length

    def _bisect(self, low: np.ndarray, high: np.ndarray, word: np.ndarray, offset: int, after: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            here = self._words(np.minimum(middle, len(self.order) - 1), offset)
            right = open_ & ((here <= word) if after else (here < word))
            low, high = np.where(right, middle + 1, low), np.where(open_ & ~right, middle, high)
        return low


class Items:
    """The windows of one block of test items, ready to be looked up."""

    def __init__(self, ids: list, column: pa.Array, window: int):
        w = words(column, LETTER_DIGIT)
        self.window, count = window, np.diff(w.first)
        self.vocabulary = np.unique(w.hash)
        self.code = (np.searchsorted(self.vocabulary, w.hash) + 1).astype(np.int32)
        starts, owners, sizes = [], [], []
        for i, n in enumerate(count):
            size = min(n, window)
            if n:
                at = np.arange(w.first[i], w.first[i + 1] - size + 1)
                starts.append(at), owners.append(np.full(len(at), i)), sizes.append(np.full(len(at), size))
        empty = [np.zeros(0, np.int64)]
        # a window is a place in the items' words, not a copy of them
        self.start, self.owner, self.size = (np.concatenate(x or empty).astype(np.int32) for x in (starts, owners, sizes))
        self.first = w.first.astype(np.int32)
        self.ids = ids

    def codes(self, w: Words) -> np.ndarray:
        """Word numbers of documents, with a zero after every document."""
        at = np.minimum(np.searchsorted(self.vocabulary, w.hash), max(len(self.vocabulary) - 1, 0))
        known = self.vocabulary[at] == w.hash if len(self.vocabulary) else np.zeros(len(w.hash), bool)
        out = np.zeros(len(w.hash) + len(w.first) - 1, np.int32)
        text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
        out[np.arange(len(w.hash)) + text] = np.where(known, at + 1, 0)
        return out


def _find(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                n_words, edges, found, matches = _shard(items, part.column("text"))
                columns = [part.column("row"), part.column("doc_id"), n_words, edges, found, matches]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "edges", "items", "matches"])

    return run


def _keep(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                _, _, found, _ = _shard(items, part.column("text"))
                yield part.filter(pc.equal(pc.list_value_length(found), 0))

    return run


_MATCH = pa.struct([("item", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _shard(items: Items, column: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Of each document: its words, the edges of its hit ranges, the items found in it, its longest matches with items."""
    n = len(column)
    w = words(column, LETTER_DIGIT)
    n_words = np.diff(w.first)
    begin = w.first[:-1] + np.arange(n)  # of each document among the codes
    array = Suffixes(items.codes(w), items.window)
    low, high, length = array.search(items.code, items.start, items.size)
    whole = np.flatnonzero((length == items.size) & (length > 0))
    spread = high[whole] - low[whole]
    which = np.repeat(whole, spread)
    at = array.order[np.arange(len(which)) - np.repeat(np.cumsum(spread) - spread, spread) + np.repeat(low[whole], spread)]
    text = np.searchsorted(begin, at, "right") - 1
    # hit words: a running sum over the beginnings and ends of all occurrences
    change = np.zeros(len(array.codes) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + items.size[which], -1)
    hit = np.cumsum(change)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    span_text = np.searchsorted(begin, edge[::2], "right") - 1
    span = np.stack([edge[::2] - begin[span_text], edge[1::2] - begin[span_text]], 1).reshape(-1)
    pair = np.unique(text * max(len(items.ids), 1) + items.owner[which])
    pair_text, pair_item = pair // max(len(items.ids), 1), pair % max(len(items.ids), 1)
    names = pa.array(items.ids, pa.string())

    def lists(owner, values, each):
        return pa.ListArray.from_arrays(pa.array((np.searchsorted(owner, np.arange(n + 1)) * each).astype(np.int32)), values)

    found = lists(pair_text, names.take(pa.array(pair_item, pa.int64())), 1)
    # windows that follow each other in the document and in the item are one match
    item = items.owner[which].astype(np.int64)
    place = items.start[which].astype(np.int64) - items.first[item]
    order = np.lexsort((at, at - place, item, text))
    at, text, item, place, size = at[order], text[order], item[order], place[order], items.size[which][order]
    goes_on = np.zeros(len(at), bool)
    goes_on[1:] = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (at[1:] == at[:-1] + 1) & (place[1:] == place[:-1] + 1)
    opens, closes = np.flatnonzero(~goes_on), np.flatnonzero(~np.concatenate([goes_on[1:], np.zeros(min(len(at), 1), bool)]))
    owner = text[opens]
    columns = [names.take(pa.array(item[opens])), place[opens], at[opens] - begin[owner], at[closes] + size[closes] - begin[owner]]
    matches = pa.StructArray.from_arrays([columns[0], *(pa.array(c, pa.int64()) for c in columns[1:])], fields=list(_MATCH))
    return pa.array(n_words, pa.int64()), lists(span_text, pa.array(span, pa.int64()), 2), found, lists(owner, matches, 1)


_FOUND = (
    "row long, doc_id long, n_words long, edges array<long>, items array<string>, "
    "matches array<struct<item: string, item_start: bigint, start: bigint, end: bigint>>"
)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, edges, matches.

    A window is `window` consecutive words of an item, or a whole item that has fewer; a
    document word inside any occurrence of a window is hit. `edges` has the hit ranges
    (begin, end, begin, end ... in words). `matches` has every longest verbatim match with an item, of `window`
    words or more or a whole item: the item, its first word there, and the range in the document.

    Documents stay where they are read: every task builds suffix arrays over shards of its
    own rows and looks up all windows of a block of items. A block is bounded by
    `block_bytes`; larger benchmarks take more passes, whose ranges are then united
    per document. Null texts have no words; null items and items without words
    have no window; item_ids count once however often they are repeated. Repeated rows and rows without
    doc_id have a result each; a very long text is a shard of its own; other columns are not read.
    """
    docs = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found, blocks = None, 0
    for items in _blocks(benchmark, window, block_bytes):
        here = docs.mapInArrow(_find(items), _FOUND)
        found, blocks = here if found is None else found.unionByName(here), blocks + 1
    if blocks > 1:
        found = found.groupBy("row", "doc_id", "n_words").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("edges", "items", "matches")))
        found = found.withColumn("edges", F.expr(_UNITE))
    found = found.withColumn("items", F.array_sort(F.array_distinct("items")))
    hit = F.expr("aggregate(transform(edges, (e, i) -> if(i % 2 = 0, -e, e)), 0L, (total, x) -> total + x)")
    found = found.withColumn("n_hit", hit)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items", "edges", F.array_sort("matches").alias("matches"),
    )


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Items]:
    """The windows of all items, in blocks of about `block_bytes` of text; one block at least."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toPandas()
        yield Items(mine["item_id"].tolist(), pa.array(mine["text"], pa.string()), window)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without any window of an item, all columns as they are; nothing is shuffled."""
    docs = documents.withColumn("text", F.col("text").cast("string"))
    for items in _blocks(benchmark, window, block_bytes):
        docs = docs.mapInArrow(_keep(items), docs.schema)
    return docs


#: Unites overlapping ranges given as begin, end, begin, end ...
_UNITE = """
aggregate(
  array_sort(transform(filter(sequence(1, size(edges) + 1, 2), i -> i < size(edges)), i -> struct(element_at(edges, i) as b, element_at(edges, i + 1) as e))),
  cast(array() as array<bigint>),
  (done, r) -> case
    when size(done) > 0 and r.b <= element_at(done, -1) then
      concat(slice(done, 1, size(done) - 1), array(greatest(element_at(done, -1), r.e)))
    else concat(done, array(r.b, r.e)) end)
"""
