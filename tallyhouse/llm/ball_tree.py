"""Ranked lexical search: exact inner products of sparse vectors, searched through ball trees.

A document is a vector of integer term values, an item the vector that is one at its terms, and a
score their inner product. Spark counts the corpus (documents, terms, documents per term) from
one tokenized table. Then every task builds ball trees over the vectors it reads: a node has a
centroid and a radius around it. By Cauchy and Schwarz no document in a node scores above
<item, centroid> + |item| * radius, where only the item's terms that occur in the node count, and
coordinates are scaled by the root of a term's weight, which leaves inner products as they are and the
balls smaller. A second radius per term, the most by which a document exceeds the centroid
there, bounds the score by <item, centroid + radii>; the smaller bound holds. Nodes are opened
best bound first; a node whose bound, rounded up by more than the error of its sums, is below
the k-th best score so far is left out with all its documents, and in leaves scores are computed in
64-bit integers. Each task returns its k best documents per item, which Spark ranks.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

TOP = 10
LEAF = 32
#: Vector entries in one tree.
TREE_ENTRIES = 1 << 21
BLOCK_BYTES = 16 << 20
#: More than the relative error of a bound's float sums (below 1e-12 for a million terms).
SLACK = 1e-9
_SALTS = 64

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z lower-cased."""
    return text.encode().translate(_KEEP).split() if text else []


def _count(known: dict[bytes, int]):
    names = ["doc_id", "n", "terms", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, edges, terms, times = [], [0], [], []
            for text in batch.column("text"):
                found = terms_of(text.as_py())
                here = sorted((known[t], n) for t, n in Counter(found).items() if t in known)
                sizes.append(len(found))
                terms.extend(t for t, _ in here)
                times.extend(n for _, n in here)
                edges.append(len(terms))
            at = pa.array(edges, pa.int32())
            lists = (pa.ListArray.from_arrays(at, pa.array(values, pa.int32())) for values in (terms, times))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists], names)

    return run


class Vectors:
    """Sparse rows: document ids, and term, integer value, scaled value of every entry."""

    def __init__(self, ids: np.ndarray, edges: np.ndarray, term: np.ndarray, value: np.ndarray, scale: np.ndarray):
        self.ids, self.edges, self.term, self.value = ids, edges, term, value
        self.scaled = value * scale[term]

    def row(self, i: int) -> slice:
        return slice(self.edges[i], self.edges[i + 1])

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of some rows, and for each the position of its row among them."""
        size = self.edges[rows + 1] - self.edges[rows]
        end = np.cumsum(size)
        owner = np.repeat(np.arange(len(rows)), size)
        return np.arange(len(owner)) - (end - size)[owner] + self.edges[rows][owner], owner


class BallTree:
    """A tree over sparse rows; a leaf holds at most `leaf` rows, or more if all are equal."""

    def __init__(self, vectors: Vectors, weight: np.ndarray, leaf: int = LEAF):
        self.vectors, self.leaf = vectors, leaf
        self.weight = np.maximum(weight, 1).astype(float)
        self.work = np.zeros(len(weight))  # one dense vector, cleared after each use
        self.children: list[tuple[int, ...]] = []
        self.rows: list = []  # of leaves: row numbers, and term, value, row of their entries
        self.radius: list[float] = []
        columns: list[tuple] = []  # node, term, centre, most of all entries of all centres
        stack = [(np.arange(len(vectors.ids)), -1)]
        while stack:
            rows, parent = stack.pop()
            node = len(self.children)
            self.children.append(())
            self.rows.append(None)
            if parent >= 0:
                self.children[parent] += (node,)
            at, owner = vectors.entries(rows)
            term, value = vectors.term[at], vectors.value[at]
            terms, centre, most = self._centre(rows, term, value, vectors.scaled[at])
            far = self._distances(rows, terms, centre)
            # sums of squares cancel to within SLACK of their terms
            norm = float((centre**2).sum())
            self.radius.append(math.sqrt(float(far.max(initial=0.0)) * (1 + SLACK) + norm * SLACK))
            columns.append((np.full(len(terms), node), terms, centre * np.sqrt(self.weight[terms]), most))
            halves = self._halves(rows, far, norm)
            stack.extend((half, node) for half in halves)
            if not halves:
                self.rows[node] = rows, term, value, owner
        node, term, centre, most = (np.concatenate(c) for c in zip(*columns, strict=True))
        order = np.argsort(term, kind="stable")
        self.node, self.term, self.centre, self.most = node[order], term[order], centre[order], most[order]
        self.reach = np.array(self.radius)
        self.leaves = sum(rows is not None for rows in self.rows)

    def _centre(self, rows: np.ndarray, term: np.ndarray, value: np.ndarray, scaled: np.ndarray):
        """Terms of some rows, their mean scaled values, and their largest values."""
        np.add.at(self.work, term, scaled)
        terms = np.unique(term)
        centre = self.work[terms] / max(len(rows), 1)
        self.work[terms] = 0
        np.maximum.at(self.work, term, value)
        most = self.work[terms]
        self.work[terms] = 0
        return terms, centre, most

    def _distances(self, rows: np.ndarray, terms: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """Squared distances of rows from a centre given by its terms and values there."""
        at, owner = self.vectors.entries(rows)
        self.work[terms] = centre
        value, mid = self.vectors.scaled[at], self.work[self.vectors.term[at]]
        # only terms of the row differ from the centre's own square
        change = np.bincount(owner, (value - mid) ** 2 - mid**2, len(rows))
        self.work[terms] = 0
        return np.maximum(change + (centre**2).sum(), 0)

    def _halves(self, rows: np.ndarray, far: np.ndarray, norm: float) -> list[np.ndarray]:
        """The rows nearer to either of two far rows, none if they make a leaf."""
        if len(rows) <= self.leaf:
            return []
        v = self.vectors
        first = rows[far.argmax()]
        one = self._distances(rows, v.term[v.row(first)], v.scaled[v.row(first)])
        second = rows[one.argmax()]
        two = self._distances(rows, v.term[v.row(second)], v.scaled[v.row(second)])
        near = one <= two
        if near.all() or not near.any():
            if one.max() <= SLACK * norm:
                return []  # all rows are one vector
            near = np.arange(len(rows)) < len(rows) // 2
        return [rows[near], rows[~near]]

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """What no document of a node can score above, for every node and an item with these terms."""
        low, high = np.searchsorted(self.term, terms), np.searchsorted(self.term, terms, "right")
        size = high - low
        end = np.cumsum(size)
        at = np.arange(end[-1]) + np.repeat(low - end + size, size)
        node, n = self.node[at], len(self.children)
        length = np.sqrt(np.bincount(node, self.weight[self.term[at]], n))
        ball = np.bincount(node, self.centre[at], n) + length * self.reach
        return np.minimum(ball, np.bincount(node, self.most[at], n)) * (1 + SLACK) + 1

    def search(self, terms: np.ndarray, best: list, k: int) -> tuple[int, int]:
        """Improve `best`, a heap of at most k (score, -doc_id), for an item with these sorted terms.

        Returns how many leaves were scored and how many documents were in them.
        """
        bound = self.bounds(terms).tolist()
        item = np.zeros(len(self.weight), bool)
        item[terms] = True
        leaves = seen = 0
        queue = [(-bound[0], 0)]
        while queue:
            most, node = heapq.heappop(queue)
            if len(best) == k and -most < best[0][0]:
                break  # the best of what is left cannot reach the k-th score, not even for a tie
            for child in self.children[node]:
                heapq.heappush(queue, (-bound[child], child))
            if self.rows[node] is None:
                continue
            rows, term, value, owner = self.rows[node]
            hit = item[term]
            score = np.zeros(len(rows), np.int64)
            np.add.at(score, owner[hit], value[hit])
            leaves, seen = leaves + 1, seen + len(rows)
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(score >= least):
                entry = (int(score[i]), -int(self.vectors.ids[rows[i]]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return leaves, seen


def _search(weight: np.ndarray, n_docs: int, n_terms: int, items: list[np.ndarray], k: int, leaf: int):
    """Best documents of the rows of a task: (item, doc_id, score)."""
    scale = 1 / np.sqrt(np.maximum(weight, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items]
        for batch in batches:
            for vectors in _vectors(batch):
                tree = BallTree(vectors, weight, leaf)
                for i, terms in enumerate(items):
                    if len(terms):
                        tree.search(terms, best[i], k)
        rows = [(i, -doc, score) for i, found in enumerate(best) for score, doc in found]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    def _vectors(batch: pa.RecordBatch) -> Iterator[Vectors]:
        ends = np.asarray(batch.column("terms").offsets).astype(np.int64)
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + TREE_ENTRIES, "right")) - 1)
            part = batch.slice(row, stop - row)
            n, size = np.asarray(part.column("n")), np.diff(ends[row : stop + 1])
            term, times = (np.asarray(part.column(c).flatten()).astype(np.int64) for c in ("terms", "times"))
            m = 10 + (90 * n * n_docs) // n_terms
            value = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * np.repeat(m, size)))
            yield Vectors(np.asarray(part.column("doc_id")), np.concatenate([[0], np.cumsum(size)]), term, value, scale)
            row = stop

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """(row, sorted distinct terms) of all items, in blocks of about `block_bytes` of text; one block at least."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "text")
        yield [(r.row, sorted(set(terms_of(r.text)))) for r in mine.toLocalIterator()]


def ranked_search(
    documents: DataFrame, benchmark: DataFrame, k: int = TOP, leaf: int = LEAF, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(item_id, rank, doc_id, score): of every item the k best documents with a score above 0.

    N documents have a term, with L terms in all; n is the length of one and tf a term's count in it.
    A term held by df documents weighs w = floor(1000 ln((2N + 2) / (2df + 1))); with m = 10 + (90 n N) div L
    a document scores the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the distinct terms of an item. Equal
    scores are ranked by ascending doc_id.

    Null and empty texts have no terms. A document without doc_id counts in N, L and df, but cannot
    be ranked. Repeated documents are ranked each on its own, repeated items answered each on its own;
    other columns are not read. Items are taken in blocks bounded by `block_bytes`; an item's terms travel
    to the tasks, and larger benchmarks take more passes. Very long texts are rows as others: a vector has at
    most as many entries as the block of items has terms.
    """
    items = benchmark.select(F.monotonically_increasing_id().alias("row"), F.col("item_id"), F.col("text").cast("string").alias("text"))
    items = written(items, "items")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in _blocks(items, block_bytes):
        known = {term: i for i, term in enumerate(sorted({t for _, terms in block for t in terms}))}
        counted = written(docs.mapInArrow(_count(known), "doc_id long, n long, terms array<int>, times array<int>"), "terms")
        total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        held = np.zeros(len(known), np.int64)
        for term, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            held[term] = n
        weight = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * int(df) + 1))) for df in held], np.int64)
        wanted = [np.array([known[t] for t in terms], np.int64) for _, terms in block]
        rows = counted.where("doc_id is not null and size(terms) > 0")
        here = rows.mapInArrow(_search(weight, total.docs, max(total.terms or 0, 1), wanted, k, leaf), "item long, doc_id long, score long")
        numbers = docs.sparkSession.createDataFrame([(i, row) for i, (row, _) in enumerate(block)], "item long, row long")
        here = here.join(numbers, "item").select("row", "doc_id", "score")
        found = here if found is None else found.unionByName(here)
    # every task sends k rows per item: first the best of a part of them, so that no item meets in one task
    order = [F.col("score").desc(), F.col("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("row", "salt").orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(items.select("row", "item_id"), "row").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
