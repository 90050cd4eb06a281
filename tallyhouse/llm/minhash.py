"""Near-duplicate documents by circulant MinHash, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .tables import written
from .words import NOT_SPACE, mix, shingle_hash, slices, text_starts, words

SHINGLE = 5
ROWS = 4  # coordinates in a band
BANDS = 16  # at similarity 0.85 a pair shares none of them with probability 7e-6
BLOCK = 256  # classes in a block of a bucket that is compared exhaustively
RING = 1 << 20  # positions of the circulant permutation
SEED = 0x5EED


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after another, and where each set begins.

    A text with fewer words than `size` has its whole sequence as one shingle; a text
    without words has none.
    """
    w = words(column, NOT_SPACE)
    position, text = text_starts(w.first, size)
    hashes = shingle_hash(w.hash, size)[position]
    count = np.diff(w.first)
    for i in np.flatnonzero((count > 0) & (count < size)):
        run = w.hash[w.first[i] : w.first[i + 1]]
        short = mix(np.array([int(np.bitwise_xor.reduce(mix(run + np.arange(len(run), dtype=np.uint64)))) ^ len(run)], np.uint64))
        text, hashes = np.append(text, i), np.append(hashes, short)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[keep], hashes[keep]
    return hashes, np.searchsorted(text, np.arange(len(column) + 1))


def circulant_signatures(hashes: np.ndarray, first: np.ndarray, coordinates: int, ring: np.ndarray) -> np.ndarray:
    """Coordinate k of a set is the minimum of the ring permutation, shifted by k, over its members.

    The first permutation (the mixed hash, modulo the ring) breaks the structure of the
    input; the second, `ring`, is the only one stored: its shifts serve as all others.
    """
    place = (mix(hashes ^ np.uint64(SEED)) % np.uint64(len(ring))).astype(np.int64)
    longer = np.concatenate([ring, ring[:coordinates]])
    full = np.diff(first) > 0
    out = np.full((len(first) - 1, coordinates), len(ring), np.int32)
    if len(hashes):
        begin = first[:-1][full]
        for k in range(coordinates):
            out[full, k] = np.minimum.reduceat(longer[place + k], begin)
    return out


def _sketch(rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring = np.random.default_rng(SEED).permutation(RING).astype(np.int32)
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first = shingle_sets(part.column("text"))
                signature = circulant_signatures(hashes, first, rows * bands, ring).astype(np.uint64)
                n = part.num_rows
                band = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    band = mix(band * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows] + np.uint64(r + 1))
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes)])
                other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes))])
                offsets = np.arange(0, n * bands + 1, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)),
                        pa.array((other[first[1:]] - other[first[:-1]]).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.reshape(-1).view(np.int64))),
                    ],
                    ["doc_id", "n_shingles", "digest_1", "digest_2", "bands"],
                )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, first = shingle_sets(part.column("text"))
            raw = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(raw, pa.binary())], ["id", "members"])


def _similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether 100 * shared >= percent * all, for sorted distinct members."""
    if len(p) > len(q):
        p, q = q, p
    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
    both = int(np.count_nonzero(q[at] == p))
    return 100 * both >= percent * (len(p) + len(q) - both)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("x"), batch.column("y"), strict=True)
            keep = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def shared_counts(first: list[np.ndarray], second: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many members each set of `first` shares with each of `second`.

    Only members found on both sides count; they are taken `width` at a time, as columns of two
    0/1 matrices whose product is added up, so memory is bounded whatever the sets' sizes.
    """
    sides = []
    for sets in (first, second):
        member = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        sides.append((member, np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    common = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    places = []
    for member, owner in sides:
        at = np.searchsorted(common, member)
        known = common[np.minimum(at, max(len(common) - 1, 0))] == member if len(common) else np.zeros(len(member), bool)
        places.append((at[known], owner[known]))
    out = np.zeros((len(first), len(second)), np.float32)
    for begin in range(0, len(common), width):
        blocks = []
        for (at, owner), sets in zip(places, (first, second), strict=True):
            here = (at >= begin) & (at < begin + width)
            block = np.zeros((len(sets), width), np.float32)
            block[owner[here], at[here] - begin] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out


def _compare(percent: int):
    """Links between two blocks of one bucket (or inside one): as many as join their components, no more."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, component, n, block = (np.asarray(table.column(c)) for c in ("id", "component", "n_shingles", "block"))
        band, i, j, pivot = (table.column(c)[0].as_py() for c in ("band", "i", "j", "pivot"))
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
        open_ = component[first][:, None] != component[second][None]
        # pairs with the pivot are done; inside a block each pair counts once
        open_ &= (ids[first] != pivot)[:, None] & (ids[second] != pivot)[None]
        open_ &= (first[:, None] < second[None]) | (i != j)
        least = np.minimum(n[first][:, None], n[second][None])
        open_ &= 100 * least >= percent * np.maximum(n[first][:, None], n[second][None])
        # a pair that also meets in an earlier band is compared there
        for b in range(band):
            open_ &= bands[first, b][:, None] != bands[second, b][None]
        first, second, open_ = first[open_.any(1)], second[open_.any(0)], open_[open_.any(1)][:, open_.any(0)]
        out = []
        if open_.size:
            members = table.column("members")
            one, two = ([np.frombuffer(members[k].as_buffer(), np.uint64) for k in side.tolist()] for side in (first, second))
            both = shared_counts(one, two)
            linked = open_ & (100 * both >= percent * (n[first][:, None] + n[second][None] - both))
            parent = {c: c for c in component.tolist()}

            def root(c):
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            for x, y in zip(*np.nonzero(linked), strict=True):
                p, q = root(int(component[first[x]])), root(int(component[second[y]]))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    pair = int(ids[first[x]]), int(ids[second[y]])
                    out.append((max(pair), min(pair)))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def near_duplicates(documents: DataFrame, percent: int = 85, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * shared shingles >= percent * all shingles of both;
    a component is what links reach. Candidates share a band of their circulant
    signatures; every link is confirmed on the full sets.

    * Documents with equal sets become one class before anything is compared, so groups
      of exact copies, however large, cost one grouped minimum.
    * In each band bucket all classes are first compared with the bucket's smallest id only.
    * Buckets whose classes are then still in different components are compared exhaustively, in
      pairs of blocks of about BLOCK classes: only classes of different components, and only in the
      first band that a pair shares. All shared counts of a block pair are one matrix
      product; it returns no more links than join its components, so no pairs are emitted and
      nothing is capped.
    * Null and empty texts and texts without words have no shingles, are linked with
      nothing and are their own component. Repeated doc_ids stay repeated rows of one
      document. A null doc_id is nobody's smallest id: it joins no component
      and its row has a null component_id and kept = true.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sketch = written(docs.mapInArrow(_sketch(rows, bands), "doc_id long, n_shingles long, digest_1 long, digest_2 long, bands array<long>"), "sketch")
    key = ["n_shingles", "digest_1", "digest_2"]
    classes = written(sketch.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes")
    member = classes.select("id", "n_shingles", F.posexplode("bands").alias("band", "value"))
    # a bucket with one class proposes nothing
    full = member.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1")
    buckets = written(member.join(full.drop("size"), ["band", "value"]), "buckets")
    wanted = buckets.select("id").distinct()
    sets = written(docs.join(wanted, docs["doc_id"] == wanted["id"], "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_sets, "id long, members binary"), "sets")
    star = _star(buckets, sets, percent)
    settled = written(components(star), "settled")
    more = _rest(buckets, classes, settled, sets, percent)
    if not more.isEmpty():
        settled = written(components(star.unionByName(more)), "settled")
    label = classes.join(settled, "id", "left").select(*key, F.coalesce("component", "id").alias("component_id"))
    out = sketch.drop("bands").join(label, key, "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _star(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between each bucket's smallest id and its other classes."""
    low = buckets.groupBy("band", "value").agg(F.min(F.struct("id", "n_shingles")).alias("p"))
    low = low.select("band", "value", F.col("p.id").alias("b"), F.col("p.n_shingles").alias("m"))
    n, m = F.col("n_shingles"), F.col("m")
    pairs = buckets.join(low, ["band", "value"]).where("id <> b").where(100 * F.least(n, m) >= percent * F.greatest(n, m))
    pairs = pairs.select(F.col("id").alias("a"), "b").distinct()
    pairs = pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a")
    pairs = pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
    return written(pairs.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"), "links")


def _rest(buckets: DataFrame, classes: DataFrame, settled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between different components that meet in a bucket, beyond those of `_star`."""
    named = buckets.join(settled, "id", "left").withColumn("component", F.coalesce("component", "id"))
    key = ["band", "value"]
    mixed = named.groupBy(*key).agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size"), F.min("id").alias("pivot"))
    mixed = mixed.where("least <> most and size > 2").select(*key, "size", "pivot")
    here = named.join(mixed, key).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    here = here.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    here = here.join(classes.select("id", "bands"), "id").join(sets, "id")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j"))))
    here = here.withColumn("meets", meets).select(*key, "meets.*", "block", "pivot", "id", "component", "n_shingles", "bands", "members")
    return written(here.groupBy(*key, "i", "j").applyInArrow(_compare(percent), "a long, b long"), "links")
