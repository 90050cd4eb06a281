"""Toxic passages as maximum-scoring segments of token log-odds."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .words import Words, byte_class, mix, powers, slices, words

#: A token is looked up by its first 4, 5, 6 and 8 bytes and as a whole.
PREFIXES = (4, 5, 6, 8)
LEVELS = len(PREFIXES) + 1
#: The classifier is fitted on labelled documents of about this many bytes at most (a sample by doc_id where
#: there are more), and on half as many as long as the model has more entries than MODEL_ENTRIES.
LABELLED_BYTES = 4 << 30
MODEL_ENTRIES = 16 << 20
#: Strength of the Dirichlet prior: pseudo documents that follow the next shorter prefix.
PRIOR = 12.0
#: Log-odds that a passage must gain per token beyond the average of clean text.
DRIFT = 0.5
FLOOR, CEILING = -2.0, 8.0
#: A token's evidence is halved, then a third and so on where it repeats within so many tokens.
REACH = 100
#: A passage is significant if a clean text has so many as good by chance at most.
SIGNIFICANT = 0.05
#: Documents decide for predicted = 1 from this score on.
THRESHOLD = 0.7
#: Bins in which statistics of labelled documents are counted: of best segments up to SPAN, of evidence
#: up to SPAN on a logarithmic scale.
BINS, SPAN = 512, 64.0
LETTERS = byte_class(lambda c: c.isalnum() or c == "'")


class Model(NamedTuple):
    """Training documents of both classes by token; tokens of a single document are left out."""

    key: np.ndarray  # sorted 64-bit hashes of level and prefix
    toxic: np.ndarray
    clean: np.ndarray
    documents: np.ndarray  # toxic and clean training documents

    def counts(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Toxic and clean documents with the tokens of these keys."""
        if not len(self.key):
            return np.zeros(len(key)), np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        known = self.key[at] == key
        return np.where(known, self.toxic[at], 0.0), np.where(known, self.clean[at], 0.0)


class Law(NamedTuple):
    """P(best segment of n clean tokens >= s) = 1 - exp(-size * n * exp(-decay * s))"""

    decay: float
    size: float


def _keys(w: Words) -> np.ndarray:
    """[level, word]: hashes of each word's prefixes (the word itself where it is shorter) and of the word."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * powers(len(w.data)))])
    back = powers(len(w.data) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64))[w.start]
    keys = []
    for level, length in enumerate(PREFIXES):
        end = np.minimum(w.start + length, w.end)
        keys.append(mix((total[end] - total[w.start]) * back + np.uint64(level + 1)))
    keys.append(mix(w.hash))
    return np.stack(keys)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class with each token, added up within the task's batches; a null key counts documents."""
    for batch in batches:
        parts = [np.zeros((2, 0), np.uint64)]
        labels = np.zeros(2, np.int64)
        for part in slices(batch, "text"):
            w = words(part.column("text"), LETTERS)
            text = np.repeat(np.arange(part.num_rows), np.diff(w.first))
            toxic = np.asarray(part.column("toxic")).astype(np.int64)
            labels += np.bincount(toxic, minlength=2)[:2]
            for key in _keys(w):
                order = np.lexsort((text, key))
                key, owner = key[order], text[order]
                once = np.ones(len(key), bool)
                once[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                parts.append(np.stack([key[once], toxic[owner[once]].astype(np.uint64)]))
        key, toxic = np.concatenate(parts, 1)
        key, place = np.unique(key, return_inverse=True)
        hits, every = np.bincount(place, toxic.astype(float), len(key)), np.bincount(place, minlength=len(key))
        keys = pa.array([*key.view(np.int64).tolist(), None], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [keys, pa.array([*hits.astype(np.int64), labels[1]], pa.int64()), pa.array([*(every - hits).astype(np.int64), labels[0]], pa.int64())],
            ["key", "toxic", "clean"],
        )


def _fit(labelled: DataFrame) -> Model | None:
    """Grouped document counts of all tokens that two documents have; None if there are too many to be sent."""
    counted = labelled.mapInArrow(_count, "key long, toxic long, clean long")
    grouped = counted.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    grouped = written(grouped.where("key is null or toxic + clean > 1"), "counts")
    if grouped.count() > MODEL_ENTRIES:
        return None
    rows = grouped.select("key", F.col("toxic").cast("float").alias("toxic"), F.col("clean").cast("float").alias("clean")).toArrow()
    token = rows.filter(pc.is_valid(rows["key"]))
    total = rows.filter(pc.is_null(rows["key"]))
    key = np.asarray(token["key"]).astype(np.int64).view(np.uint64)
    order = np.argsort(key)
    documents = np.array([sum(total["toxic"].to_pylist()), sum(total["clean"].to_pylist())], float)
    return Model(key[order], np.asarray(token["toxic"])[order], np.asarray(token["clean"])[order], documents)


def token_scores(model: Model, w: Words, own: np.ndarray | None = None) -> np.ndarray:
    """Log-odds of each token against the average, less the drift; a repetition within one passage tells less.

    The share of toxic documents among those with a token has a Dirichlet prior centred on
    the share of its next shorter prefix; the shortest prefix starts from the overall share. So
    a rare inflection takes the score of its stem, and a token seen once says little.
    `own` (the label of each text) leaves a training document's own counts out.
    """
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    # equal words of equally labelled texts have one score
    label = np.zeros(len(text), np.uint64) if own is None else own[text].astype(np.uint64)
    _, at, place = np.unique(w.hash * np.uint64(2) + label, return_index=True, return_inverse=True)
    toxic_text = np.zeros(len(at)) if own is None else own[text[at]]
    clean_text = np.zeros(len(at)) if own is None else 1 - own[text[at]]
    t, c = np.maximum(model.documents, 1.0)
    base = t / (t + c)
    share = np.full(len(at), base)
    for key in _keys(w)[:, at]:
        seen_t, seen_c = model.counts(key)
        seen_t, seen_c = np.maximum(seen_t - toxic_text, 0), np.maximum(seen_c - clean_text, 0)
        share = (seen_t + PRIOR * share) / (seen_t + seen_c + PRIOR)
    share = np.clip(share, 1e-6, 1 - 1e-6)
    scores = np.clip(np.log(share / (1 - share)) - np.log(base / (1 - base)) - DRIFT, FLOOR, CEILING)[place]
    return np.where(scores > 0, scores / (1 + _repeats(w.hash, text)), scores)


def _repeats(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How often each token has stood before it in its text without a gap of more than REACH tokens."""
    key = mix(key + text.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(key, kind="stable")
    first = np.ones(len(key), bool)
    first[1:] = (key[order][1:] != key[order][:-1]) | (np.diff(order) > REACH)
    count = np.zeros(len(key), np.int64)
    count[order] = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    return count


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score), in linear time (Ruzzo and Tompa).

    Each candidate remembers the running sums before and at its end, and the last earlier candidate
    that began lower; a new positive score is merged with earlier candidates as long as that makes a
    segment with a larger score. The search for one that began lower jumps along what
    the passed ones remember, so that no candidate is passed twice.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    places = np.flatnonzero(scores > 0)
    stack: list[tuple[int, int, float, float, int]] = []  # begin, end, sum before, sum at the end, began lower
    for i, low, high in zip(places.tolist(), total[places].tolist(), total[places + 1].tolist(), strict=True):
        begin = i
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                break
            begin, low = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((begin, i + 1, low, high, j))
    return [(b, e, h - l) for b, e, l, h, _ in stack]


def _segments(model: Model, part: pa.RecordBatch, own: np.ndarray | None = None) -> tuple[np.ndarray, list]:
    """Tokens and maximal segments of each text."""
    w = words(part.column("text"), LETTERS)
    scores = token_scores(model, w, own)
    return np.diff(w.first), [maximal_segments(scores[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]


def evidence(law: Law, n: np.ndarray, segments: list) -> np.ndarray:
    """What the significant segments of each text add up to.

    Under the law a clean text of n tokens has about size * n * exp(-decay * s) segments with score
    s or more; a segment adds minus the logarithm of that number (with one more, so
    that short texts are not favoured) as far as it is positive.
    """
    floor = np.log1p(law.size * n)
    return np.array([sum(max(0.0, law.decay * s - f) for *_, s in found) for found, f in zip(segments, floor.tolist(), strict=True)])


def _best(sent: Broadcast):
    """Counts of clean documents by log2 of their length and by the score of their best segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                toxic = np.asarray(part.column("toxic")).astype(np.int64)
                n, found = _segments(model, part, toxic)
                best = np.array([max((s for *_, s in f), default=0.0) for f in found])
                place = np.minimum((best * (BINS / SPAN)).astype(np.int64), BINS - 1)
                key = np.log2(np.maximum(n, 1)).astype(np.int64) * BINS + place
                key, count = np.unique(key[toxic == 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["key", "n"])

    return run


def _evidence(sent: Broadcast, law: Law):
    """Counts of documents by class and by their evidence on a logarithmic scale."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                toxic = np.asarray(part.column("toxic")).astype(np.int64)
                amount = np.log1p(evidence(law, *_segments(model, part, toxic)))
                place = np.minimum(amount * (BINS / np.log1p(SPAN)), BINS - 1).astype(np.int64)
                key, count = np.unique(toxic * BINS + place, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["key", "n"])

    return run


def _counted(frame: DataFrame, run, size: int) -> np.ndarray:
    """Sums of the counts that `run` makes, as a dense table of `size` numbers."""
    out = np.zeros(size)
    for row in frame.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[row["key"]] = row["n"]
    return out


def fit_law(table: np.ndarray) -> Law:
    """The law's decay from the tail of clean maxima above their median, its size from their mean number."""
    score = (np.arange(BINS) + 0.5) * SPAN / BINS
    tokens = 1.5 * 2.0 ** np.arange(len(table))
    marginal = table.sum(0)
    if not marginal.sum():
        return Law(1.0, 0.01)
    middle = score[np.cumsum(marginal) > marginal.sum() / 2][0]
    tail = marginal * (score >= middle)
    decay = 1.0 / max((tail * (score - middle)).sum() / tail.sum(), 0.25)
    size = marginal.sum() / max((table * tokens[:, None] * np.exp(-decay * score)).sum(), 1e-9)
    return Law(float(decay), float(size))


def fit_logistic(table: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of P(toxic) on the logarithm of the evidence, by Newton's method on counts."""
    clean, toxic = table.reshape(2, BINS)
    if not clean.sum() or not toxic.sum():
        return 0.0, 0.0
    # bin 0 is no evidence at all
    x = np.arange(BINS) * (np.log1p(SPAN) / BINS)
    x, y, k = np.tile(x, 2), np.repeat([0.0, 1.0], BINS), np.concatenate([clean, toxic])
    low, slope = 0.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(low + slope * x, -30, 30)))
        gradient = np.array([(k * (y - p)).sum() - 1e-3 * low, (k * (y - p) * x).sum() - 1e-3 * slope])
        h = k * p * (1 - p)
        hessian = np.array([[h.sum() + 1e-3, (h * x).sum()], [(h * x).sum(), (h * x * x).sum() + 1e-3]])
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        low, slope = low + float(step[0]), slope + float(step[1])
    return low, slope


_SCORED = "doc_id long, score double, spans string"


class Judge(NamedTuple):
    """Everything that scoring needs; the model is sent once for all passes."""

    model: Broadcast
    law: Law
    low: float
    slope: float

    def scores(self, model: Model, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list]:
        n, found = _segments(model, part)
        odds = self.low + self.slope * np.log1p(evidence(self.law, n, found))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30))), n, found


def _score(judge: Judge):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = judge.model.value
        for batch in batches:
            for part in slices(batch, "text"):
                score, n, found = judge.scores(model, part)
                spans = []
                for size, segments in zip(n.tolist(), found, strict=True):
                    strong = [s for s in segments if judge.law.size * size * np.exp(-judge.law.decay * s[2]) < SIGNIFICANT]
                    spans.append(",".join(f"{b}:{e}" for b, e, _ in strong))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array(spans, pa.string())], ["doc_id", "score", "spans"])

    return run


def _keep(judge: Judge, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = judge.model.value
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(judge.scores(model, part)[0] < threshold))

    return run


def _aside() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string")), F.lit(3)) == 1, F.lit(False))


def learn(documents: DataFrame, labels: DataFrame) -> Judge:
    """Fits the model on labelled documents that are not held out."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().where(~_aside())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # labels grow with the documents: the same join at every size
    joined = docs.where(~_aside()).join(known.hint("merge"), "doc_id")
    labelled = written(joined.select("doc_id", "text", "toxic"), "labelled")
    size = labelled.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    share = min(1.0, LABELLED_BYTES / max(size, 1))
    while True:
        chosen = labelled if share == 1.0 else labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
        fitted = _fit(chosen.select("text", "toxic"))
        if fitted:
            break
        share /= 2
    labelled = chosen.select("text", "toxic")
    # at most MODEL_ENTRIES entries of 16 bytes
    model = documents.sparkSession.sparkContext.broadcast(fitted)
    law = fit_law(_counted(labelled, _best(model), 64 * BINS).reshape(64, BINS))
    return Judge(model, law, *fit_logistic(_counted(labelled, _evidence(model, law), 2 * BINS)))


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans (significant passages, in tokens).

    Token log-odds are learned from labelled documents that are not held out (crc32 of the
    doc_id as text, modulo 3, is not 1) as grouped counts by the full hash of a token; every occurrence
    of a token scores, a repetition nearby less than the first. The law of
    best segments in clean documents, and the map from a document's evidence to a probability,
    are fitted on the same documents, each scored without its own counts.

    Null and empty texts score like a text without any segment. A repeated doc_id is scored in
    each row; of repeated labels any toxic one counts; null labels and doc_ids are not used. Without
    labels of both classes every score is 0.5.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scored = docs.mapInArrow(_score(learn(documents, labels)), _SCORED)
    return scored.select("doc_id", _aside().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that `toxicity` does not predict as toxic, all columns as they are; nothing is shuffled for it."""
    docs = documents.withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(_keep(learn(documents, labels), threshold), docs.schema)
