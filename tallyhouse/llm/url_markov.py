"""URL filter: rules first, then the ratio of two character language models."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .words import mix, powers, text_bytes

#: (verdict, host, path prefix); the longest fitting rule decides.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 5  # characters of context at most
#: Weight of the shorter context's estimate, in observations.
WEIGHT = 4.0
#: One labelled URL in so many sets the threshold instead of training.
HELD_OUT = 5
#: Text of the URLs that are scored together, in bytes.
BLOCK_BYTES = 1 << 20
#: Bins of the score, from -SPAN to SPAN, in which the threshold is sought.
BINS, SPAN = 400, 4.0


class Counts(NamedTuple):
    """How often runs of characters were seen in accepted and rejected URLs, by the runs' full hashes."""

    key: np.ndarray  # sorted
    seen: np.ndarray  # [class, run]
    totals: np.ndarray  # [class]: all characters

    def of(self, key: np.ndarray, c: int) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.seen[c, at], 0.0)


def _grams(column: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each length 0..order+1: the hash of the run of that length that ends at each character; and the owner."""
    data, at = text_bytes(column)
    owner = np.repeat(np.arange(len(column)), np.diff(at))
    room = np.arange(len(data)) - at[:-1][owner] if len(data) else owner
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)))])
    back = powers(len(data) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    ends = np.arange(1, len(data) + 1)
    keys = []
    for length in range(order + 2):
        # at the beginning of a text, runs are as short as the text allows, and marked as such
        start = ends - np.minimum(length, room + 1)
        keys.append(mix((total[ends] - total[start]) * back[start] + (np.uint64(length) << np.uint64(48)) + (ends - start).astype(np.uint64)))
    return keys, owner


#: The run of no characters: it is seen at every character.
EMPTY = int(mix(np.zeros(1, np.uint64)).view(np.int64)[0])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, owner = _grams(batch.column("text"), ORDER)
        allowed = np.asarray(batch.column("allowed"), dtype=bool)[owner]
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        both = np.tile(allowed, len(keys))
        yes, every = np.bincount(where, both, len(key)), np.bincount(where, minlength=len(key))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(yes.astype(np.int64)), pa.array((every - yes).astype(np.int64))], ["key", "allow", "block"])


def _runs(key: tuple[pa.Scalar, ...], urls: pa.Table) -> pa.Table:
    """The distinct runs of a block of URLs."""
    keys, _ = _grams(urls.column("text").combine_chunks(), ORDER)
    found = np.unique(np.concatenate(keys[1:]))
    return pa.table({"block": pa.array(np.full(len(found), key[0].as_py())), "key": pa.array(found.view(np.int64))})


def difference(counts: Counts, column: pa.Array) -> np.ndarray:
    """log P(text | accepted) - log P(text | rejected), per character; 0 for an empty text.

    Each model mixes contexts of all lengths: the estimate for a context is its counts plus
    WEIGHT observations distributed as the next shorter context has it, down to equal bytes. A
    context is a run without its last character; at a text's first character it is all characters.
    """
    keys, owner = _grams(column, ORDER)
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    logs = []
    for c in range(2):
        p = np.full(len(owner), 1 / 256)
        earlier = np.full(len(owner), float(counts.totals[c]))
        for key in keys[1:]:
            seen = counts.of(key, c)
            before = np.where(first, float(counts.totals[c]), np.concatenate([earlier[:1], earlier[:-1]]))
            p = (seen + WEIGHT * p) / (before + WEIGHT)
            earlier = seen
        logs.append(np.log(p))
    n = np.maximum(np.bincount(owner, minlength=len(column)), 1)
    return np.bincount(owner, logs[0] - logs[1], len(column)) / n


def _score(totals: np.ndarray):
    def run(key: tuple[pa.Scalar, ...], urls: pa.Table, runs: pa.Table) -> pa.Table:
        keys = np.asarray(runs["key"]).astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        seen = np.stack([np.asarray(runs[c]).astype(float)[order] for c in ("allow", "block")])
        text = urls.column("text").combine_chunks()
        return pa.table({"text": text, "score": pa.array(difference(Counts(keys[order], seen, totals), text))})

    return run


def scored_urls(urls: DataFrame, labelled: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(text, score) of distinct URLs by two models counted from (text, allowed), and the models' sizes.

    The counts are a table of all runs, which grows with the labelled URLs. URLs are dealt out in blocks by
    their hash; a block's distinct runs are joined to the counts, and what is known of them comes back.
    """
    counted = labelled.mapInArrow(_count, "key long, allow long, block long").groupBy("key").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    counted = written(counted, "runs")
    whole = counted.where(F.col("key") == EMPTY).first()
    totals = np.array([whole["allow"], whole["block"]] if whole else [0, 0], float)
    urls = urls.select("text").distinct()
    size = urls.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    block = F.pmod(F.xxhash64("text"), F.lit(max(1, -(-size // BLOCK_BYTES))))
    urls = urls.select(block.alias("of"), "text")
    runs = urls.groupBy("of").applyInArrow(_runs, "block long, key long").join(counted.withColumnRenamed("block", "blocked").hint("merge"), "key")
    runs = runs.select(F.col("block").alias("at"), "key", "allow", F.col("blocked").alias("block"))
    return urls.groupBy("of").cogroup(runs.groupBy("at")).applyInArrow(_score(totals), "text string, score double"), totals


def _lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judge_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    URLs that a rule decides train two models, of accepted and of rejected URLs; all others
    are judged by the models' log-likelihood difference per character. Its
    threshold maximises balanced accuracy on labelled URLs that were held out (by
    a hash of the URL; an allowed URL on the threshold passes).

    Equal URLs are scored once, so a hot URL is no hot task. A null URL or one without "://" has an
    empty host and path and no rule; a null or empty one has score 0; a very long one is scored whole.
    Repeated rows are repeated results; of other columns none is read. Without labelled URLs of
    both kinds nothing is rejected but by rule.
    """
    host = r"(?s)^.*?://([^/?#]*)"
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    base = pages.select(
        F.col("page_id"),
        _lower(F.regexp_extract(url, host, 1)).alias("host"),
        F.regexp_extract(url, host + "([^?#]*)", 2).alias("path"),
        _lower(url).alias("text"),
    )
    rule, given = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == domain) | F.col("host").endswith("." + domain)) & F.col("path").startswith(prefix)
        rule = F.when(fits, F.lit(domain + prefix)).otherwise(rule)
        given = F.when(fits, F.lit(verdict)).otherwise(given)
    base = base.withColumns({"rule": rule, "given": given})
    labelled = base.where("given is not null").select("text", (F.col("given") == "allow").alias("allowed"))
    aside = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    scores, totals = scored_urls(base, labelled.where(~aside))
    scores = written(scores, "scores")
    threshold = _threshold(labelled.where(aside).join(scores, "text"))
    if not totals.all():
        threshold = -np.inf
    judged = F.when(F.col("score") >= F.lit(float(threshold)), "allow").otherwise("block")
    # a hot URL is split by adaptive execution: scores have one row for it
    return base.join(scores, "text").select("page_id", "host", "path", "rule", F.coalesce("given", judged).alias("verdict"), "score")


def _threshold(held_out: DataFrame) -> float:
    """The bin edge with the best balanced accuracy; of equal ones, the middle."""
    place = F.least(F.greatest(F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN))), F.lit(0)), F.lit(BINS - 1)).cast("int")
    rows = held_out.groupBy(place.alias("bin")).agg(F.sum(F.col("allowed").cast("long")).alias("yes"), F.count("*").alias("n")).collect()
    yes, no = np.zeros(BINS), np.zeros(BINS)
    for row in rows:
        yes[row["bin"]], no[row["bin"]] = row["yes"], row["n"] - row["yes"]
    if not yes.sum() or not no.sum():
        return 0.0
    passed = np.concatenate([[0], np.cumsum(no)]) / no.sum() + 1 - np.concatenate([[0], np.cumsum(yes)]) / yes.sum()
    best = np.flatnonzero(passed >= passed.max() - 1e-12)
    return float(best[len(best) // 2] * 2 * SPAN / BINS - SPAN)
