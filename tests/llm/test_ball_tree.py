"""Ranks equal a plain scorer; bounds never cut a document that belongs to the result."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from explain import SMALL

from tallyhouse.llm.ball_tree import BallTree, Vectors, ranked_search, terms_of
from tallyhouse.llm.queries import op12_ball_tree_search

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return [t.translate(_LOWER) for t in _TERM.findall(text or "")]


def plain(docs, items, k=10):
    docs = [(i, Counter(plain_terms(text))) for i, text in docs]
    sizes = [sum(c.values()) for _, c in docs]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    held = Counter(t for _, c in docs for t in c)
    for item, text in items:
        scores = []
        for (i, count), n in zip(docs, sizes, strict=True):
            score = 0
            for t in set(plain_terms(text)) & set(count):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                m = 10 + (90 * n * n_docs) // total
                score += w * ((1_000_000_000 * count[t]) // (1000 * count[t] + 8 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        yield from ((item, rank, i, -score) for rank, (score, i) in enumerate(sorted(scores)[:k], 1))


@pytest.fixture(scope="module")
def benchmark(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id string, text string, row int, doc_id string").repartition(2)

    return build


def got(df):
    return sorted(("" if r.item_id is None else str(r.item_id), r["rank"], r.doc_id, r.score) for r in df.collect())


def test_terms():
    text = "ÀB-c_d'É 12ab\x00x\x7f Ünï　日本 A"
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def test_awkward_rows(documents, benchmark):
    docs = [(9, "apple pear"), (3, "apple pear"), (3, "apple pear"), (4, "Apple apple plum"), (5, None), (6, ""), (7, "..."),
            (None, "apple pear plum"), (8, "pear " * 5_000 + "kiwi"), (10, "zz"), (11, "Éa é1")]
    items = [("a", "apple, PEAR"), ("a", "apple, PEAR"), ("b", None), ("c", ""), ("d", "unseen words"), (None, "kiwi"), ("e", "Éa"), ("f", "pear pear plum")]
    want = sorted((i or "", *rest) for i, *rest in plain(docs, items))
    assert got(ranked_search(documents(docs), benchmark(items))) == want
    assert got(ranked_search(documents(docs), benchmark(items), block_bytes=40)) == want
    assert got(ranked_search(documents(docs), benchmark(items), k=1)) == sorted((i or "", *rest) for i, *rest in plain(docs, items, 1))


def test_empty_tables(documents, benchmark):
    assert ranked_search(documents([]), benchmark([("a", "b")])).collect() == []
    assert ranked_search(documents([(1, "b")]), benchmark([])).collect() == []


def test_small_leaves_and_many_ties(documents, benchmark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 12)))) for i in range(400)] + [(1000 + i, "w1 w2 w3") for i in range(50)]
    items = [(str(i), " ".join(rng.choice(words, 6))) for i in range(20)] + [("t", "w1 w2 w3")]
    assert got(ranked_search(documents(docs), benchmark(items), leaf=2)) == sorted(plain(docs, items))


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(1)
    base = [np.sort(rng.choice(1_000, 12, replace=False)) for _ in range(100)]
    rows = [base[i % 100] if i < 1_900 else np.sort(rng.choice(1_000, 12, replace=False)) for i in range(2_000)]
    edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term = np.concatenate(rows)
    value = 10**9 + rng.integers(1, 10**8, len(term))
    vectors = Vectors(np.arange(2_000), edges, term, value, np.ones(1_000))
    tree = BallTree(vectors, np.ones(1_000, np.int64), leaf=16)
    item = np.zeros(1_000, bool)
    item[rows[7]] = True
    best = []
    leaves, seen = tree.search(rows[7], best, 10)
    scores = np.add.reduceat(value * item[term], edges[:-1])
    assert sorted(best, reverse=True) == [(int(scores[i]), -int(i)) for i in np.lexsort((np.arange(2_000), -scores))[:10]]
    assert leaves < tree.leaves / 4 and seen < 600


def test_query(spark):
    read = lambda name, key: [(r[key], r.text) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()]
    want = sorted((str(i), *rest) for i, *rest in plain(read("documents", "doc_id"), read("benchmark", "item_id")))
    assert got(op12_ball_tree_search(spark, SMALL)) == want
