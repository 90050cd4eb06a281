import math
import random
import re
import time
import zlib

import brute
import numpy as np
import pyarrow as pa

from tallyhouse.llm.toxicity import CEILING, DRIFT, FLOOR, LETTERS, PREFIXES, PRIOR, Model, _fit, learn, maximal_segments, token_scores, toxicity
from tallyhouse.llm.words import words

FOLDER = "/root/testdata/sf0.1"


def brute_segments(scores):
    """All maximal segments by their definition: take the best (shortest, leftmost) one, go on left and right of it."""
    if not any(s > 0 for s in scores):
        return []
    best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    a = -best[2]
    b = a - best[1]
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return [*brute_segments(scores[:a]), (a, b, best[0]), *right]


def test_segments_equal_the_definition():
    generator = random.Random(4)
    for _ in range(300):
        scores = [generator.choice([-3, -2, -1, 1, 2, 4]) + generator.random() / 100 for _ in range(generator.randrange(12))]
        found = [(a, b, round(s, 6)) for a, b, s in maximal_segments(np.array(scores))]
        assert found == [(a, b, round(s, 6)) for a, b, s in brute_segments(scores)]


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = toxicity(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert all((s >= 0.7) == (p == 1) and 0 <= s <= 1 for s, p, _ in held)
    toxic, clean = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    order = np.argsort(np.argsort([*toxic, *clean]))
    area = (order[: len(toxic)].sum() - len(toxic) * (len(toxic) - 1) / 2) / (len(toxic) * len(clean))
    hits, alarms = sum(p for _, p, y in held if y), sum(p for _, p, y in held if not y)
    print("area", area, "recall", hits / len(toxic), "precision", hits / max(1, hits + alarms))
    assert area > 0.95 and hits >= 0.9 * len(toxic) and alarms < 0.01 * len(clean)


def test_awkward_rows(spark, documents):
    rows = brute.awkward() + [(1000 + i, f"fine words here {i} you total idiot {i}" if i % 2 else f"fine words here number {i} and more") for i in range(200)]
    labels = spark.createDataFrame([(1000 + i, None if i == 3 else i % 2, 0) for i in range(150)] + [(None, 1, 0), (1001, 0, 0)], "doc_id long, toxic int, quality int")
    out = toxicity(documents(rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    late = {r.doc_id: r.predicted for r in out if r.doc_id is not None and r.doc_id >= 1150}
    assert all(late[1000 + i] == i % 2 for i in range(150, 200))
    assert toxicity(documents(rows).where("false"), labels).collect() == []
    assert all(r.predicted == 0 for r in toxicity(documents(rows), labels.where("false")).collect())


def test_segment_search_is_linear():
    generator = np.random.default_rng(0)
    for drift in (-0.3, 0.0, 0.3):
        scores = generator.normal(drift, 1, 100_000)
        start = time.time()
        assert maximal_segments(scores)
        assert time.time() - start < 3
    start = time.time()
    maximal_segments(np.where(np.arange(80_000) % 2 == 0, 1.0, -1.5 - np.arange(80_000) / 1e5))
    assert time.time() - start < 3


def tokens_of(text):
    out = []
    for word in re.findall(r"[A-Za-z0-9'\x80-\U0010ffff]+", text):
        word = word.translate({c: c + 32 for c in range(65, 91)}).encode()
        out.append([*((k, word[:length]) for k, length in enumerate(PREFIXES)), (len(PREFIXES), word)])
    return out


def test_scores_equal_a_plain_model(spark):
    generator = random.Random(2)
    stems = ["idiot", "moron", "fine", "table", "window", "dumbhead", "été", "it's", "a", "green42"]
    rows = []
    for i in range(120):
        toxic = i % 3 == 0
        chosen = generator.choices(stems, weights=[5, 4, 1, 1, 1, 3, 1, 1, 1, 1] if toxic else [1, 0, 5, 5, 5, 0, 2, 2, 3, 2], k=generator.randrange(12))
        rows.append((" ".join(w + generator.choice(["", "s", "ly", "s"]) for w in chosen), int(toxic)))
    model = _fit(spark.createDataFrame(rows, "text string, toxic int").repartition(5))
    seen = {}
    for text, toxic in rows:
        for token in {t for levels in tokens_of(text) for t in levels}:
            seen.setdefault(token, [0, 0])[1 - toxic] += 1
    t, c = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    assert model.documents.tolist() == [t, c] and len(model.key) == sum(sum(n) > 1 for n in seen.values())
    for own in (None, 1):
        for text, toxic in [*rows[:30], ("unseen idiot idiots moron Moron idiot", 1)]:
            expected, before = [], []
            for levels in tokens_of(text):
                share = t / (t + c)
                for token in levels:
                    a, b = seen.get(token, (0, 0))
                    a, b = (a, b) if a + b > 1 else (0, 0)
                    if own is not None:
                        a, b = max(a - toxic, 0), max(b - (1 - toxic), 0)
                    share = (a + PRIOR * share) / (a + b + PRIOR)
                score = min(max(math.log(share / (1 - share)) - math.log(t / c) - DRIFT, FLOOR), CEILING)
                word = levels[-1][1]
                expected.append(score / (1 + before.count(word)) if score > 0 else score)
                before.append(word)
            got = token_scores(model, words(pa.array([text]), LETTERS), None if own is None else np.array([toxic]))
            assert np.allclose(got, expected), text


def test_every_significant_passage_is_told(spark, documents):
    insult = "you stupid idiot moron shut up"
    rows = [(i, f"fine words about number {i} " * 20 + (f"{insult} " * 3 if i % 2 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    calm = " ".join("fine words about number 7".split() * 30)
    rows += [(1000, f"idiot moron {calm} {insult} {insult} {insult} {calm} {insult} {insult} {insult} {calm}")]
    out = {r.doc_id: r for r in toxicity(documents(rows), labels).collect()}
    spans = [tuple(map(int, s.split(":"))) for s in out[1000].spans.split(",") if s]
    text = rows[-1][1].split()
    places = [i for i in range(len(text)) if text[i : i + 18] == insult.split() * 3]
    assert len(places) == 2 and all(any(a <= p + 8 < b for a, b in spans) for p in places), spans
    assert out[1000].predicted == 1


def test_a_bounded_sample_is_taken_where_labels_are_many(spark, documents, monkeypatch):
    from tallyhouse.llm import toxicity as module

    rows = [(i, f"fine words {i} here" if i % 2 else f"total idiot {i} moron") for i in range(600)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(600)], "doc_id long, toxic int")
    whole = learn(documents(rows), labels).model.value
    monkeypatch.setattr(module, "LABELLED_BYTES", 4_000)
    less = learn(documents(rows), labels).model.value
    assert isinstance(less, Model) and 0 < less.documents.sum() < 0.7 * whole.documents.sum()
