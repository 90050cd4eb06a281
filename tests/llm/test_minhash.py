import brute
import numpy as np

from tallyhouse.llm.minhash import near_duplicates, shared_counts
from tallyhouse.llm.queries import QUERIES


def test_sample_equals_brute_force(spark, sample):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op8_circulant_minhash"](spark, "/root/testdata/sf0.001").collect()}
    assert found == brute.near_components(sample)


def test_awkward_rows(documents):
    rows = brute.awkward()
    out = near_duplicates(documents(rows)).collect()
    assert len(out) == len(rows)
    expected = brute.near_components(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_chain_of_near_copies_in_one_bucket(documents):
    # each copy is near its neighbours only: the first pivot cannot link them all
    base, rows = brute.sentence(200, 5), []
    for i in range(60):
        base = base.copy()
        base[(i * 37) % 200] = f"new{i}"
        rows.append((1000 - i, " ".join(base)))
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(rows)).collect()}
    assert out == brute.near_components(rows)


def test_empty_table(documents, spark):
    assert near_duplicates(documents([(1, "x")]).where("false")).collect() == []
    assert near_duplicates(documents([(1, None)])).collect() == [(1, 0, 1, True)]


def test_shared_counts():
    generator = np.random.default_rng(1)
    sets = [np.unique(generator.integers(0, 60, size).astype(np.uint64)) for size in (0, 5, 30, 200, 17, 1)]
    for width in (7, 4096):
        found = shared_counts(sets[:4], sets[2:], width)
        assert found.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[2:]] for a in sets[:4]]
