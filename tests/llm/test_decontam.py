import brute

from tallyhouse.llm.decontam import contamination

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def key(row):
    return tuple(map(str, row))


def test_sample_equals_brute_force(spark, sample):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    found = contamination(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))
    expected = brute.contaminated(sample, items)
    assert sorted(map(tuple, found.select(COLUMNS).collect()), key=key) == sorted(expected, key=key)
    assert any(row[-1] for row in expected)


def test_awkward_rows_and_blocks(spark, documents):
    rows = brute.awkward()
    base = rows[0][1].split()
    items = [(1, " ".join(base[20:45])), (2, "One  TWO"), (10, "é.à"), (11, None), (None, "one two"), (12, "..."), (1, " ".join(base[40:60])), (13, "none of these words"), (14, " ".join(base[5:12]))]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, row string")
    expected = sorted(brute.contaminated(rows, items), key=key)
    for block in (1 << 24, 60):
        found = contamination(documents(rows), bench, block_bytes=block)
        assert sorted(map(tuple, found.select(COLUMNS).collect()), key=key) == expected


def longest_matches(text, items, window=10):
    """(item, item_start, start, end) of all longest common runs, by comparing every diagonal."""
    a, out = brute.words_by_letter(text), []
    for name, item in items:
        b = brute.words_by_letter(item)
        if name is None or not b:
            continue
        least = min(window, len(b))
        for shift in range(-len(b), len(a) + 1):
            run = 0
            for j in range(len(b) + 1):
                i = j + shift
                if j < len(b) and 0 <= i < len(a) and a[i] == b[j]:
                    run += 1
                    continue
                if run >= least:
                    out.append((str(name), j - run, i - run, i))
                run = 0
    return sorted(set(out))


def test_longest_matches_tell_item_and_place(spark, documents):
    base = [f"w{i}" for i in range(60)]
    items = [("a", " ".join(base[:30])), ("b", " ".join(base[30:])), ("c", " ".join(base[10:25])), ("d", "z z z z"), ("e", "y " * 14)]
    rows = [
        (1, " ".join(["x"] + base + ["x"] + base[5:28])), (2, " ".join(base[20:40])), (3, "z " * 9), (4, "y " * 30), (5, None),
        (6, " ".join(base[:15] + ["x"] + base[16:45])), (7, " ".join(base[:9])),
    ]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id string, text string, edges int")
    for block in (1 << 24, 60):
        for r in contamination(documents(rows), bench, block_bytes=block).collect():
            assert [tuple(m) for m in r.matches] == longest_matches(dict(rows)[r.doc_id], items), r.doc_id


def test_a_shipped_block_is_not_much_larger_than_its_items(spark):
    import pickle

    import pyarrow as pa

    from tallyhouse.llm.decontam import Items

    texts = [" ".join(f"word{(i * 7 + k * 13) % 5000}" for k in range(2_000)) for i in range(100)]
    assert len(pickle.dumps(Items([str(i) for i in range(100)], pa.array(texts), 10))) < 2.5 * sum(map(len, texts))


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in contamination(documents([(1, "a b")]), bench).collect()] == [0]
    assert contamination(documents([(1, "a b")]).where("false"), bench).collect() == []
