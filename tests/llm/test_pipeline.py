import brute
import corpus_pipeline

from tallyhouse.llm.toxicity import toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        steps[name] = docs
    ids = {name: {r.doc_id for r in frame.select("doc_id").distinct().collect()} for name, frame in steps.items()}
    assert all(steps[name].columns == columns for name, _ in corpus_pipeline.STAGES[:-1])
    toxic = {r.doc_id for r in toxicity(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")).where("predicted = 1").collect()}
    assert ids["toxicity"] == set(before) - toxic
    parts = brute.near_components([(i, t) for i, t in before.items() if i in ids["toxicity"]], 80)
    assert ids["minhash_near_dedup"] == {i for i, (_, c) in parts.items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [(i, t) for i, t in before.items() if i in ids["minhash_near_dedup"]]
    assert ids["benchmark_decontamination"] == {row[0] for row in brute.contaminated(kept, items) if not row[-1]}
    for r in steps["secret_scans"].collect():
        assert not brute.secret_spans(r.text) and r.n_chars == len(r.text)
        if not brute.secret_spans(before[r.doc_id]) and "[SECRET]" not in r.text:
            assert r.text == before[r.doc_id]
    assert ids["secret_scans"] == ids["packing"] == ids["benchmark_decontamination"]
    run = corpus_pipeline.run(spark, SMALL)
    assert run.count() == steps["packing"].count()


def test_awkward_documents_pass_all_stages(spark, documents, tmp_path):
    docs = documents(brute.awkward())
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0
    none = documents(brute.awkward()).where("false")
    for name, stage in corpus_pipeline.STAGES:
        none_out = stage(spark, none, SMALL)
        assert none_out.count() == 0
        none = none_out if name != "packing" else none


def test_near_duplicates_are_dropped_from_a_similarity_of_four_fifths(spark, documents):
    words = [f"w{i}" for i in range(200)]
    near = words[:60] + ["x"] + words[61:120] + ["y"] + words[121:160] + ["z"] + words[161:195] + ["u", "v", "t"] + words[198:]
    a, b = brute.shingles(" ".join(words)), brute.shingles(" ".join(near))
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    docs = documents([(1, " ".join(words)), (2, " ".join(near)), (None, " ".join(words)), (3, None), (3, None)]).withColumnRenamed("row", "_rejected")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "3", "None"]


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "benchmark_decontamination", "secret_scans", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
