"""What must hold at sizes the sample tables do not reach."""

from types import SimpleNamespace

import pytest
from explain import plan
from pyspark.sql import functions as F

from tallyhouse.functions import money
from tallyhouse.operators.ranking import add_ranks
from tallyhouse.plans import datasets, questions
from tallyhouse.plans.registry import QUERIES
from tallyhouse.session import shared_folder, stage, stage_path


def test_totals_pass_ten_to_the_sixteen(spark):
    rows = spark.range(3).select(F.lit("9000000000000000.01").cast("decimal(18,2)").alias("x"))
    assert str(rows.agg(money.total(F.col("x")).alias("t")).first().t) == "27000000000000000.03"


def test_ranks_are_long(spark):
    rows = spark.range(5).select(F.col("id").cast("string").alias("k"), F.col("id").alias("m"), F.lit("g").alias("g"))
    ranked = add_ranks(rows, "m", "k", "place", {"inside": "g"})
    assert dict(ranked.dtypes)["place"] == dict(ranked.dtypes)["inside"] == "bigint"
    assert [(r.k, r.place, r.inside) for r in ranked.orderBy("place").collect()] == [(str(4 - i), i + 1, i + 1) for i in range(5)]


def test_the_shared_folder_never_is_a_machine_local_one():
    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)))

    assert shared_folder(session(**{"spark.checkpoint.dir": "hdfs://x/y", "spark.sql.warehouse.dir": "hdfs://w"})) == "hdfs://x/y"
    assert shared_folder(session(**{"spark.sql.warehouse.dir": "hdfs://w/"})) == "hdfs://w/_stages"
    own = {"spark.sql.warehouse.dir": "file:/home/x/spark-warehouse"}
    assert shared_folder(session(**own, **{"spark.master": "local[4]"})) == "file:/home/x/spark-warehouse/_stages"
    for place in ("file:/home/x/spark-warehouse", "/home/x/spark-warehouse"):
        with pytest.raises(ValueError, match="machine-local"):
            shared_folder(session(**{"spark.sql.warehouse.dir": place, "spark.master": "spark://host:7077"}))


def test_stages_can_be_dropped(spark, tmp_path):
    staged = stage(spark.range(10), "numbers")
    assert staged.count() == 10
    folder = stage_path(spark, "x").rsplit("/", 1)[0]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(path)


def test_filters_of_a_dataset_reach_the_scan(spark, tmp_path):
    QUERIES["gold_sales_detail"](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "detail"))
    detail = spark.read.parquet(str(tmp_path / "detail"))
    for question in (questions.commercial_kpis, questions.hour_revenue, questions.region_category_revenue):
        text = plan(question(datasets.sales_dataset(detail, channels=["E-commerce"])))
        pushed = text[text.index("PushedFilters") :].splitlines()[0]
        assert "EqualTo(channel,ecommerce)" in pushed, pushed


def test_the_detail_reads_the_line_items_once(spark):
    text = QUERIES["gold_sales_detail"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [l_orderkey") == 0  # the cleaned sales are read from their stage

