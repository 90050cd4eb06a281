import datetime as dt
from decimal import Decimal as D

import pytest
from explain import optimized, plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tallyhouse.operators.contracts import ColumnSpec, TableContract, conform, frame_columns, is_documented
from tallyhouse.operators.dedup import dedup, dedup_dimension
from tallyhouse.operators.filters import apply_filters, list_argument, range_argument
from tallyhouse.operators.joins import (
    join_many_to_one,
    join_one_to_one,
    label_missing,
    lookup,
    summarise_per_entity,
    unique_on,
)
from tallyhouse.operators.measures import Dataset, Measure, evaluate
from tallyhouse.operators.ranking import add_ranks, global_rank, group_rank, top_k
from tallyhouse.operators.totals import with_total


def rows(df):
    return sorted(tuple(r) for r in df.collect())


COPIES = [("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("b", 1, "z"), (None, 5, "n"), (None, 4, "m")]


@pytest.mark.parametrize("operator", [dedup, dedup_dimension])
def test_dedup_survivor_is_the_first_in_order(spark, operator):
    df = spark.createDataFrame(COPIES, "k string, o int, v string")
    key = lambda r: (r[0] is not None, r)
    expected = sorted([("a", 1, "y"), ("b", 1, "z"), (None, 4, "m")], key=key)
    for ordering in (["o"], []):
        got = operator(df.repartition(4), ["k"], ordering)
        assert got.columns == df.columns
        assert sorted((tuple(r) for r in got.collect()), key=key) == expected


def test_dedup_on_two_keys(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c")], "a int, b int, v string")
    assert rows(dedup(df, ["a", "b"])) == [(1, 1, "a"), (1, 2, "c")]
    assert rows(dedup_dimension(df.select("a"), ["a"])) == [(1,)]


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o", "uuid() AS unused")
    text = plan(dedup(df, ["k"], ["o"]).select("k", "o"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "unused" not in text


def test_lookup_keeps_every_fact_once(spark):
    fact = spark.createDataFrame([("p1", 1), ("p2", 2), ("px", 3), (None, 4)], "p string, n int")
    dim = spark.createDataFrame([("p1", "A", 0), ("p2", "B", 0)], "p string, name string, other int")
    got = label_missing(lookup(fact, dim, "p", ["name"]), {"name": "?"})
    assert sorted((r.n, r.name) for r in got.collect()) == [(1, "A"), (2, "B"), (3, "?"), (4, "?")]


def test_unused_lookup_disappears(spark):
    fact = spark.range(10).selectExpr("cast(id AS string) AS p", "id AS n")
    dim = dedup_dimension(spark.range(10).selectExpr("cast(id AS string) AS p", "id AS x"), ["p"])
    assert "Join" not in optimized(lookup(fact, dim, "p", ["x"]).agg(F.sum("n")))


def test_summarise_per_entity_keeps_entities_without_facts(spark):
    dim = spark.createDataFrame([("c1",), ("c2",)], "c string")
    fact = spark.createDataFrame([("c1", D("1.50")), ("c1", D("2.00")), ("cx", D("9"))], "c string, r decimal(10,2)")
    aggregates = {"n": F.count("r"), "total": F.sum("r"), "first": F.min("r")}
    got = summarise_per_entity(dim, fact, "c", aggregates, zero_fill=["n", "total"])
    assert rows(got) == [("c1", 2, D("3.50"), D("1.50")), ("c2", 0, D("0.00"), None)]


def test_declared_relations_are_checked(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    right = spark.createDataFrame([("a", "x")], "k string, v string")
    assert sorted((r.k, r.n, r.v) for r in join_many_to_one(left, right, "k").collect()) == [
        ("a", 1, "x"),
        ("a", 2, "x"),
        ("b", 3, None),
    ]
    with pytest.raises(PySparkException, match="k is not unique: a"):
        unique_on(left, "k").collect()
    with pytest.raises(PySparkException, match="not unique"):
        join_one_to_one(left, right, "k").collect()
    assert rows(join_one_to_one(left.filter("n <> 2"), right, "k")) == [("a", 1, "x")]


def test_declared_relations_cost_one_exchange_per_side(spark):
    left = spark.range(100).selectExpr("cast(id AS string) AS k", "id AS n", "sha(cast(id AS string)) AS t")
    right = spark.range(100).selectExpr("cast(id AS string) AS k", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join_one_to_one(left, right, "k"))
        assert text.count("Exchange hashpartitioning") == 2 and "Aggregate" not in text
        # a grouped side is partitioned already
        grouped = right.groupBy("k").agg(F.max("v").alias("v"))
        text = plan(join_one_to_one(left, grouped, "k"))
        assert text.count("Exchange hashpartitioning") == 2
        assert join_one_to_one(left, grouped, "k").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_check_of_a_relation_is_not_pruned_and_has_no_column_of_its_own(spark):
    df = spark.createDataFrame([("a", 1, 7), ("a", 2, 8), (None, 3, 9)], "k string, nth_row int, key_hash int")
    assert unique_on(df.filter("k IS NULL"), "k").columns == df.columns
    with pytest.raises(PySparkException, match="k is not unique: a"):
        unique_on(df, "k").agg(F.sum("nth_row")).collect()
    with pytest.raises(PySparkException, match="k is not unique: NULL"):
        unique_on(df.filter("k IS NULL").unionAll(df.filter("k IS NULL")), "k").collect()
    dim = spark.createDataFrame([("a", "x")], "k string, name string")
    assert lookup(df, dim, "k", ["name"]).columns == [*df.columns, "name"]


def plain_ranks(df):
    order = [F.desc("m"), "id"]
    return df.withColumn("r", F.row_number().over(Window.orderBy(*order))).withColumn(
        "g_r", F.row_number().over(Window.partitionBy("g").orderBy(*order))
    )


@pytest.fixture
def many_partitions(spark):
    """Keep Spark from merging the small partitions of a test into one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranks_equal_the_plain_window_with_ties_and_a_hot_group(spark, many_partitions):
    # A third of the rows in one group, and a third of all measures equal.
    df = spark.range(20000).selectExpr(
        "cast(id AS string) AS id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('g', id % 11) END AS g",
        "cast(if(id % 3 = 1, 5, id * 7919 % 1000) AS bigint) AS m",
    )
    got = add_ranks(df, "m", "id", "r", {"g_r": "g"})
    assert got.select("r").distinct().count() == 20000
    assert got.exceptAll(plain_ranks(df)).count() == 0
    assert group_rank(df, "g", "m", "id", "g_r").exceptAll(plain_ranks(df).drop("r")).count() == 0


def test_ranking_never_gathers_the_rows(spark, many_partitions):
    df = spark.range(1000).selectExpr("cast(id AS string) AS id", "id % 5 AS g", "id % 100 AS m")
    ranked = add_ranks(df, "m", "id", "r", {"g_r": "g"})
    # The only single-partition step is the running sum over one row per partition.
    before_single = plan(ranked).split("SinglePartition")
    assert len(before_single) == 2 and "HashAggregate(keys=[sorted_part" in before_single[1].split("\n")[1]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(0, 3))), max_size=40))
def test_ranks_of_any_small_table(spark, many_partitions, data):
    table = [(f"k{i:03}", g, m) for i, (g, m) in enumerate(data)]
    df = spark.createDataFrame(table, "id string, g string, m int")
    got = add_ranks(df, "m", "id", "r", {"g_r": "g"})
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain_ranks(df).collect()), key=key)


def test_global_rank_of_one_partition(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "id string, m int")
    assert rows(global_rank(df, "m", "id", "r")) == [("a", 1, 3), ("b", 3, 1), ("c", 3, 2)]


def test_top_k_limits_before_it_numbers(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 AS m")
    best = top_k(df, [F.desc("m"), "id"], 3, "position")
    assert rows(best) == [(9, 9, 1), (19, 9, 2), (29, 9, 3)]
    text = plan(best)
    assert "TakeOrderedAndProject" in text and "SinglePartition" not in text


def test_filters(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, d), c) for d in (1, 2, 3) for c in "ab"], "d date, c string")
    low, high = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    assert apply_filters(df, {"d": (low, high)}, {"c": ["a"]}).count() == 2
    assert apply_filters(df, {"d": (None, high)}, {"c": []}).count() == 4
    assert apply_filters(df, {"d": (high, None)}, where="c = 'b'").count() == 2
    assert apply_filters(df).count() == 6


@pytest.mark.parametrize("chosen, expected", [([], 4), (["a"], 2), (["z"], 0)])
def test_sql_parameters(spark, chosen, expected):
    df = spark.createDataFrame([(dt.date(2025, 1, d), c) for d in (1, 2, 3) for c in "ab"], "d date, c string")
    args = {"p": range_argument(dt.date(2025, 1, 1), dt.date(2025, 1, 2)), "c": list_argument(chosen)}
    sql = """SELECT count(*) FROM {t} WHERE d BETWEEN :p.min AND :p.max
             AND (size(:c) = 0 OR array_contains(CAST(:c AS ARRAY<STRING>), c))"""
    assert spark.sql(sql, args=args, t=df).first()[0] == expected


def test_columns_named_like_helpers_stay(spark):
    names = ["copy_number", "first_row", "sorted_place", "sorted_part", "place_in_part", "of_part", "rows_before", "rows"]
    df = spark.createDataFrame([("a", 1, *range(8)), ("b", 3, *range(8)), ("b", 2, *range(8))], ["k", "m", *names])
    assert dedup(df, ["k"], ["m"]).columns == dedup_dimension(df, ["k"], ["m"]).columns == df.columns
    assert rows(dedup(df, ["k"], ["m"])) == rows(dedup_dimension(df, ["k"], ["m"])) == [("a", 1, *range(8)), ("b", 2, *range(8))]
    ranked = add_ranks(df.filter("m <> 3"), "m", "k", "place", {"inside": "rows"})
    assert rows(ranked) == [("a", 1, *range(8), 2, 2), ("b", 2, *range(8), 1, 1)]


def test_with_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4), (None, 8)], "k string, n int")
    got = {(r.k, r.n, r.is_total) for r in with_total(df, "k", {"n": F.sum("n")}, "Total").collect()}
    assert got == {("a", 3, False), ("b", 4, False), (None, 8, False), ("Total", 15, True)}
    empty = with_total(df.limit(0), "k", {"n": F.count("n")}, "Total").collect()
    assert [tuple(r) for r in empty] == [("Total", 0, True)]
    text = optimized(with_total(df, "k", {"n": F.sum("n")}, "Total"))
    assert text.count("Aggregate") == 1 and text.count("Expand") == 1


def test_measures(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], "k string, c string, n int")
    measures = [Measure("total", lambda: F.sum("n"), "Sum.", ("n",)), Measure("rows", lambda: F.count("n"), "Rows.")]
    data = Dataset.of(df, measures)
    assert rows(evaluate(data, ["k"], ["total", "rows"])) == [("a", 3, 2), ("b", 4, 1)]
    assert rows(evaluate(data, [], ["total"], selections={"c": ["x"]})) == [(5,)]
    assert rows(evaluate(data, ["k"], ["total"], having="total > 3")) == [("b", 4)]
    assert evaluate(data, ["k"], ["total"], order_by=[F.desc("total")], limit=1).first().k == "b"
    with pytest.raises(KeyError, match="unknown measures"):
        evaluate(data, ["k"], ["nope"])
    with pytest.raises(ValueError, match="non-additive"):
        Dataset.of(df, measures, frozenset({"n"}))


def test_contract(spark):
    contract = TableContract(
        "t",
        "A table.",
        ("k",),
        (ColumnSpec("k", StringType(), "Key."), ColumnSpec("n", LongType(), "Count.", additive=False)),
    )
    df = conform(spark.createDataFrame([(1, "a", True)], "n int, k string, extra boolean"), contract)
    assert df.dtypes == [("k", "string"), ("n", "bigint")]
    assert [f.metadata["comment"] for f in df.schema.fields] == ["Key.", "Count."]
    assert contract.non_additive == {"n"}
    columns = frame_columns(spark, {"t": df, "u": df.withColumn("z", F.lit(1))})
    assert [(r.table_name, r.column_name) for r in columns.filter(~is_documented()).collect()] == [("u", "z")]
    assert {(r.column_name, r.data_type) for r in columns.filter("table_name = 't'").collect()} == {("k", "string"), ("n", "bigint")}
