import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from tallyhouse.functions import bands, calendar, money, text
from tallyhouse.plans import preset as fixed
from tallyhouse.plans.preset import RetailPreset


def values(df, column):
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_display_name_strips_one_leading_honorific(spark):
    df = spark.createDataFrame(
        [("  Dra. ANA maria d'ávila-souza ",), ("dr. zé",), ("Sr.João",), ("Srta. LIA",), ("Ana Dr. Lima",), (None,)],
        "n string",
    )
    assert values(df, text.display_name(F.col("n"), fixed.HONORIFIC)) == [
        "Ana Maria D'ávila-souza",
        "Dr. Zé",
        "Sr.joão",
        "Lia",
        "Ana Dr. Lima",
        None,
    ]


def test_state_lookup_is_null_for_unknown_codes(spark):
    df = spark.createDataFrame([(" sp ",), ("XX",), (None,)], "s string")
    state = text.code(F.col("s"))
    assert values(df, state) == ["SP", "XX", None]
    assert values(df, text.map_lookup(state, fixed.STATE_NAMES)) == ["São Paulo", None, None]
    assert values(df, text.map_lookup(state, fixed.STATE_REGIONS)) == ["Sudeste", None, None]
    assert len(fixed.STATES) == 27


def test_labels(spark):
    df = spark.createDataFrame([(7, True, "b"), (23, False, "z")], "h int, f boolean, c string")
    assert values(df, text.hour_label(F.col("h"))) == ["07h", "23h"]
    assert values(df, text.yes_no(F.col("f"), *fixed.YES_NO)) == ["Sim", "Não"]
    assert values(df, text.ordinal(F.col("c"), ["a", "b"])) == [2, 0]
    assert df.agg(text.joined_set(F.col("c"))).first()[0] == "b, z"


def test_weekday_starts_with_sunday(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 14),), (dt.date(2025, 12, 20),), (None,)], "d date")
    number = calendar.weekday_number(F.col("d"))
    assert values(df, number) == [1, 7, None]
    assert values(df, calendar.weekday_name(number, fixed.WEEKDAYS)) == ["Domingo", "Sábado", None]


def test_happened_before_is_false_when_unknown(spark):
    early, late = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    df = spark.createDataFrame([(early, late), (late, late), (early, None)], "a timestamp, b timestamp")
    assert values(df, calendar.happened_before(F.col("a"), F.col("b"))) == [True, False, False]


def test_timestamp_text(spark):
    df = spark.createDataFrame([("2001-08-01 05:00:00",)], "t string")
    parsed = calendar.parse_timestamp(F.col("t"), fixed.COLLECTED_AT_FORMAT)
    assert values(df, F.date_format(parsed, "yyyy-MM-dd'T'HH")) == ["2001-08-01T05"]


def test_band_edges(spark):
    preset = RetailPreset()
    df = spark.createDataFrame([(D("1000.00"),), (D("1000.01"),), (D("500.00"),), (D("500.01"),)], "p decimal(10,2)")
    banded = bands.band(F.col("p"), preset.price_bands, preset.lowest_price_band)
    assert values(df, banded) == ["MEDIO", "PREMIUM", "BASICO", "MEDIO"]
    df = spark.createDataFrame(
        [(D("22000"),), (D("21999.99"),), (D("17000"),), (D("16999.99"),), (D("0"),)], "r decimal(18,2)"
    )
    segment = bands.band(F.col("r"), preset.segments, preset.lowest_segment, inclusive=True)
    assert values(df, segment) == ["VIP", "TOP_TIER", "TOP_TIER", "REGULAR", "REGULAR"]
    assert preset.vip_limit == "22000"


def test_price_class_looks_at_extremes_first(spark):
    rows = [(11, 8, 9, 10), (7, 8, 9, 10), (10, 8, 9, 10), (8, 8, 9, 10), (9, 8, 9, 10), (5, 5, 5, 5)]
    df = spark.createDataFrame(rows, "o int, lo int, m int, hi int")
    classes = bands.price_class(F.col("o"), F.col("lo"), F.col("m"), F.col("hi"), fixed.PRICE_CLASSES)
    assert values(df, classes) == [
        "MAIS_CARO_QUE_TODOS",
        "MAIS_BARATO_QUE_TODOS",
        "ACIMA_DA_MEDIA",
        "ABAIXO_DA_MEDIA",
        "NA_MEDIA",
        "NA_MEDIA",
    ]


def test_suspect_price_is_decided_in_decimals(spark):
    rows = [("3.09", "5.15"), ("5.43", "9.05"), ("6.18", "10.30"), ("6.17", "10.30"), ("1.00", None)]
    rows = [(D(a), None if b is None else D(b)) for a, b in rows]
    df = spark.createDataFrame(rows, "p decimal(10,2), ours decimal(10,2)")
    assert values(df, money.is_below_share(F.col("p"), F.col("ours"), "0.6")) == [False, False, False, True, False]


def test_means_round_half_up(spark):
    df = spark.createDataFrame([(D("1.01"),), (D("1.02"),)], "r decimal(10,2)")
    assert df.agg(money.mean_money(F.col("r"))).first()[0] == D("1.02")


def test_percent_difference(spark):
    df = spark.createDataFrame([(D("110"), D("100")), (D("90"), D("100")), (D("1"), D("3"))], "a decimal(10,2), b decimal(10,2)")
    assert values(df, money.pct_diff(F.col("a"), F.col("b"))) == [D("10.00"), D("-10.00"), D("-66.67")]


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(D("1.00"), 3), (D("1.00"), 0)], "a decimal(18,2), b bigint")
    assert values(df, money.ratio(F.col("a"), F.col("b"))) == [D("0.333333"), None]


def test_totals_pass_one_hundred_million(spark):
    df = spark.createDataFrame([(D("99999999.99"),)] * 3, "r decimal(10,2)")
    assert df.agg(money.total(F.col("r"))).first()[0] == D("299999999.97")
