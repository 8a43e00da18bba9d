import datetime as dt

import pytest
from pyspark.sql import functions as F

from martflow.functions import clean, dates, keys
from martflow.functions.clean import all_of, any_of
from martflow.functions.layout import columns, layout, with_absent, with_sources

from .conftest import rows


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double", bool: "boolean", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column).first()[0]


def test_text_defaults_and_trims(spark):
    assert one(spark, clean.text("a"), a="  x ") == "x"
    assert one(spark, clean.text("a", "EUR"), a=None) == "EUR"
    assert one(spark, clean.first_text("a", "b", fallback="z"), a=None, b=" y") == "y"


def test_unknown_condition_is_false(spark):
    assert one(spark, clean.holds(F.col("a") == "x"), a=None) is False


def test_full_name_has_no_loose_blanks(spark):
    assert one(spark, clean.full_name("a", "b"), a="Ann", b=None) == "Ann"


@pytest.mark.parametrize(
    "country, flag, region",
    [
        ("D ", None, "home"),
        (" ", 1, "home"),
        ("F", 1, "union"),
        ("US", 0, "third"),
        ("XX", None, None),
        (None, 1, None),
    ],
)
def test_trade_region(spark, country, flag, region):
    df = spark.createDataFrame([(country, flag)], "c string, f int")
    column = clean.trade_region("c", "f", ("D", ""), ("home", "union", "third"))
    assert df.select(column).first()[0] == region


def test_rates_of_zero_or_nothing_count_as_one(spark):
    df = spark.createDataFrame([(10.0, 2), (10.0, 0), (10.0, None)], "a double, r int")
    assert [r[0] for r in df.select(clean.per_rate("a", "r")).collect()] == [5.0, 10.0, 10.0]
    home = clean.home_amount(F.lit(2.0), "a", "r", F.lit(None).cast("int"))
    assert [r[0] for r in df.select(home).collect()] == [10.0, 20.0, 20.0]


def test_change_needs_a_previous_value(spark):
    df = spark.createDataFrame([(150.0, 100.0), (1.0, 0.0), (1.0, None), (50.0, -100.0)], "a double, b double")
    assert [r[0] for r in df.select(clean.change_pct("a", "b")).collect()] == [50.0, None, None, 150.0]


def test_code_labels_send_unknown_and_null_to_the_rest(spark):
    df = spark.createDataFrame([("F",), ("B",), ("?",), (None,)], "c string")
    column = clean.code_label("c", {"invoice": ["F", "G"], "order": ["B"]}, "other")
    assert [r[0] for r in df.select(column).collect()] == ["invoice", "order", "other", "other"]


def test_keys_tell_null_from_position(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    safe = [r[0] for r in df.select(keys.surrogate_key(["x", "y", "z"])).collect()]
    old = [r[0] for r in df.select(keys.surrogate_key(["x", "y", "z"], compat=True)).collect()]
    assert safe[0] != safe[1] and old[0] == old[1]
    assert all(len(k) == 36 and k.count("-") == 4 for k in safe + old)


def test_hash_tells_null_empty_and_separator_apart(spark):
    data = [(None, "x"), ("", "x"), ("|", "x"), ("\\N", "x"), ("a|b", "c"), ("a", "b|c"), ("a\\", "p"), ("a", "\\p")]
    df = spark.createDataFrame(data, "x string, y string")
    hashes = {r[0] for r in df.select(keys.row_hash(["x", "y"])).collect()}
    assert len(hashes) == len(data)
    compat = [r[0] for r in df.select(keys.row_hash(["x", "y"], compat=True)).collect()]
    assert compat[0] == compat[1] and compat[4] == compat[5]


def test_periods_compare_the_same_span():
    p = dates.Periods(dt.date(2024, 2, 29))
    assert p.last_year_cut == dt.date(2023, 2, 28)
    assert p.cutoff == dt.date(2021, 1, 1) and p.back(90) == dt.date(2023, 12, 1)
    assert dates.Periods(dt.date(2024, 3, 5), same_span=False).last_year_cut == dt.date(2023, 3, 31)
    assert dates.Periods(dt.date(2024, 3, 5)).last_year_cut == dt.date(2023, 3, 5)


def test_iso_weekday(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert rows(df.select(dates.iso_weekday("d"), dates.date_key("d"))) == [(1, 20240101), (7, 20240107)]


def test_layout_projects_by_rule_and_names_missing_columns(spark):
    fields = layout("""
    name    src     text
    open    flag    is_J
    late    other   zero
    """)
    df = spark.createDataFrame([(" a ", "J"), (None, None)], "src string, flag string")
    with pytest.raises(ValueError, match="other"):
        with_sources(df, fields)
    got = with_sources(with_absent(df, ["other"]), fields).select(*columns(fields))
    assert got.columns == ["name", "open", "late"]
    assert [tuple(r) for r in got.collect()] == [("a", True, 0), ("", False, 0)]


def test_many_conditions_nest_little(spark):
    df = spark.range(3)
    many = [F.col("id") == i for i in range(5, 5000)]
    assert df.where(any_of([*many, F.col("id") == 1])).count() == 1
    assert df.where(all_of([F.col("id") < i for i in range(2, 3000)])).count() == 2
    assert df.where(any_of([])).count() == 0 and df.where(all_of([])).count() == 3
