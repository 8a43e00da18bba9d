"""Documents stored as VARIANT."""

from pyspark.sql import functions as F

from martflow.operators.variants import field, fields, items, parsed, store_documents, with_key_field

from .conftest import rows

DOCUMENTS = [
    (1, '{"k": 7, "name": "a", "deep": {"x": [1, 2]}, "parts": [{"n": 1}, {"n": "one"}, {}]}'),
    (2, '{"k": "no number", "name": "b"}'),
    (3, '{"k": 8, "name": null, "parts": []}'),
    (4, '{"k": oops'),
    (5, "[]"),
    (6, None),
    (7, '{"name": "c"}'),
]


def test_documents_without_a_key_are_left_out(spark, database):
    table = f"{database}.d"
    df = spark.createDataFrame(DOCUMENTS, "id int, raw string")
    for part in ("id < 3", "id >= 3"):
        store_documents(df.where(part), table, "raw", ("k", "k", "bigint"), ["id"])
    stored = spark.read.table(table)
    assert dict(stored.dtypes)["document"] == "variant" and rows(stored, "id", "k") == [(1, 7), (3, 8)]
    wanted = {"name": ("name", "string"), "second": ("deep.x[1]", "int"), "missing": ("none", "string")}
    assert rows(stored.select("id", *fields(wanted))) == [(1, "a", 2, None), (3, None, None, None)]
    parts = items(stored, "parts", ["id"]).select("id", field("n", "int", "item").alias("n"))
    assert rows(parts) == [(1, 1), (1, None), (1, None)]


def test_a_field_is_read_without_parsing(spark, database):
    table = f"{database}.d"
    df = spark.createDataFrame(DOCUMENTS, "id int, raw string")
    store_documents(df, table, "raw", ("k", "k", "bigint"))
    one = spark.read.table(table).select(field("name", "string").alias("name"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "from_json" not in plan
    scan = plan[plan.index("ReadSchema") :]
    assert "k:bigint" not in scan and "document" in scan


def test_text_that_is_no_json_is_null(spark):
    df = spark.createDataFrame(DOCUMENTS, "id int, raw string")
    known = parsed(df, "raw", ["id"]).where(F.col("document").isNotNull())
    assert rows(known, "id") == [(1,), (2,), (3,), (5,), (7,)]


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame(DOCUMENTS, "id int, raw string")
    known = with_key_field(df, "raw", ("k", "k", "bigint"), ["id"])
    assert known.columns == ["id", "k", "document"]
    assert rows(known, "id", "k") == [(1, 7), (3, 8)]
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1
