import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martflow.functions.dates import Periods
from martflow.functions.keys import row_hash
from martflow.functions.layout import missing_columns, with_absent
from martflow.operators.calendar import date_dim
from martflow.operators.crawl import parse_json
from martflow.operators.documents import header_lines
from martflow.operators.scd import END, START
from martflow.plans import churn, dimensions, facts, marketplace
from martflow.plans.facts import FACTS
from martflow.plans.history import DIMENSIONS
from martflow.sources.tables import work_dir

from .conftest import rows

D = dt.datetime


def test_default_calendar(spark):
    dim = date_dim(spark)
    assert dim.count() == 4018 + 1
    got = {r["date_key"]: r for r in dim.where("date_key in (-1, 20200101, 20210101, 20240630)").collect()}
    assert got[-1]["full_date"] is None and got[-1]["day_name"] == "Unknown"
    assert got[20200101]["is_holiday_de"] and not got[20210101]["is_holiday_de"]
    assert got[20210101]["week_iso"] == 53 and got[20210101]["day_of_week"] == 5
    sunday = got[20240630]
    assert sunday["is_weekend"] and sunday["year_quarter"] == "2024-Q2" and sunday["month_name"] == "June"


def test_bad_documents_are_dropped_and_bad_fields_are_null(spark):
    data = [('{"k": 1, "n": 2}',), ('{"k": 1, "n": "x"}',), ("{oops",), ('{"n": 2}',), (None,), ("[]",)]
    df = spark.createDataFrame(data, "raw string")
    got = parse_json(df, "raw", "k BIGINT, n BIGINT", "k").select("j.*")
    assert rows(got) == sorted([(1, 2), (1, None)], key=str)


def test_a_document_is_parsed_once(spark):
    df = spark.range(5).select(F.to_json(F.struct(F.col("id").alias("k"))).alias("raw"))
    plan = parse_json(df, "raw", "k BIGINT", "k").select("j.k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_headers_are_not_fanned_out(spark):
    headers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, h string")
    lines = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (9, 1)], "doc int, pos int")
    columns = ["id", "h", "pos"]
    grain, joined = header_lines(headers, lines, [("id", "doc")], columns)
    assert grain.count() == 3
    assert rows(joined) == [(1, "a", 1), (1, "a", 2), (2, "b", 1), (3, "c", None)]
    grain, joined = header_lines(headers, lines, [("id", "doc")], columns, "inner")
    assert rows(grain, "id") == [(1,), (2,)]
    assert rows(joined) == [(1, "a", 1), (1, "a", 2), (2, "b", 1)]
    with pytest.raises(ValueError):
        header_lines(headers, lines, [("id", "doc")], columns, "right")


def complete(df, fields, prefix=""):
    """The source, with the columns of a layout that it lacks as NULL."""
    return with_absent(df, missing_columns(df, fields, prefix))


def test_product_keys_hold_the_product(spark):
    products = spark.createDataFrame(
        [(1, "N"), (2, "N")], "aridnr int, aranummer string"
    ).withColumns(
        {c: F.lit(None).cast("string") for c in ("arben", "arerwben", "artyp", "arherstnr", "arkzselekt")}
        | {c: F.lit(None).cast("int") for c in ("arauslauf", "arnoaktiv", "arsernr")}
        | {c: F.lit(None).cast("boolean") for c in ("arlagware", "arnuronline", "arkeinprov")}
        | {c: F.lit(None).cast("timestamp") for c in ("areingabe", "updtime")}
    )
    products = complete(products, dimensions.PRODUCT, "a.")
    links = spark.createDataFrame([(1, 2, "B"), (1, 1, "C"), (1, 1, "A")], "kkidnr int, kklfdnr int, kkkat string")
    categories = spark.createDataFrame([("A", "Cat A", None, None)], "kakat string, katext string, kaotext string, kaobkat string")
    makers = spark.createDataFrame([], "kohkenn string, kohtext string")
    staged = dimensions.stage_product(products, links, categories, makers)
    got = {r["nk_product_id"]: r for r in staged.collect()}
    assert got[1]["sk_product_id"] != got[2]["sk_product_id"]
    assert got[1]["category_name"] == "Cat A" and got[2]["manufacturer_name"] == "Unknown"
    old = dimensions.stage_product(products, links, categories, makers, compat=True)
    assert len({r["sk_product_id"] for r in old.collect()}) == 1


def test_stock_does_not_change_the_warehouse_key(spark):
    names = "mlidnr int, mllager string, mlekpreis int, mlekprep int, mlekrein int, mlbestand int, mlmankey int"
    data = [[(1, "W", 1, 1, 1, stock, 1), (2, "W", 1, 1, 1, stock, 0)] for stock in (5, 6)]
    keys = lambda compat: [
        dimensions.stage_warehouse(
            complete(spark.createDataFrame(d, names), dimensions.WAREHOUSE), compat
        ).first()["sk_warehouse_id"]
        for d in data
    ]
    safe, old = keys(False), keys(True)
    assert safe[0] == safe[1] and old[0] != old[1]


def test_facts_and_dimensions_are_complete():
    assert len(DIMENSIONS) == 9 and len(FACTS) == 11
    for fact in FACTS.values():
        assert all(l.dim in DIMENSIONS and l.dim_key in DIMENSIONS[l.dim].keys for l in fact.lookups)


def dim(spark, key, sk, value=1):
    return spark.createDataFrame(
        [(value, f"{sk}-1", D(2020, 1, 1), None)], f"{key} int, {sk} string, {START} timestamp_ntz, {END} timestamp_ntz"
    )


def test_fact_load_is_incremental_and_idempotent(spark, database):
    def serials(data):
        return complete(spark.createDataFrame(data, "seserid int, seidnr int, sehaunr string, sebelid int, seekredat date, sedatum date, sekltyp string, sekdnummer int, seaus boolean, sebeltyp string, sestorno string, setext string, sebea int"), facts.SERIAL_EVENT)

    dims = {
        "dim_product": dim(spark, "nk_product_id", "sk_product_id"),
        "dim_customer": dim(spark, "nk_customer_id", "sk_customer_id"),
        "dim_supplier": dim(spark, "nk_supplier_id", "sk_supplier_id"),
        "dim_salesperson": dim(spark, "nk_salesperson_id", "sk_salesperson_id"),
    }
    day = dt.date(2024, 1, 5)
    first = [
        (1, 1, "h", 7, day, day, "K", 1, True, "F", None, "a", 1),
        (2, 9, "h", 7, day, dt.date(2024, 2, 5), "L", 1, None, "R", "J", "a", 1),
    ]
    second = [first[0], (*first[1][:11], "b", 1), (3, 1, "h", 7, day, day, "?", 1, False, "?", None, "a", None)]
    fact = FACTS["fact_serial_number_event"]
    for load, data in enumerate((first, second, second), 1):
        rows_ = facts.stage_serial_events(serials(data))
        facts.load_fact(spark, database, fact, rows_, dims, F.lit(load))
    got = spark.read.table(f"{database}.{fact.table}")
    shown = ["nk_event_id", "sk_product_id", "sk_customer_id", "sk_supplier_id", "error_text", "document_category", "dw_loaded_at"]
    assert rows(got, *shown) == sorted(
        [
            (1, "sk_product_id-1", "sk_customer_id-1", None, "a", "Sales Invoice", 1),
            (2, None, None, "sk_supplier_id-1", "b", "Supplier Invoice", 2),
            (3, "sk_product_id-1", None, None, "a", "Other", 2),
        ],
        key=str,
    )


def test_marketplace_offers_link_only_own_listings(spark):
    raw = (
        '{"puid": 1, "supplierItems": [{"id": 1, "supplierName": "ME", "supplierSKU": " 1 ", "priceLastUpdate": "bad"},'
        ' {"id": 2, "supplierName": "YOU", "supplierSKU": "1"}, {"id": 3, "supplierSKU": "1"}]}'
    )
    crawl = spark.createDataFrame(
        [(D(2024, 1, 1), "s", raw), (D(2024, 1, 1), "s", '{"puid": 2, "supplierItems": []}')],
        "fetched_at timestamp_ntz, source string, raw_json string",
    )
    products = dim(spark, "nk", "sk_product_id").withColumn("product_number", F.lit("1 "))
    got = marketplace.marketplace_offers(crawl, products, "ME")
    assert rows(got, "supplier_item_id", "is_own_listing", "sk_product_id", "price_last_update") == sorted(
        [(1, True, "sk_product_id-1", None), (2, False, None, None), (3, False, None, None)], key=str
    )


def test_crawl_loads(spark, database):
    def crawl(at, name):
        return spark.createDataFrame(
            [(at, "s", f'{{"puid": 1, "productName": "{name}", "supplierItems": [{{"id": 5}}]}}')],
            "fetched_at timestamp_ntz, source string, raw_json string",
        )

    products = dim(spark, "nk", "sk_product_id").withColumn("product_number", F.lit("1"))
    for at, name in ((D(2024, 1, 1), "a"), (D(2024, 1, 2), "b"), (D(2024, 1, 2), "b")):
        marketplace.load_products(spark, f"{database}.p", crawl(at, name))
        marketplace.load_offers(spark, f"{database}.o", crawl(at, name), products, "ME", dt.date(2024, 1, 1))
    assert rows(spark.read.table(f"{database}.p"), "puid", "product_name") == [(1, "b")]
    assert spark.read.table(f"{database}.o").count() == 2


def test_two_input_scoring(spark, database):
    from martflow.queries import customers

    folder = "/root/testdata/sf0.001"
    invoices, people = customers.invoices(spark, folder), customers.customers(spark, folder)
    periods = Periods(customers.AS_OF)
    matrix = churn.features(invoices, people, periods)
    codes, scaler = churn.fit(matrix)
    base = churn.eligible(invoices, periods)
    scores = churn.score_with(
        matrix,
        churn.sequence_array(base),
        codes,
        scaler,
        churn.fit_sequences(invoices, periods),
        lambda flat, steps: 1 / (1 + abs(flat.sum(axis=1) + steps.sum(axis=(1, 2)))),
        3,
    )
    got = scores.collect()
    assert len(got) == matrix.count() and all(0 <= r["churn_probability"] <= 1 for r in got)
    details = churn.risk_details(scores, people, invoices, periods)
    for _ in range(2):
        churn.load_risk_details(spark, f"{database}.d", details, periods.as_of)
    stored = spark.read.table(f"{database}.d")
    assert stored.count() == len(got) and set(stored.columns) == set(details.columns)
    assert [r["score"] for r in churn.top_risks(stored).collect()] == sorted(
        (r["score"] for r in stored.collect()), reverse=True
    )


def test_a_fact_keeps_its_grain(spark, database):
    spec = facts.Fact("receipts", ("k", "day"), "day", ())
    data = spark.createDataFrame([(1, dt.date(2024, 1, 5), 3)], "k int, day date, v int")
    facts.load_fact(spark, database, spec, data, {}, grain="day")
    facts.load_fact(spark, database, spec, data.withColumn("v", F.lit(4)), {})
    assert rows(spark.read.table(f"{database}.receipts"), "v", "event_period") == [(4, "2024-01-05")]
    with pytest.raises(ValueError, match="by day"):
        facts.load_fact(spark, database, spec, data, {}, grain="month")


def test_the_latest_row_of_a_key_stays(spark, database):
    spec = facts.Fact("prices", ("k",), "at", (), newest="at")
    kind = "k int, at timestamp_ntz, v int"
    at = lambda d, v: (1, dt.datetime(2024, 1, d), v)
    for some in ([at(2, 1), at(5, 2), at(3, 3)], [at(4, 4)]):
        facts.load_fact(spark, database, spec, spark.createDataFrame(some, kind), {})
    assert rows(spark.read.table(f"{database}.prices"), "v") == [(2,)]


def test_wide_lines_are_not_sorted_for_their_headers(spark):
    headers = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, h string")
    lines = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "doc int, pos int")
    _, joined = header_lines(headers, lines, [("id", "doc")], ["id", "h", "pos"], "inner")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(joined) == [(1, "a", 1), (1, "a", 2), (1, "b", 1), (1, "b", 2)]


def test_a_hash_before_the_lookups_gives_the_same_fact(spark):
    made = D(2024, 1, 5)
    lines = [(1, 2, p, n, made, i) for i, (p, n) in enumerate([(1, 7), (1, 7), (1, 8), (2, None), (2, None)])]
    staged = spark.createDataFrame(
        lines, "nk_document_id int, nk_document_no int, position_seq_no int, nk_product_id int, "
        "invoice_date timestamp_ntz, quantity int"
    )
    versions = [(7, "s7", D(2024, 1, 1), None), (8, "s8", D(2024, 2, 1), None)]
    kind = f"nk_product_id int, sk_product_id string, {START} timestamp_ntz, {END} timestamp_ntz"
    dims = {"dim_product": spark.createDataFrame(versions, kind)}
    fact, moment = FACTS["fact_sales_invoice_lines"], F.lit(1)
    late = facts.build_fact(fact, staged, dims, moment)
    early = facts.build_fact(fact, staged, dims, moment, hash_first=True)
    assert early.columns == late.columns and rows(early) == rows(late) and late.count() == 3
    plan = early.select("quantity", "row_hash")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("md5")


def test_only_the_latest_crawls_are_hashed(spark):
    data = [(D(2024, 1, d), f'{{"puid": 1, "productName": "{n}"}}') for d, n in ((1, "a"), (2, "b"), (2, "c"), (2, "b"))]
    data += [(None, '{"puid": 2, "productName": "d"}'), (None, "{oops")]
    crawl = spark.createDataFrame(data, "fetched_at timestamp_ntz, raw_json string")
    got = marketplace.marketplace_products(crawl)
    everything = spark.createDataFrame([("b",), ("c",)], "product_name string").withColumns(
        {c: F.lit(None).cast(got.schema[c].dataType) for c in got.columns if c not in ("product_name", "row_hash")}
    )
    compared = [f.name for f in marketplace.PRODUCT if f.name != "puid"]
    smallest = everything.select("product_name", row_hash(compared).alias("h")).orderBy("h").first()["product_name"]
    assert rows(got, "puid", "product_name", "fetched_at") == [(1, smallest, D(2024, 1, 2)), (2, "d", None)]
    plan = got.select("puid", "row_hash")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5(") < plan.index("rank(fetched_at")


@pytest.mark.parametrize("name, copies_made", [("fact_purchase_order_header", 2), ("fact_sales_order_header", 1)])
def test_a_later_load_reads_its_source_in_place(spark, database, name, copies_made):
    spec = FACTS[name]
    dims = {l.dim: dim(spark, l.dim_key, l.take) for l in spec.lookups}
    names = dict.fromkeys([*[c for c in spec.keys if not c.startswith("sk_")], spec.event])
    kinds = {c: "timestamp_ntz" if c.endswith("date") else "string" for c in names}

    def header(key, day, amount):
        values = [key if kinds[c] == "string" else D(2024, *day) if c == spec.event else None for c in names]
        return (*values, *[1 for _ in spec.drop], amount)

    schema = ", ".join([*[f"{c} {k}" for c, k in kinds.items()], *[f"{c} int" for c in spec.drop], "amount int"])
    load = lambda *data: facts.load_fact(spark, database, spec, spark.createDataFrame(list(data), schema), dims, F.lit(0))
    load(header("a", (1, 5), 1), header("b", (2, 5), 1), header(None, (1, 6), 1))
    copies = set(Path(work_dir(spark)).glob("stage-*"))
    load(header("a", (1, 5), 2), header("c", (1, 5), 3), header("c", (1, 5), 3), header(None, (1, 6), 4))
    made = set(Path(work_dir(spark)).glob("stage-*")) - copies
    wide = [p for p in made if "amount" in spark.read.parquet(str(p)).columns]
    # The merged rows, and the source before them only where an index needs its keys.
    assert len(wide) == copies_made
    got = spark.read.table(f"{database}.{spec.table}")
    assert rows(got, "nk_document_id", "amount") == sorted([("a", 2), ("b", 1), ("c", 3), (None, 4)], key=str)
    assert got.columns[-3:] == ["row_hash", "dw_loaded_at", "event_period"]


def test_prices_are_shuffled_by_product_once(spark):
    def source(data, kind, alias):
        fields = [f for f in (*facts.PRODUCT_PRICE, *facts.PRICE_TIERS) if f.source.startswith(f"{alias}.")]
        return complete(spark.createDataFrame(data, kind), [f._replace(source=f.source[len(alias) + 1:]) for f in fields])

    at = D(2024, 1, 5)
    data = [(1, 1, "EUR", 10), (1, 2, "EUR", 10), (1, 1, "USD", 11), (1, None, "EUR", 10), (1, 1, None, 12),
            (None, 1, "EUR", 10), (2, 1, "EUR", None), (3, 1, "EUR", 10)]
    prices = source([(*r, at) for r in data], "anidnr int, anmankey int, anwaehrung string, anpid int, updtime timestamp_ntz", "p")
    parameters = source(
        [(1, 1, "EUR", 5), (1, 2, "EUR", 6), (1, 1, None, 7), (1, None, "EUR", 8), (None, 1, "EUR", 9), (2, 1, "EUR", 4), (2, 1, "EUR", 3)],
        "awidnr int, awmankey int, awwaehrung string, awempfvk int", "w",
    )
    groups = source([(10, 1, "ten"), (10, 2, "two"), (None, 1, "none"), (12, 1, "twelve")], "aapid int, aamankey int, aapbez string", "vp")
    fact = FACTS["fact_product_prices"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = facts.stage_product_prices(prices, parameters, groups)
        found = facts.look_up(fact, staged, {"dim_product": dim(spark, "nk_product_id", "sk_product_id")})
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # prices and groups by group; those, parameters and products by product
    assert plan.count("Exchange hashpartitioning") == 5
    key = "sk_product_id-1"
    want = [(key, "EUR", 10, "ten", 5), (key, "EUR", 10, "two", 6), (key, "USD", 11, "", None), (key, "EUR", 10, "", None),
            (key, "EUR", 12, "twelve", None), (None, "EUR", 10, "ten", None), (None, "EUR", None, "", 4), (None, "EUR", None, "", 3),
            (None, "EUR", 10, "ten", None)]
    assert rows(found, "sk_product_id", "currency", "price_id", "price_label", "recommended_price") == sorted(want, key=str)


def test_wide_lines_are_shuffled_once_for_their_fact(spark):
    fact = FACTS["fact_supplier_invoice_lines"]
    made = D(2024, 1, 5)
    headers = spark.createDataFrame([(1, made), (1, D(2024, 3, 1)), (2, made), (-1, made), (None, made), (4, made)], "id long, at timestamp_ntz")
    data = [(1, 1, 7, 5), (1, 1, 7, 5), (1, 1, 7, 6), (1, 2, 9, 5), (1, 2, None, 4), (2, 1, 8, 3), (-1, 1, 7, 2), (None, 1, 7, 1), (9, 1, 7, 1)]
    lines = spark.createDataFrame(data, "doc long, pos int, product int, quantity int")
    columns = [
        F.col("id").alias("nk_document_id"), F.lit(0).alias("nk_document_no"), F.col("pos").alias("nk_line_id"),
        F.col("product").alias("nk_product_id"), F.col("at").cast("date").alias("invoice_date"), "quantity",
    ]
    # Product 7 has two versions that overlap, 8 none that is valid.
    versions = [(7, "a", D(2024, 1, 1), D(2024, 2, 1)), (7, "b", D(2024, 1, 2), None), (8, "c", D(2024, 2, 1), None)]
    kind = f"nk_product_id int, sk_product_id string, {START} timestamp_ntz, {END} timestamp_ntz"
    dims = {"dim_product": spark.createDataFrame(versions, kind)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, staged = header_lines(headers, lines, [("id", "doc")], columns)
        built = facts.build_fact(fact, staged, dims, F.lit(0))
        plan = built._jdf.queryExecution().executedPlan().toString()
        plain = facts.build_fact(replace(fact, near=()), staged, dims, F.lit(0))
        assert built.columns == plain.columns and rows(built) == rows(plain)
        found, wanted = (facts.look_up(f, staged, dims) for f in (fact, replace(fact, near=())))
        assert found.columns == wanted.columns and rows(found) == rows(wanted) and found.count() == 18
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The window of the versions and the one of the keys take the lines as their headers found them.
    assert plan.count("Window [") == 2 and "Exchange" not in plan[: plan.index("Union")]


def test_a_document_fact_with_several_lookups(spark):
    fact = replace(FACTS["fact_serial_number_event"], near=("nk_event_id", "event_date"))
    at = D(2024, 1, 5)
    data = [(1, 7, "K", 7, 7, at), (1, 7, "L", 7, None, at), (None, None, None, None, None, at), (None, 8, "K", 9, 7, at), (2, 7, "K", 7, 7, None)]
    events = spark.createDataFrame(
        data, "nk_event_id int, nk_product_id int, party_type_code string, nk_party_id int, "
        "nk_responsible_employee_id int, event_date timestamp_ntz"
    ).union(spark.createDataFrame(data[:1], "a int, b int, c string, d int, e int, f timestamp_ntz"))
    dims = {l.dim: dim(spark, l.dim_key, l.take, 7) for l in fact.lookups}
    found, wanted = (facts.look_up(f, events, dims) for f in (fact, replace(fact, near=())))
    assert found.columns == wanted.columns and rows(found) == rows(wanted) and found.count() == 6
