"""Fact tables on ERP documents derived from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.layout import names
from ..operators.control import advance_table
from ..operators.upsert import upsert
from ..plans import facts
from ..plans.facts import FACTS, build_fact, run_document, run_fact
from ..sources.tables import new_database
from . import erp
from .base import ORACLES, QUERIES, Derived, layout_sql, query

WATERMARK = dt.date(1996, 3, 1)
LOADED = dt.datetime(2024, 1, 1)
CONTROL = "table_name STRING, column_name STRING, date_control DATE, previous_days INT"

# A position number that is unique within its document.
_POSITION = "((l_partkey * 100000 + l_suppkey) * 10 + l_linenumber) * 100 + CAST(l_quantity AS BIGINT)"

SALES_HEADERS = Derived("""
SELECT o_orderkey AS bsbelid, o_orderkey + 5000 AS bsbelnr, o_custkey AS bskundennr, o_custkey % 37 AS bsbeakz,
  o_custkey % 40 AS bszb, o_custkey % 30 AS bsvartnr, CAST(NULL AS BIGINT) AS bsubelnr, 'B' AS bsubeltyp,
  CASE WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 1 END AS bsmankey,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 7 ELSE 0 END AS bsstbear,
  o_orderdate AS bsdatum, o_orderdate AS bsedatum, CAST(NULL AS TIMESTAMP) AS bsudatum,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 3 DAY END AS bsliefdat,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 20 DAY END AS bszahldat,
  CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'G' ELSE 'M' END AS bsbeltyp,
  substr(o_orderpriority, 1, 1) AS bsgara, 'AB' AS bsbelkz, 0 AS bssammstat, 1 AS bsstatkz,
  CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 2 END AS bsukurs,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS bsonline,
  CASE WHEN o_orderstatus = 'O' THEN 'O' ELSE ' ' END AS bsoffen, CASE WHEN o_orderstatus = 'F' THEN ' prj' END AS bsprojekt,
  CAST(o_totalprice AS DECIMAL(18,2)) AS bsvkpreis, CAST(o_totalprice AS DECIMAL(18,2)) AS bsbrutto,
  CAST(o_totalprice AS DECIMAL(18,2)) AS bsekpreis, CAST(o_totalprice AS DECIMAL(18,2)) AS bsekpreis2,
  CAST(1 AS DECIMAL(18,2)) AS bsgema, CAST(2 AS DECIMAL(18,2)) AS bskoop, CAST(9 AS DECIMAL(18,2)) AS bsversend,
  CAST(3 AS DECIMAL(18,2)) AS bsverpack, CAST(4 AS DECIMAL(18,2)) AS bsmaut, CAST(5 AS DECIMAL(18,2)) AS bsintkostv
FROM {orders}
""").wide((facts.SALES_INVOICE_HEADER, "h."), (facts.SALES_ORDER_HEADER, "h."), (facts.SALES_INVOICE_LINES, "h."), (facts.SALES_ORDER_LINES, "h."))

SALES_LINES = Derived(f"""
SELECT l_orderkey AS bpbelid, {_POSITION} AS bpposnr, l_partkey AS bpidnr, concat(' ', l_returnflag) AS bplager,
  1 AS bpmankey, CASE l_linestatus WHEN 'F' THEN ' ' WHEN 'O' THEN 'X' END AS bpstorno,
  CAST(l_quantity AS DECIMAL(18,2)) AS bpstueck, CAST(l_extendedprice AS DECIMAL(18,2)) AS bpvkpreis,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS bpvkbrutt, CAST(l_discount AS DECIMAL(18,2)) AS bprabatt,
  CAST(l_tax AS DECIMAL(18,2)) AS bpekpreis, l_linenumber AS bpmwst, 'EUR' AS bpwaehrung,
  CASE WHEN l_returnflag <> 'A' THEN 2 END AS bpukurs, CAST(NULL AS INT) AS bpueinh, l_shipdate AS bptermin
FROM {{lineitem}}
""").wide((facts.SALES_INVOICE_LINES, "p."), (facts.SALES_ORDER_LINES, "p."))

SALES_EXTRAS = Derived(f"""
SELECT l_orderkey AS k2pbelid, {_POSITION} AS k2pposnr, concat(' Smart', l_linestatus, ' ') AS k2pfrei1
FROM {{lineitem}} WHERE l_returnflag <> 'R'
""")

PURCHASE_HEADERS = Derived("""
SELECT o_orderkey AS lbbelid, o_orderkey + 7000 AS lbbelnr, 'E' AS lbbeltyp, o_orderstatus AS lbstatkz,
  o_custkey % 113 AS lbliefnr, o_custkey % 41 AS lbbeakz, o_orderdate AS lbdatum, o_orderdate AS lbedatum,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS lbudatum, CAST(o_totalprice AS DECIMAL(18,2)) AS lbbetrag,
  'USD' AS lbwaehrung, 2 AS lbukurs, 1 AS lbueinh, o_orderpriority AS lbtext
FROM {orders}
""").wide((facts.PURCHASE_ORDER_HEADER, "h."), (facts.PURCHASE_ORDER_LINES, "h."))

PURCHASE_LINES = Derived(f"""
SELECT {_POSITION} AS xsatzid, l_orderkey AS lpbelid, {_POSITION} AS lpposnr, l_partkey AS lpidnr,
  CASE WHEN l_returnflag <> 'A' THEN concat(' ', l_returnflag) END AS lplager, l_shipdate AS lptermin,
  CAST(l_quantity AS DECIMAL(18,2)) AS lpstueck, CAST(l_extendedprice AS DECIMAL(18,2)) AS lpekpreis,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 END AS lpukurs,
  CASE l_linestatus WHEN 'F' THEN 10 END AS lpueinh, CASE WHEN l_linenumber > 2 THEN l_linenumber END AS lpaufschl1
FROM {{lineitem}}
""").wide((facts.PURCHASE_ORDER_LINES, "p."))

SUPPLIER_HEADERS = Derived("""
SELECT o_orderkey AS lrbelid, o_orderkey + 9000 AS lrbelegnr, 'R' AS lrbelegtyp, o_custkey % 113 AS lrliefnr,
  o_custkey % 41 AS lrbeakz, o_orderdate AS lrdatum, o_orderdate AS lreingabe,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS lrbrutto,
  CASE WHEN o_orderstatus = 'O' THEN 'J' ELSE 'N' END AS lroffen,
  CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 0 END END AS lrstbear,
  CASE WHEN o_orderstatus = 'P' THEN ' CHF' END AS lrwaehrung, CAST(NULL AS INT) AS lrukurs, o_orderpriority AS lrtext
FROM {orders}
""").wide((facts.SUPPLIER_INVOICE_HEADER, "h."), (facts.SUPPLIER_INVOICE_LINES, "h."))

SUPPLIER_LINES = Derived(f"""
SELECT {_POSITION} AS xsatzid, l_orderkey AS lrwbelid, {_POSITION} AS lrwposnr, l_partkey AS lrwidnr,
  l_suppkey AS lrwbelnr, ' W' AS lrwbeltyp, CASE WHEN l_linenumber > 3 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS lrwstueck,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS lrwlfpreis
FROM {{lineitem}}
""").wide((facts.SUPPLIER_INVOICE_LINES, "p."))

RECEIPTS = Derived(f"""
SELECT {_POSITION} AS lpid, l_orderkey AS lpbelid, l_orderkey + 1 AS lpbelnr, {_POSITION} AS lpposnr,
  l_suppkey AS lpliefnr, l_partkey AS lpidnr, concat(l_returnflag, ' ') AS lplager, l_shipdate AS lpdatum,
  CASE WHEN l_linenumber > 1 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS lpmgist,
  CASE l_linestatus WHEN 'F' THEN l_returnflag = 'R' END AS lpdefekt, CAST(NULL AS INT) AS lpgarmon
FROM {{lineitem}}
""").wide((facts.GOODS_RECEIPT, ""))

PRICES = Derived("""
SELECT l_partkey AS anidnr, 1 AS anmankey, l_linestatus AS anwaehrung,
  (l_orderkey * 100000 + l_suppkey) * 10 + l_linenumber AS anpid,
  CASE WHEN l_linenumber > 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS anvkpreis,
  l_linenumber - 3 AS anprnull, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS anvkstne2,
  l_tax AS anvkstbr2, l_shipdate + INTERVAL 6 HOUR AS updtime
FROM {lineitem}
""").wide((facts.PRODUCT_PRICE, "p."), (facts.PRICE_TIERS, "p."))

PRICE_PARAMETERS = Derived("""
SELECT l_partkey AS awidnr, 1 AS awmankey, l_linestatus AS awwaehrung, max(l_extendedprice) AS awempfvk,
  max(l_quantity) AS awvkstaf3
FROM {lineitem} WHERE l_returnflag <> 'N' GROUP BY l_partkey, l_linestatus
""").wide((facts.PRODUCT_PRICE, "w."), (facts.PRICE_TIERS, "w."))

PRICE_GROUPS = Derived("""
SELECT (l_orderkey * 100000 + l_suppkey) * 10 + l_linenumber AS aapid, 1 AS aamankey,
  max(concat(' Group ', l_returnflag)) AS aapbez, CAST(NULL AS BOOLEAN) AS aapbrucalc
FROM {lineitem} GROUP BY 1
""").wide((facts.PRODUCT_PRICE, "vp."))

SERIALS = Derived("""
SELECT event_id AS seserid, user_id AS seidnr, ' W1' AS selager, concat('S', event_id) AS sesernr,
  concat('H', user_id) AS sehaunr, 1 AS seserac, CASE WHEN event_type <> 'view' THEN event_type = 'purchase' END AS seaus,
  CASE event_type WHEN 'purchase' THEN 'K' WHEN 'click' THEN 'L' WHEN 'view' THEN NULL ELSE ' ' END AS sekltyp,
  user_id AS sekdnummer, event_id + 1 AS sebelid,
  CASE event_type WHEN 'purchase' THEN 'F' WHEN 'click' THEN 'R' WHEN 'view' THEN 'A' WHEN 'error' THEN 'W' ELSE 'E' END
    AS sebeltyp,
  ts AS sedatum, ts AS seekredat, CASE event_type WHEN 'error' THEN 'J' END AS sestorno, user_id % 29 AS sebea,
  props AS setext
FROM {events}
""").wide((facts.SERIAL_EVENT, ""))


def _dims(spark, sf_dir, *wanted: str) -> dict[str, DataFrame]:
    return {f"dim_{n}": erp.history(spark, sf_dir, f"dim_{n}") for n in wanted}


def _built(fact: str, rows: DataFrame, dims: dict[str, DataFrame], shown: str) -> DataFrame:
    moment = F.lit(LOADED).cast("timestamp_ntz")
    return build_fact(FACTS[fact], rows, dims, moment, hash_first=True).select(*shown.split())


def _lookup(
    dim: str, alias: str, key: str, day: str, nk: str, precision: str = "date", only: str = "true"
) -> str:
    kind, end = {
        "date": ("DATE", "DATE '2099-12-31'"),
        "timestamp": ("TIMESTAMP", "TIMESTAMP '2099-12-31 00:00:00'"),
    }[precision]
    return f"""LEFT JOIN ({erp.history_sql("dim_" + dim)}) {alias} ON {only} AND {key} = {alias}.{nk}
  AND CAST({day} AS {kind}) >= CAST({alias}.__START_AT AS {kind})
  AND CAST({day} AS {kind}) < coalesce(CAST({alias}.__END_AT AS {kind}), {end})"""


def _customer_sql(key: str, day: str) -> str:
    return _lookup("customer", "c", key, day, "nk_customer_id")


def _person_sql(key: str, day: str, precision: str = "date") -> str:
    return _lookup("salesperson", "s", key, day, "nk_salesperson_id", precision)


def _supplier_sql(key: str, day: str, precision: str) -> str:
    return _lookup("supplier", "sp", key, day, "nk_supplier_id", precision)


def _product_sql(key: str, day: str, precision: str) -> str:
    return _lookup("product", "p", key, day, "nk_product_id", precision)


_SINCE = f"DATE '{WATERMARK}'"
_OPEN = f"bsmankey = 1 AND bsstbear = 0 AND bsdatum >= {_SINCE}"


def _day(expression: str, name: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS VARCHAR) AS {name}"


_NET = "round(CAST(bsvkpreis AS DOUBLE) / CASE WHEN bsukurs <> 0 THEN bsukurs ELSE 1 END, 4) AS revenue"


def _sales_invoice(spark, sf_dir):
    return facts.stage_sales_invoice(
        SALES_HEADERS.frame(spark, sf_dir),
        SALES_LINES.frame(spark, sf_dir),
        SALES_EXTRAS.frame(spark, sf_dir),
        WATERMARK,
    )


@query(f"""
SELECT bsbelid AS nk_document_id, bsbelnr AS nk_document_no, c.sk_customer_id, s.sk_salesperson_id,
  {_day("bsdatum", "invoice_date")}, {_day("bsedatum", "document_creation_date")},
  {_day("bsliefdat", "delivery_date")}, bsbeltyp AS document_type_code, bsgara AS document_category_code,
  lower(bsbelkz) AS reference_document_indicator, CAST(bssammstat AS VARCHAR) AS collection_status_code,
  coalesce(bsonline, false) AS is_online, bsbeltyp = 'G' AS is_credit_note, bsoffen = 'O' AS is_open,
  date_diff('day', CAST(bsdatum AS DATE), CAST(bszahldat AS DATE)) AS days_to_pay,
  trim(coalesce(bsprojekt, '')) AS project_code, {_NET},
  CAST(bsekpreis2 + bsgema + bskoop AS DOUBLE) AS cost_amount,
  CAST(bsversend + bsverpack + bsmaut - bsintkostv AS DOUBLE) AS shipping_amount
FROM ({SALES_HEADERS.sql}) h {_customer_sql("bskundennr", "bsdatum")} {_person_sql("bsbeakz", "bsdatum")}
WHERE {_OPEN}
""")
def fact_sales_invoice_header(spark, sf_dir):
    header, _ = _sales_invoice(spark, sf_dir)
    built = _built(
        "fact_sales_invoice_header",
        header,
        _dims(spark, sf_dir, "customer", "salesperson"),
        """nk_document_id nk_document_no sk_customer_id sk_salesperson_id invoice_date document_creation_date
        delivery_date document_type_code document_category_code reference_document_indicator
        collection_status_code is_online is_credit_note is_open days_to_pay project_code revenue cost_amount
        shipping_amount""",
    )
    return built.withColumn("revenue", F.round("revenue", 4))


@query(f"""
SELECT bsbelid AS nk_document_id, bsbelnr AS nk_document_no, bpposnr AS position_seq_no, p.sk_product_id,
  {_day("bsdatum", "invoice_date")}, trim(coalesce(bplager, '')) AS warehouse, coalesce(bpstorno <> ' ', false) AS is_cancellation,
  CAST(bpstueck AS DOUBLE) AS quantity, CAST(bprabatt AS DOUBLE) AS discount_pct,
  CAST(bpstueck * bpvkpreis AS DOUBLE) AS line_net_amount, CAST(bpstueck * bpekpreis AS DOUBLE) AS line_purchase_amount,
  lower(trim(k2pfrei1)) AS business_channel
FROM ({SALES_HEADERS.sql}) h LEFT JOIN ({SALES_LINES.sql}) l ON bsbelid = bpbelid
LEFT JOIN ({SALES_EXTRAS.sql}) x ON bsbelid = k2pbelid AND k2pposnr = bpposnr
{_product_sql("bpidnr", "bsdatum", "date")}
WHERE {_OPEN}
""")
def fact_sales_invoice_lines(spark, sf_dir):
    _, lines = _sales_invoice(spark, sf_dir)
    return _built(
        "fact_sales_invoice_lines",
        lines,
        _dims(spark, sf_dir, "product"),
        """nk_document_id nk_document_no position_seq_no sk_product_id invoice_date warehouse is_cancellation
        quantity discount_pct line_net_amount line_purchase_amount business_channel""",
    )


def _sales_order(spark, sf_dir):
    return facts.stage_sales_order(
        SALES_HEADERS.frame(spark, sf_dir), SALES_LINES.frame(spark, sf_dir), WATERMARK
    )


@query(f"""
SELECT bsbelid AS nk_document_id, bsbelnr AS nk_document_no, c.sk_customer_id, s.sk_salesperson_id,
  {_day("bsdatum", "transaction_date")}, bsonline AS document_online, bszb AS nk_payment_term, trim(coalesce(bsprov, '')) AS distributor_code,
  CAST(bsstatkz AS VARCHAR) AS document_status, {_NET}, CAST(bsekpreis2 + bsgema + bskoop AS DOUBLE) AS cost_amount
FROM ({SALES_HEADERS.sql}) h {_customer_sql("bskundennr", "bsdatum")} {_person_sql("bsbeakz", "bsdatum")}
WHERE {_OPEN} AND bsbelid IN (SELECT l_orderkey FROM lineitem)
""")
def fact_sales_order_header(spark, sf_dir):
    header, _ = _sales_order(spark, sf_dir)
    built = _built(
        "fact_sales_order_header",
        header,
        _dims(spark, sf_dir, "customer", "salesperson"),
        """nk_document_id nk_document_no sk_customer_id sk_salesperson_id transaction_date document_online
        nk_payment_term distributor_code document_status revenue cost_amount""",
    )
    return built.withColumn("revenue", F.round("revenue", 4))


@query(f"""
SELECT bsbelid AS nk_document_id, bsbelnr AS nk_document_no, bpposnr AS position_seq_no, p.sk_product_id,
  {_day("bsdatum", "transaction_date")}, bplager AS warehouse, coalesce(bpstorno <> ' ', false) AS is_cancellation,
  CAST(bpstueck AS DOUBLE) AS quantity, CAST(bpvkpreis AS DOUBLE) AS unit_sales_price_net,
  CAST(coalesce(bpukurs, 1) AS DOUBLE) AS exchange_rate, CAST(coalesce(bpueinh, 1) AS DOUBLE) AS exchange_unit
FROM ({SALES_HEADERS.sql}) h JOIN ({SALES_LINES.sql}) l ON bsbelid = bpbelid
{_product_sql("bpidnr", "bsdatum", "date")}
WHERE {_OPEN}
""")
def fact_sales_order_lines(spark, sf_dir):
    _, lines = _sales_order(spark, sf_dir)
    return _built(
        "fact_sales_order_lines",
        lines,
        _dims(spark, sf_dir, "product"),
        """nk_document_id nk_document_no position_seq_no sk_product_id transaction_date warehouse is_cancellation
        quantity unit_sales_price_net exchange_rate exchange_unit""",
    )


def _purchase_order(spark, sf_dir):
    return facts.stage_purchase_order(
        PURCHASE_HEADERS.frame(spark, sf_dir), PURCHASE_LINES.frame(spark, sf_dir), WATERMARK
    )


@query(f"""
SELECT lbbelid AS nk_document_id, lbbelnr AS nk_document_no, lbbeltyp AS document_type_code,
  lbstatkz AS document_status, sp.sk_supplier_id, s.sk_salesperson_id, {_day("lbdatum", "created_date")},
  {_day("lbedatum", "document_created_date")}, {_day("lbudatum", "original_document_date")},
  CAST(lbbetrag AS DOUBLE) AS amount, lbwaehrung AS header_currency, lbtext AS reference_text
FROM ({PURCHASE_HEADERS.sql}) h {_supplier_sql("lbliefnr", "lbedatum", "date")} {_person_sql("lbbeakz", "lbedatum")}
WHERE lbedatum >= {_SINCE}
""")
def fact_purchase_order_header(spark, sf_dir):
    header, _ = _purchase_order(spark, sf_dir)
    return _built(
        "fact_purchase_order_header",
        header,
        _dims(spark, sf_dir, "supplier", "salesperson"),
        """nk_document_id nk_document_no document_type_code document_status sk_supplier_id sk_salesperson_id
        created_date document_created_date original_document_date amount header_currency reference_text""",
    )


_NET_LINE = "CAST(lpstueck * lpekpreis AS DOUBLE)"


@query(f"""
SELECT lbbelid AS nk_document_id, lbbelnr AS nk_document_no, lpposnr AS position_seq_no, p.sk_product_id,
  {_day("lbedatum", "document_created_date")}, xsatzid AS line_id, trim(coalesce(lplager, '')) AS warehouse_code,
  {_day("lptermin", "delivery_date")}, CAST(lpstueck AS DOUBLE) AS quantity, coalesce(lpukurs, 1) AS line_exchange_rate,
  coalesce(lpaufschl1, 0) AS surcharge1, {_NET_LINE} AS line_purchase_amount,
  round(CASE WHEN coalesce(lpukurs, 1) <> 0 THEN {_NET_LINE} / coalesce(lpukurs, 1) * coalesce(lpueinh, 1)
    ELSE {_NET_LINE} END, 4) AS line_purchase_eur,
  date_diff('day', CAST(lbdatum AS DATE), CAST(lptermin AS DATE)) AS delivery_time_days
FROM ({PURCHASE_HEADERS.sql}) h LEFT JOIN ({PURCHASE_LINES.sql}) l ON lbbelid = lpbelid
{_product_sql("lpidnr", "lbedatum", "timestamp")}
WHERE lbedatum >= {_SINCE}
""")
def fact_purchase_order_lines(spark, sf_dir):
    _, lines = _purchase_order(spark, sf_dir)
    built = _built(
        "fact_purchase_order_lines",
        lines,
        _dims(spark, sf_dir, "product"),
        """nk_document_id nk_document_no position_seq_no sk_product_id document_created_date line_id warehouse_code
        delivery_date quantity line_exchange_rate surcharge1 line_purchase_amount line_purchase_eur
        delivery_time_days""",
    )
    return built.withColumn("line_purchase_eur", F.round("line_purchase_eur", 4))


def _supplier_invoice(spark, sf_dir):
    return facts.stage_supplier_invoice(
        SUPPLIER_HEADERS.frame(spark, sf_dir), SUPPLIER_LINES.frame(spark, sf_dir), WATERMARK
    )


@query(f"""
SELECT lrbelid AS nk_document_id, lrbelegnr AS nk_document_no, sp.sk_supplier_id, s.sk_salesperson_id,
  {_day("lrdatum", "invoice_date")}, CAST(coalesce(lrbrutto, 0) AS DOUBLE) AS amount_gross, lroffen = 'J' AS is_open,
  coalesce(lrstbear > 0, false) AS is_cancelled, trim(coalesce(lrwaehrung, 'EUR')) AS currency_code,
  coalesce(lrukurs, 1) AS exchange_rate, lrtext AS reference_text
FROM ({SUPPLIER_HEADERS.sql}) h {_supplier_sql("lrliefnr", "lrdatum", "timestamp")}
{_person_sql("lrbeakz", "lrdatum", "timestamp")}
WHERE lrdatum >= {_SINCE}
""")
def fact_supplier_invoice_header(spark, sf_dir):
    header, _ = _supplier_invoice(spark, sf_dir)
    return _built(
        "fact_supplier_invoice_header",
        header,
        _dims(spark, sf_dir, "supplier", "salesperson"),
        """nk_document_id nk_document_no sk_supplier_id sk_salesperson_id invoice_date amount_gross is_open
        is_cancelled currency_code exchange_rate reference_text""",
    )


@query(f"""
SELECT lrbelid AS nk_document_id, lrbelegnr AS nk_document_no, xsatzid AS nk_line_id, p.sk_product_id,
  {_day("lrdatum", "invoice_date")}, trim(coalesce(lrwbeltyp, '')) AS goods_receipt_type,
  CAST(coalesce(lrwstueck, 0) AS DOUBLE) AS quantity_billed,
  CAST(coalesce(lrwstueck, 0) * coalesce(lrwlfpreis, 0) AS DOUBLE) AS line_amount,
  coalesce(lrstbear > 0, false) AS is_cancelled
FROM ({SUPPLIER_HEADERS.sql}) h LEFT JOIN ({SUPPLIER_LINES.sql}) l ON lrbelid = lrwbelid
{_product_sql("lrwidnr", "lrdatum", "timestamp")}
WHERE lrdatum >= {_SINCE}
""")
def fact_supplier_invoice_lines(spark, sf_dir):
    _, lines = _supplier_invoice(spark, sf_dir)
    return _built(
        "fact_supplier_invoice_lines",
        lines,
        _dims(spark, sf_dir, "product"),
        """nk_document_id nk_document_no nk_line_id sk_product_id invoice_date goods_receipt_type quantity_billed
        line_amount is_cancelled""",
    )


@query(f"""
SELECT lpid AS nk_receipt_id, lpbelid AS nk_document_id, lpbelnr AS nk_document_no, lpposnr AS position_seq_no,
  sp.sk_supplier_id, p.sk_product_id, trim(lplager) AS warehouse, {_day("lpdatum", "receipt_date")},
  CAST(coalesce(lpmgist, 0) AS DOUBLE) AS quantity_received, coalesce(lpdefekt, false) AS is_defective,
  CAST(CASE WHEN lpdefekt THEN coalesce(lpmgist, 0) ELSE 0 END AS DOUBLE) AS quantity_defective,
  coalesce(lpgarmon, 0) AS warranty_months
FROM ({RECEIPTS.sql}) r {_supplier_sql("lpliefnr", "lpdatum", "timestamp")}
{_product_sql("lpidnr", "lpdatum", "timestamp")}
WHERE lpdatum >= {_SINCE}
""")
def fact_goods_receipt_lines(spark, sf_dir):
    """Two overlapping incremental runs, with the watermark advanced between."""
    fact = FACTS["fact_goods_receipt_lines"]
    dims = _dims(spark, sf_dir, "supplier", "product")
    schema = new_database(spark)
    control = f"{schema}.control"
    marks = [(*fact.watermark, WATERMARK, 200)]
    spark.createDataFrame(marks, CONTROL).write.saveAsTable(control)
    receipts = RECEIPTS.frame(spark, sf_dir)
    moment = F.lit(LOADED).cast("timestamp_ntz")
    for arrived in (receipts.where("lpdatum < '1999-01-01'"), receipts):
        run_fact(
            spark,
            schema,
            fact,
            lambda mark, rows=arrived: facts.stage_goods_receipt(rows, mark),
            dims,
            spark.read.table(control),
            moment,
        )
        advance_table(spark, control, schema)
    return spark.read.table(f"{schema}.{fact.table}").select(
        *"""nk_receipt_id nk_document_id nk_document_no position_seq_no sk_supplier_id sk_product_id warehouse
        receipt_date quantity_received is_defective quantity_defective warranty_months""".split()
    )


@query(f"""
SELECT 'fact_sales_order_header' AS table_name, 'transaction_date' AS column_name, 30 AS previous_days,
  CAST(max(CAST(o_orderdate AS DATE)) - 30 AS VARCHAR) AS date_control, count(*) AS documents,
  (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')) AS positions
FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def etl_control_update(spark, sf_dir):
    """A first full run of sales orders without a watermark, then one with it."""
    header, lines = FACTS["fact_sales_order_header"], FACTS["fact_sales_order_lines"]
    dims = _dims(spark, sf_dir, "customer", "salesperson", "product")
    schema = new_database(spark)
    control = f"{schema}.control"
    marks = [(*header.watermark, None, 30)]
    spark.createDataFrame(marks, CONTROL).write.saveAsTable(control)
    headers, positions = SALES_HEADERS.frame(spark, sf_dir), SALES_LINES.frame(spark, sf_dir)
    for _ in range(2):
        run_document(
            spark,
            schema,
            header,
            lines,
            lambda mark: facts.stage_sales_order(headers, positions, mark),
            dims,
            spark.read.table(control),
            F.lit(LOADED).cast("timestamp_ntz"),
        )
        advance_table(spark, control, schema)
    marked = spark.read.table(control)
    for fact, name in ((header, "documents"), (lines, "positions")):
        stored = spark.read.table(f"{schema}.{fact.table}")
        count = stored.groupBy(F.lit(header.table).alias("table_name")).agg(F.count(F.lit(1)).alias(name))
        marked = marked.join(count, "table_name")
    return marked


_PRICE_SQL = f"""SELECT p.sk_product_id, anpid AS price_id, trim(coalesce(aapbez, '')) AS price_label,
  trim(anwaehrung) AS currency, coalesce(aapbrucalc, false) AS is_gross_calc,
  CAST(coalesce(anvkpreis, 0) AS DOUBLE) AS price_net, anprnull > 0 AS allow_zero_price,
  coalesce(anvkstne2, 0) AS tier_price_net_2, coalesce(anvkstbr2, 0) AS tier_price_gross_2,
  awempfvk AS recommended_price, awvkstaf3 AS tier_qty_3,
  strftime(updtime, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM ({PRICES.sql}) pr
LEFT JOIN ({PRICE_PARAMETERS.sql}) w ON anidnr = awidnr AND anmankey = awmankey AND anwaehrung = awwaehrung
LEFT JOIN ({PRICE_GROUPS.sql}) vp ON anpid = aapid AND anmankey = aamankey
{_product_sql("anidnr", "updtime", "timestamp")}
WHERE updtime >= {_SINCE}"""


@query(f"SELECT DISTINCT sk_product_id, price_id, price_label, 1 AS prices FROM ({_PRICE_SQL})")
def fact_product_prices(spark, sf_dir):
    """The price keys; each is stored once."""
    rows = facts.stage_product_prices(
        PRICES.frame(spark, sf_dir),
        PRICE_PARAMETERS.frame(spark, sf_dir),
        PRICE_GROUPS.frame(spark, sf_dir),
        WATERMARK,
    )
    built = _built(
        "fact_product_prices",
        rows,
        _dims(spark, sf_dir, "product"),
        "sk_product_id price_id price_label",
    )
    return built.withColumn("prices", F.lit(1))


@query(_PRICE_SQL)
def stg_product_prices(spark, sf_dir):
    """All price rows with their lookups, before one is kept per key."""
    rows = facts.stage_product_prices(
        PRICES.frame(spark, sf_dir),
        PRICE_PARAMETERS.frame(spark, sf_dir),
        PRICE_GROUPS.frame(spark, sf_dir),
        WATERMARK,
    )
    found = facts.look_up(FACTS["fact_product_prices"], rows, _dims(spark, sf_dir, "product"))
    return found.select(
        *"""sk_product_id price_id price_label currency is_gross_calc price_net allow_zero_price tier_price_net_2
        tier_price_gross_2 recommended_price tier_qty_3 updated_at""".split()
    )


_SERIAL_DAY = "CAST(sedatum AS DATE)"


@query(f"""
SELECT seserid AS nk_event_id, p.sk_product_id, c.sk_customer_id, sp.sk_supplier_id, s.sk_salesperson_id,
  trim(selager) AS warehouse, sesernr AS serial_number, CASE WHEN seaus THEN 'OUT' ELSE 'IN' END AS movement_direction,
  trim(coalesce(sekltyp, '')) AS party_type_code,
  CASE sekltyp WHEN 'K' THEN 'Customer' WHEN 'L' THEN 'Supplier' ELSE 'Unknown' END AS party_type,
  CASE WHEN sebeltyp IN ('F', 'G', 'M', 'O') THEN 'Sales Invoice' WHEN sebeltyp IN ('A', 'B', 'L') THEN 'Sales Order'
    WHEN sebeltyp = 'E' THEN 'Purchase Order' WHEN sebeltyp = 'W' THEN 'Goods Receipt'
    WHEN sebeltyp = 'R' THEN 'Supplier Invoice' ELSE 'Other' END AS document_category,
  {_day("sedatum", "event_date")}, coalesce(sestorno = 'J', false) AS is_cancelled, trim(setext) AS error_text
FROM ({SERIALS.sql}) e {_product_sql("seidnr", _SERIAL_DAY, "timestamp")}
{_lookup("customer", "c", "sekdnummer", _SERIAL_DAY, "nk_customer_id", "timestamp", "sekltyp = 'K'")}
{_lookup("supplier", "sp", "sekdnummer", _SERIAL_DAY, "nk_supplier_id", "timestamp", "sekltyp = 'L'")}
{_lookup("salesperson", "s", "sebea", _SERIAL_DAY, "nk_salesperson_id", "date")}
""")
def fact_serial_number_event(spark, sf_dir):
    return _built(
        "fact_serial_number_event",
        facts.stage_serial_events(SERIALS.frame(spark, sf_dir), WATERMARK),
        _dims(spark, sf_dir, "product", "customer", "supplier", "salesperson"),
        """nk_event_id sk_product_id sk_customer_id sk_supplier_id sk_salesperson_id warehouse serial_number
        movement_direction party_type_code party_type document_category event_date is_cancelled error_text""",
    )


def _twice(spark, built_from: DataFrame, fact: str, dims, blank: str) -> DataFrame:
    """A stored fact after two loads.

    The first holds part of the rows, with a measure missing, so that the second
    one inserts rows, changes some, and leaves those that were empty anyway.
    """
    schema, spec = new_database(spark), FACTS[fact]
    moment = F.lit(LOADED).cast("timestamp_ntz")
    part = built_from.where(F.pmod(F.xxhash64(spec.event, "nk_document_id"), F.lit(3)) < 2)
    early = part.withColumn(blank, F.lit(None).cast(part.schema[blank].dataType))
    for rows in (early, built_from):
        facts.load_fact(spark, schema, spec, rows, dims, moment)
    return spark.read.table(f"{schema}.{fact}")


# Each is loaded twice and has to equal a single build: name, grain, dimensions,
# the measure that the first load lacks, and the columns shown.
_TWICE = (
    ("fact_sales_invoice_header", _sales_invoice, 0, ("customer", "salesperson"), "cost_amount"),
    ("fact_sales_invoice_lines", _sales_invoice, 1, ("product",), "line_net_amount"),
    ("fact_purchase_order_header", _purchase_order, 0, ("supplier", "salesperson"), "amount"),
    ("fact_purchase_order_lines", _purchase_order, 1, ("product",), "quantity"),
    ("fact_supplier_invoice_header", _supplier_invoice, 0, ("supplier", "salesperson"), "amount_gross"),
    ("fact_supplier_invoice_lines", _supplier_invoice, 1, ("product",), "line_amount"),
)


def _register_twice(name: str, stage, grain: int, needed: tuple[str, ...], blank: str) -> None:
    @query(ORACLES[name], name=f"{name}_upsert")
    def loaded_twice(spark, sf_dir):
        rows = stage(spark, sf_dir)[grain]
        stored = _twice(spark, rows, name, _dims(spark, sf_dir, *needed), blank)
        shown = QUERIES[name](spark, sf_dir).columns
        for c in ("revenue", "line_purchase_eur"):
            if c in shown:
                stored = stored.withColumn(c, F.round(c, 4))
        return stored.select(*shown)


for _spec in _TWICE:
    _register_twice(*_spec)


@query(ORACLES["fact_serial_number_event"])
def fact_serial_number_event_upsert(spark, sf_dir):
    """Serial events, loaded twice; the first load knows no error texts."""
    rows = facts.stage_serial_events(SERIALS.frame(spark, sf_dir), WATERMARK)
    needed = _dims(spark, sf_dir, "product", "customer", "supplier", "salesperson")
    stored = _twice(spark, rows, "fact_serial_number_event", needed, "error_text")
    return stored.select(*QUERIES["fact_serial_number_event"](spark, sf_dir).columns)


@query(f"""
SELECT sk_product_id, price_id, price_label, max(updated_at) AS updated_at, count(*) > 0 AS stored
FROM ({_PRICE_SQL}) GROUP BY ALL
""")
def fact_product_prices_upsert(spark, sf_dir):
    """Prices, with a late load of older rows that must not come back."""
    rows = facts.stage_product_prices(
        PRICES.frame(spark, sf_dir),
        PRICE_PARAMETERS.frame(spark, sf_dir),
        PRICE_GROUPS.frame(spark, sf_dir),
        WATERMARK,
    )
    schema, spec = new_database(spark), FACTS["fact_product_prices"]
    needed, moment = _dims(spark, sf_dir, "product"), F.lit(LOADED).cast("timestamp_ntz")
    table = f"{schema}.{spec.table}"
    facts.load_fact(spark, schema, spec, rows, needed, moment)
    # the stored keys again, an hour older and with another price
    known = spark.read.table(table).drop("event_period", "dw_loaded_at")
    older = known.withColumns(
        {"updated_at": F.expr("updated_at - INTERVAL 1 HOUR"), "price_net": F.lit(0).cast("decimal(18,2)")}
    )
    late = older.withColumns({"event_period": F.date_format("updated_at", "yyyy-MM"), "dw_loaded_at": moment})
    late = late.withColumn("row_hash", F.md5(F.col("row_hash")))
    upsert(spark, table, late.select(*spark.read.table(table).columns), spec.keys, newest=spec.newest)
    shown = spark.read.table(table).select("sk_product_id", "price_id", "price_label", "updated_at")
    return shown.withColumn("stored", F.lit(True))


@query(f"""
SELECT {layout_sql(facts.PURCHASE_ORDER_LINES, "lpstueck lpekpreis")}
FROM ({PURCHASE_HEADERS.sql}) h LEFT JOIN ({PURCHASE_LINES.sql}) p ON lbbelid = lpbelid
WHERE lbedatum >= {_SINCE}
""")
def stg_purchase_order_lines_all_columns(spark, sf_dir):
    _, lines = _purchase_order(spark, sf_dir)
    return lines.select(*names(facts.PURCHASE_ORDER_LINES))


@query(f"""
SELECT {layout_sql(facts.PURCHASE_ORDER_HEADER, "lbbetrag")}
FROM ({PURCHASE_HEADERS.sql}) h WHERE lbedatum >= {_SINCE}
""")
def stg_purchase_order_header_all_columns(spark, sf_dir):
    header, _ = _purchase_order(spark, sf_dir)
    return header.select(*names(facts.PURCHASE_ORDER_HEADER))


@query(f"""
SELECT {layout_sql(facts.SALES_INVOICE_HEADER, "bsvkpreis bsbrutto bsekpreis bsekpreis2 bsgema bskoop bsversend bsverpack bsmaut bsintkostv")}
FROM ({SALES_HEADERS.sql}) h WHERE {_OPEN}
""")
def stg_sales_invoice_header_all_columns(spark, sf_dir):
    header, _ = _sales_invoice(spark, sf_dir)
    return header.select(*names(facts.SALES_INVOICE_HEADER))


@query(f"""
SELECT {layout_sql(facts.GOODS_RECEIPT, "lpmgist")} FROM ({RECEIPTS.sql}) WHERE lpdatum >= {_SINCE}
""")
def stg_goods_receipt_all_columns(spark, sf_dir):
    staged = facts.stage_goods_receipt(RECEIPTS.frame(spark, sf_dir), WATERMARK)
    return staged.select(*names(facts.GOODS_RECEIPT))


@query(f"""
SELECT {layout_sql(facts.SERIAL_EVENT)} FROM ({SERIALS.sql}) WHERE sedatum >= {_SINCE}
""")
def stg_serial_event_all_columns(spark, sf_dir):
    staged = facts.stage_serial_events(SERIALS.frame(spark, sf_dir), WATERMARK)
    return staged.select(*names(facts.SERIAL_EVENT))
