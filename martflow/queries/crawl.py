"""JSON columns and the marketplace crawl.

Each line stands for one crawled product document with two offers: the own one
and that of the supplier. Some documents hold no offers and some are no JSON.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.layout import names
from ..operators.crawl import explode_items, parse_json
from ..operators.upsert import append_once
from ..operators.variants import field, fields, items, store_documents
from ..plans.marketplace import (
    PRODUCT,
    SNAPSHOT_KEYS,
    load_offers,
    load_products,
    marketplace_offers,
    marketplace_products,
)
from ..sources.tables import new_database
from .base import ORACLES, query, sql_hash, table
from .history import SEES_TIME, history, history_sql

OWN = "OWN"


def crawl(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    part, number = F.col("l_partkey"), F.col("l_linenumber")
    offer_id = (F.col("l_orderkey") * 100000 + part) * 1000 + F.col("l_suppkey") * 10 + number
    shared = [
        F.lit("EUR").alias("currencyCode"),
        F.col("l_quantity").cast("long").alias("stock"),
        F.when(F.col("l_returnflag") == "A", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("soon")
        .alias("stockAvailabilityDate"),
    ]
    own = F.struct(
        (offer_id * 10 + 1).alias("id"),
        F.concat(F.lit(" P"), part.cast("string"), F.lit(" ")).alias("supplierSKU"),
        F.lit(OWN).alias("supplierName"),
        F.col("l_extendedprice").alias("price"),
        *shared,
    )
    other = F.struct(
        (offer_id * 10 + 2).alias("id"),
        F.concat(F.lit("P"), part.cast("string")).alias("supplierSKU"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("supplierName"),
        (F.col("l_extendedprice") + 1).alias("price"),
        *shared,
    )
    offers = F.array(own, other)
    document = F.struct(
        part.alias("puid"),
        F.concat(F.lit("ean"), F.col("l_suppkey").cast("string")).alias("ean"),
        F.col("l_suppkey").alias("manufacturerId"),
        F.concat(F.lit("Product "), part.cast("string")).alias("productName"),
        F.when(number == 1, "1999-02-30").otherwise("1999-02-28 10:00:00").alias("entryDate"),
        F.when(number == 6, F.filter(offers, lambda _: F.lit(False))).otherwise(offers).alias("supplierItems"),
    )
    return lines.select(
        F.col("l_shipdate").alias("fetched_at"),
        F.col("l_linestatus").alias("source"),
        F.when(number == 7, F.lit('{"puid": oops')).otherwise(F.to_json(document)).alias("raw_json"),
    )


_OFFERS = """
SELECT l_partkey AS puid, l_linestatus AS source, l_shipdate AS fetched_at,
  ((l_orderkey * 100000 + l_partkey) * 1000 + l_suppkey * 10 + l_linenumber) * 10 + n AS supplier_item_id,
  CASE n WHEN 1 THEN 'OWN' ELSE 'S' || l_suppkey END AS supplier_name,
  CASE n WHEN 1 THEN ' P' || l_partkey || ' ' ELSE 'P' || l_partkey END AS supplier_sku,
  CASE n WHEN 1 THEN l_extendedprice ELSE l_extendedprice + 1 END AS price,
  CAST(l_quantity AS BIGINT) AS stock,
  CASE l_returnflag WHEN 'A' THEN l_shipdate END AS available
FROM lineitem CROSS JOIN (VALUES (1), (2)) t(n) WHERE l_linenumber NOT IN (6, 7)
"""


@query("SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events")
def q32_json_struct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return parse_json(events, "props", "k INT", "k", ["event_id"]).select("event_id", "j.k")


@query(f"""
SELECT puid, supplier_item_id, supplier_name, price, stock,
  strftime(available, '%Y-%m-%d %H:%M:%S') AS available FROM ({_OFFERS})
""")
def q33_json_explode(spark, sf_dir):
    schema = (
        "puid BIGINT, supplierItems ARRAY<STRUCT<id BIGINT, supplierName STRING, price DOUBLE, "
        "stock BIGINT, stockAvailabilityDate STRING>>"
    )
    parsed = parse_json(crawl(spark, sf_dir), "raw_json", schema, "puid")
    offers = explode_items(parsed, "j.supplierItems", [F.col("j.puid").alias("puid")])
    return offers.select(
        "puid",
        F.col("o.id").alias("supplier_item_id"),
        F.col("o.supplierName").alias("supplier_name"),
        "o.price",
        "o.stock",
        F.col("o.stockAvailabilityDate").try_cast("timestamp").alias("available"),
    )


@query(f"""
SELECT supplier_name = 'OWN' AS is_own_listing, count(*) AS offers, count(DISTINCT puid) AS products
FROM ({_OFFERS}) GROUP BY 1
""")
def q34_own_listing_flag(spark, sf_dir):
    versions = _products(spark, sf_dir)
    offers = marketplace_offers(crawl(spark, sf_dir), versions, OWN)
    return offers.groupBy("is_own_listing").agg(
        F.count(F.lit(1)).alias("offers"), F.count_distinct("puid").alias("products")
    )


def _products(spark, sf_dir) -> DataFrame:
    """Product history in the shape the lookup reads."""
    return history(spark, sf_dir, "part").withColumns(
        {
            "sk_product_id": F.concat("k", F.lit("/"), "seg"),
            "product_number": F.concat(F.lit("P"), F.col("k").cast("string"), F.lit(" ")),
        }
    )


_FILLED = {
    "ean": "'ean' || l_suppkey",
    "manufacturer_id": "l_suppkey",
    "product_name": "'Product ' || l_partkey",
    "entry_date": "CASE WHEN l_linenumber <> 1 THEN TIMESTAMP '1999-02-28 10:00:00' END",
}
_PRODUCT_HASH = sql_hash(*[_FILLED.get(c, "NULL") for c in names(PRODUCT) if c != "puid"])


@query(f"""
WITH c AS (SELECT l_partkey AS puid, {", ".join(f"{e} AS {n}" for n, e in _FILLED.items())},
    l_shipdate AS fetched_at, {_PRODUCT_HASH} AS row_hash FROM lineitem WHERE l_linenumber <> 7)
SELECT puid, ean, manufacturer_id, product_name, strftime(entry_date, '%Y-%m-%d %H:%M:%S') AS entry_date,
  strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, row_hash
FROM (SELECT *, row_number() OVER (PARTITION BY puid ORDER BY fetched_at DESC, row_hash) rn FROM c)
WHERE rn = 1
""")
def dim_product_marketplace(spark, sf_dir):
    rows = marketplace_products(crawl(spark, sf_dir))
    return rows.select("puid", *_FILLED, "fetched_at", "row_hash")


@query(f"""
WITH {history_sql("p", "part")}, o AS ({_OFFERS})
SELECT o.puid, o.source, o.supplier_item_id, o.supplier_name, o.supplier_sku, o.price, o.stock,
  strftime(o.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at,
  strftime(o.available, '%Y-%m-%d %H:%M:%S') AS stock_availability_date,
  o.supplier_name = 'OWN' AS is_own_listing, p.k || '/' || p.seg AS sk_product_id
FROM o LEFT JOIN p ON o.supplier_name = 'OWN' AND trim(o.supplier_sku) = trim('P' || p.k || ' ')
  AND {SEES_TIME.format(event="o.fetched_at")}
""")
def fact_marketplace_price_snapshot(spark, sf_dir):
    """Two crawl loads, the second of which repeats part of the first."""
    target = f"{new_database(spark)}.offers"
    versions = _products(spark, sf_dir)
    offers = marketplace_offers(crawl(spark, sf_dir), versions, OWN)
    day = F.col("fetched_at").cast("date")
    first = offers.where(day < F.lit("1999-06-01").cast("date"))
    second = offers.where(day >= F.lit("1999-01-01").cast("date"))
    append_once(spark, target, first, SNAPSHOT_KEYS)
    append_once(spark, target, second, SNAPSHOT_KEYS, day >= F.lit("1999-01-01").cast("date"))
    shown = ["puid", "source", "supplier_item_id", "supplier_name", "supplier_sku", "price", "stock"]
    return spark.read.table(target).select(
        *shown, "fetched_at", "stock_availability_date", "is_own_listing", "sk_product_id"
    )


@query(f"""
SELECT puid, {", ".join(_FILLED)}, row_hash FROM ({ORACLES["dim_product_marketplace"]})
""")
def dim_product_marketplace_upsert(spark, sf_dir):
    """Loads into buckets; the later ones repeat part of the first, with newer crawls.

    A row whose hash is the same stays as it is, with the time of its first crawl.
    """
    target, whole = f"{new_database(spark)}.products", crawl(spark, sf_dir)
    early = whole.where(F.col("fetched_at").cast("date") < F.lit(dt.date(1998, 6, 1)))
    for rows, watermark in ((early, None), (whole, dt.date(1997, 1, 1)), (whole, None)):
        load_products(spark, target, rows, watermark)
    return spark.read.table(target).select("puid", *_FILLED, "row_hash")


@query(ORACLES["fact_marketplace_price_snapshot"])
def fact_marketplace_price_snapshot_upsert(spark, sf_dir):
    """Two runs of the load itself; the second looks back over part of the first."""
    target, whole = f"{new_database(spark)}.offers", crawl(spark, sf_dir)
    early = whole.where(F.col("fetched_at").cast("date") < F.lit(dt.date(1999, 6, 1)))
    for rows, watermark in ((early, None), (whole, dt.date(1999, 1, 1))):
        load_offers(spark, target, rows, _products(spark, sf_dir), OWN, watermark)
    shown = ["puid", "source", "supplier_item_id", "supplier_name", "supplier_sku", "price", "stock"]
    return spark.read.table(target).select(
        *shown, "fetched_at", "stock_availability_date", "is_own_listing", "sk_product_id"
    )


def _stored_documents(spark, sf_dir) -> DataFrame:
    """Crawled documents, stored as VARIANT by two loads."""
    target, whole = f"{new_database(spark)}.documents", crawl(spark, sf_dir)
    early = F.col("fetched_at") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    for part in (early, ~early):
        store_documents(whole.where(part), target, "raw_json", ("puid", "puid", "bigint"), ["fetched_at"])
    return spark.read.table(target)


@query(ORACLES["q33_json_explode"])
def q62_variant_explode(spark, sf_dir):
    """The offers of documents that were parsed when they arrived."""
    offers = items(_stored_documents(spark, sf_dir), "supplierItems", ["puid"])
    found = {
        "supplier_item_id": ("id", "bigint"),
        "supplier_name": ("supplierName", "string"),
        "price": ("price", "double"),
        "stock": ("stock", "bigint"),
        "available": ("stockAvailabilityDate", "string"),
    }
    rows = offers.select("puid", *fields(found, "item"))
    return rows.withColumn("available", F.col("available").try_cast("timestamp"))


@query("""
SELECT l_suppkey AS manufacturer_id, count(*) AS documents, count(DISTINCT l_partkey) AS products
FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1
""")
def q63_variant_one_field(spark, sf_dir):
    """A count by one field of stored documents; their offers are not decoded."""
    made = field("manufacturerId", "bigint").alias("manufacturer_id")
    rows = _stored_documents(spark, sf_dir).select("puid", made)
    return rows.groupBy("manufacturer_id").agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("puid").alias("products")
    )
