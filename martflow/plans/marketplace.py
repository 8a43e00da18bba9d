"""Marketplace crawl: product dimension and offer snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clean import holds
from ..functions.keys import row_hash
from ..functions.layout import Field, layout, names
from ..operators.buckets import upsert_bucketed
from ..operators.control import since
from ..operators.crawl import explode_items, parse_json
from ..operators.reduce import argmax_rows, keep_one
from ..operators.temporal import asof_lookup
from ..operators.upsert import HASH, append_once

# Fields of one supplier offer in the crawl.
OFFER_FIELDS = """
id BIGINT, ean STRING, manufacturerSKU STRING, supplierSKU STRING, supplierId BIGINT,
supplierName STRING, manufacturerName STRING, productName STRING, longDescription STRING,
conditionId BIGINT, conditionName STRING, eolProduct BOOLEAN, matchQuality BIGINT,
eanValid BOOLEAN, specialOffer BOOLEAN, price DOUBLE, priceCalc DOUBLE, currencyCode STRING,
priceCalcVat DOUBLE, priceLastUpdate STRING, stockSupplierText STRING, stockStatus BIGINT,
stockStatusText STRING, stock BIGINT, externalStock BIGINT, stockAvailabilityDate STRING,
lastStockUpdate STRING, contractTypeId BIGINT, contractTypeName STRING, grossDimX DOUBLE,
grossDimY DOUBLE, grossDimZ DOUBLE, recommendedRetailPriceNet DOUBLE
"""

# Fields of one product in the crawl.
PRODUCT_FIELDS = """
puid BIGINT, ean STRING, manufacturerSKU STRING, icecatId STRING, eClass STRING,
eClassV7 STRING, UNSPSC STRING, manufacturerId BIGINT, manufacturerName STRING,
productName STRING, shortDescription STRING, longDescription STRING, productTypeId BIGINT,
productTypeGroupId STRING, productTypeGroupName STRING, productTypeName STRING,
attributeTypeId1 BIGINT, attributeTypeName1 STRING, attributeTypeId2 BIGINT,
attributeTypeName2 STRING, attributeTypeId3 BIGINT, attributeTypeName3 STRING,
attributeTypeId4 BIGINT, attributeTypeName4 STRING, attributeTypeId5 BIGINT,
attributeTypeName5 STRING, attributeValue1 STRING, productSubTypeId STRING,
productSubType STRING, colorFamilyId STRING, colorFamily STRING, estimateGrossWeight DOUBLE,
valueAddedTaxGermany BIGINT, deeplink STRING, standardHtmlDatasheet STRING,
standardPdfDatasheet STRING, htmlSpecs STRING, entryDate STRING, rank BIGINT,
qualification BIGINT, recommendedRetailPriceNet DOUBLE, price DOUBLE, priceCalc DOUBLE,
currencyCode STRING, priceCalcVat DOUBLE, priceLastUpdate STRING, priceSupplierId BIGINT,
priceSupplierName STRING, priceSupplierItemId BIGINT, priceSupplierSKU STRING,
stockSupplierText STRING, stockStatus BIGINT, stockStatusText STRING, stock BIGINT,
stockLastUpdate STRING, aggregatedStatus BIGINT, aggregatedStatusText STRING,
aggregatedStock BIGINT, aggregatedSupplierItems BIGINT, contractTypeId BIGINT,
contractTypeName STRING
"""
OFFERS_FIELD = f"supplierItems ARRAY<STRUCT<{OFFER_FIELDS.strip()}>>"
CRAWL_SCHEMA = f"{PRODUCT_FIELDS.rstrip()}, {OFFERS_FIELD}"

# Output column, source column, rule.
PRODUCT = layout("""
puid                    j.puid                  keep
ean                     j.ean                   keep
manufacturer_sku        j.manufacturerSKU       keep
icecat_id               j.icecatId              keep
e_class                 j.eClass                keep
e_class_v7              j.eClassV7              keep
unspsc                  j.UNSPSC                keep
manufacturer_id         j.manufacturerId        keep
manufacturer_name       j.manufacturerName      keep
product_name            j.productName           keep
short_description       j.shortDescription      keep
long_description        j.longDescription       keep
product_type_id         j.productTypeId         keep
product_type_group_id   j.productTypeGroupId    keep
product_type_group_name j.productTypeGroupName  keep
product_type_name       j.productTypeName       keep
attribute_type_id_1     j.attributeTypeId1      keep
attribute_type_name_1   j.attributeTypeName1    keep
attribute_type_id_2     j.attributeTypeId2      keep
attribute_type_name_2   j.attributeTypeName2    keep
attribute_type_id_3     j.attributeTypeId3      keep
attribute_type_name_3   j.attributeTypeName3    keep
attribute_type_id_4     j.attributeTypeId4      keep
attribute_type_name_4   j.attributeTypeName4    keep
attribute_type_id_5     j.attributeTypeId5      keep
attribute_type_name_5   j.attributeTypeName5    keep
attribute_value_1       j.attributeValue1       keep
product_sub_type_id     j.productSubTypeId      keep
product_sub_type        j.productSubType        keep
color_family_id         j.colorFamilyId         keep
color_family            j.colorFamily           keep
estimate_gross_weight   j.estimateGrossWeight   keep
value_added_tax_germany j.valueAddedTaxGermany  keep
deeplink                j.deeplink              keep
standard_html_datasheet j.standardHtmlDatasheet keep
standard_pdf_datasheet  j.standardPdfDatasheet  keep
html_specs              j.htmlSpecs             keep
entry_date              j.entryDate             moment
contract_type_id        j.contractTypeId        keep
contract_type_name      j.contractTypeName      keep
""")

# Output column, source column, rule.
OFFER = layout("""
supplier_item_id                o.id                        keep
ean                             o.ean                       keep
manufacturer_sku                o.manufacturerSKU           keep
supplier_sku                    o.supplierSKU               keep
supplier_id                     o.supplierId                keep
supplier_name                   o.supplierName              keep
offer_manufacturer_name         o.manufacturerName          keep
offer_product_name              o.productName               keep
offer_long_description          o.longDescription           keep
condition_id                    o.conditionId               keep
condition_name                  o.conditionName             keep
eol_product                     o.eolProduct                keep
match_quality                   o.matchQuality              keep
ean_valid                       o.eanValid                  keep
special_offer                   o.specialOffer              keep
price                           o.price                     keep
price_calc                      o.priceCalc                 keep
currency_code                   o.currencyCode              keep
price_calc_vat                  o.priceCalcVat              keep
price_last_update               o.priceLastUpdate           moment
stock_supplier_text             o.stockSupplierText         keep
stock_status                    o.stockStatus               keep
stock_status_text               o.stockStatusText           keep
stock                           o.stock                     keep
external_stock                  o.externalStock             keep
stock_availability_date         o.stockAvailabilityDate     moment
last_stock_update               o.lastStockUpdate           moment
contract_type_id                o.contractTypeId            keep
contract_type_name              o.contractTypeName          keep
gross_dim_x                     o.grossDimX                 keep
gross_dim_y                     o.grossDimY                 keep
gross_dim_z                     o.grossDimZ                 keep
recommended_retail_price_net    o.recommendedRetailPriceNet keep
""")

# An offer is observed once per crawl.
SNAPSHOT_KEYS = ("puid", "supplier_item_id", "fetched_at")


def _typed(fields: tuple[Field, ...], named: bool = False) -> list[Column]:
    """Crawled times are free text, so a bad one becomes NULL.

    With ``named`` the columns already have the names of the layout.
    """
    out = []
    for f in fields:
        c = F.col(f.name if named else f.source)
        out.append((c.try_cast("timestamp") if f.rule == "moment" else c).alias(f.name))
    return out


def marketplace_products(crawl: DataFrame, watermark: dt.date | None = None) -> DataFrame:
    """The latest crawl of each product, with its change hash.

    Only the product fields are parsed, not the offers. Older crawls of a product go
    before times are read and rows are hashed.
    """
    recent = since(crawl, "fetched_at", watermark)
    parsed = parse_json(recent, "raw_json", PRODUCT_FIELDS, "puid", ["fetched_at"])
    raw = parsed.select("fetched_at", *[F.col(f.source).alias(f.name) for f in PRODUCT])
    latest = argmax_rows(raw, ["puid"], "fetched_at")
    rows = latest.select("fetched_at", *_typed(PRODUCT, named=True))
    compared = [c for c in names(PRODUCT) if c != "puid"]
    hashed = rows.withColumn(HASH, row_hash(compared))
    return keep_one(hashed, ["puid"], [F.col("fetched_at").desc(), HASH])


def marketplace_offers(
    crawl: DataFrame,
    product_history: DataFrame,
    own_supplier: str,
    watermark: dt.date | None = None,
) -> DataFrame:
    """One row per offer and crawl; own listings are linked to the product.

    ``own_supplier`` is the name the own company lists its offers under.
    """
    recent = since(crawl, "fetched_at", watermark)
    fields = f"puid BIGINT, {OFFERS_FIELD}"
    parsed = parse_json(recent, "raw_json", fields, "puid", ["fetched_at", "source"])
    keep = ["fetched_at", "source", F.col("j.puid").alias("puid")]
    offers = explode_items(parsed, "j.supplierItems", keep).select(
        "fetched_at", "source", "puid", *_typed(OFFER)
    )
    own = F.col("supplier_name") == own_supplier
    return asof_lookup(
        offers.withColumn("is_own_listing", holds(own)),
        product_history,
        [(F.trim("supplier_sku"), F.trim("product_number"))],
        "fetched_at",
        ["sk_product_id"],
        precision="timestamp",
        only=own,
    )


def load_products(
    spark: SparkSession, table: str, crawl: DataFrame, watermark: dt.date | None = None
) -> None:
    """Upsert the current state of the crawled products, in buckets of their id."""
    upsert_bucketed(spark, table, marketplace_products(crawl, watermark), ["puid"])


def load_offers(
    spark: SparkSession,
    table: str,
    crawl: DataFrame,
    product_history: DataFrame,
    own_supplier: str,
    watermark: dt.date | None = None,
) -> None:
    """Append the offers of the crawls not stored yet."""
    offers = marketplace_offers(crawl, product_history, own_supplier, watermark)
    window = None if watermark is None else F.col("fetched_at").cast("date") >= F.lit(watermark)
    append_once(spark, table, offers, SNAPSHOT_KEYS, window, cluster_by=["puid", "fetched_at"])
