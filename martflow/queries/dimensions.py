"""Staging views and type-2 dimensions on ERP tables derived from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.layout import names
from ..operators.scd import END, START
from ..plans import dimensions as dims
from ..plans.history import DIMENSIONS, apply_snapshot, read_history
from ..sources.tables import new_database
from . import erp
from .base import layout_sql, query
from .history import shown


def _plain(columns) -> str:
    """Result columns of a staged dimension; decimals as double."""
    decimal = {
        "shipping_rate",
        "minimum_order_value",
        "purchase_price_avg",
        "purchase_price_repair",
        "purchase_price_net",
    }
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in decimal else c for c in columns)


def _staging(name: str, dimension: str) -> None:
    staged = erp.STAGED[dimension]

    @query(f"SELECT {_plain(staged.shown)} FROM ({staged.sql})", name=name)
    def stage(spark, sf_dir):
        return staged.frame(spark, sf_dir).select(*staged.shown)


def _dimension(name: str) -> None:
    staged = erp.STAGED[name]

    @query(
        f"""SELECT {_plain(staged.shown)}, {shown("__START_AT")} AS start_at, {shown("__END_AT")} AS end_at
        FROM ({erp.history_sql(name)})""",
        name=name,
    )
    def build(spark, sf_dir):
        """Two snapshots applied to a stored table; the second one twice."""
        first, second = erp.snapshots(spark, sf_dir, name)
        target = f"{new_database(spark)}.{name}"
        for snapshot, at in ((first, erp.FIRST), (second, erp.SECOND), (second, erp.SECOND)):
            apply_snapshot(spark, target, DIMENSIONS[name], snapshot, at)
        versions = read_history(spark, target)
        return versions.select(
            *staged.shown, F.col(START).alias("start_at"), F.col(END).alias("end_at")
        )


for _name in DIMENSIONS:
    _staging(_name.replace("dim_", "stg_"), _name)
    _dimension(_name)


@query(f"""
SELECT kknummer AS nk_customer_id, trim(kkkat) AS customer_category_code, trim(katext) AS customer_category_label,
  trim(coalesce(kaparent, '')) AS parent_category, kklfdnr AS category_seq_no
FROM ({erp.CATEGORY_LINKS_OF_CUSTOMERS.sql}) JOIN ({erp.CUSTOMER_CATEGORIES.sql}) ON kkkat = kakat
""")
def stg_customer_external_info(spark, sf_dir):
    return dims.stage_customer_external_info(
        erp.CATEGORY_LINKS_OF_CUSTOMERS.frame(spark, sf_dir),
        erp.CUSTOMER_CATEGORIES.frame(spark, sf_dir),
    )


@query(f"""
SELECT sk_customer_id, trim(kkkat) AS customer_category_code, trim(katext) AS customer_category_label,
  trim(coalesce(kaparent, '')) AS parent_category, kklfdnr AS category_seq_no
FROM ({erp.CATEGORY_LINKS_OF_CUSTOMERS.sql}) JOIN ({erp.CUSTOMER_CATEGORIES.sql}) ON kkkat = kakat
LEFT JOIN ({erp.history_sql("dim_customer")}) c ON kknummer = c.nk_customer_id
""")
def customer_external_info(spark, sf_dir):
    """One row per customer category and version of the customer."""
    staged = stg_customer_external_info(spark, sf_dir)
    return dims.customer_external_info(staged, erp.history(spark, sf_dir, "dim_customer"))


def _offers(spark, sf_dir):
    text = erp.OFFERS.text.replace("{q}", "`")
    return dims.stage_product_daily_offer(erp.Derived(text).frame(spark, sf_dir))


_OFFERS_SQL = erp.OFFERS.text.replace("{q}", '"').replace("{events}", "events")
_STAGED_OFFERS = f"""SELECT trim(id) AS nk_offer_id, itemnr AS product_number, createdby AS nk_created_by,
  CAST("from" AS DATE) AS valid_from, CAST("to" AS DATE) AS valid_to, trim(coalesce(comment, '')) AS comment,
  created AS created_at FROM ({_OFFERS_SQL})"""
_OFFER_DATES = """CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at"""


@query(f"""
SELECT nk_offer_id, product_number, nk_created_by, comment, {_OFFER_DATES} FROM ({_STAGED_OFFERS})
""")
def stg_product_daily_offer(spark, sf_dir):
    return _offers(spark, sf_dir)


@query(f"""
SELECT p.sk_product_id, s.sk_salesperson_id, nk_offer_id, o.product_number, nk_created_by, comment, {_OFFER_DATES},
  date_diff('day', valid_from, valid_to) AS offer_duration_days,
  DATE '2024-01-15' BETWEEN valid_from AND valid_to AS is_currently_active
FROM ({_STAGED_OFFERS}) o
LEFT JOIN ({erp.history_sql("dim_product")}) p ON o.product_number = p.product_number
  AND valid_from >= p.__START_AT AND valid_from < coalesce(p.__END_AT, TIMESTAMP '2099-12-31 00:00:00')
LEFT JOIN ({erp.history_sql("dim_salesperson")}) s ON nk_created_by = nk_salesperson_id
  AND valid_from >= s.__START_AT AND valid_from < coalesce(s.__END_AT, TIMESTAMP '2099-12-31 00:00:00')
""")
def dim_product_daily_offer(spark, sf_dir):
    return dims.product_daily_offer(
        _offers(spark, sf_dir),
        erp.history(spark, sf_dir, "dim_product"),
        erp.history(spark, sf_dir, "dim_salesperson"),
        F.lit(dt.date(2024, 1, 15)),
    )


@query(f"""
SELECT {layout_sql(dims.SUPPLIER)} FROM ({erp.SUPPLIERS.sql}) lf
LEFT JOIN ({erp.ADDRESSES.sql}) ad ON lfadnummer = adnummer
LEFT JOIN ({erp.COUNTRIES.sql}) lkz ON adlandkz = lkzlandkz
""")
def stg_supplier_all_columns(spark, sf_dir):
    sources = (erp.SUPPLIERS, erp.ADDRESSES, erp.COUNTRIES)
    staged = dims.stage_supplier(*[s.frame(spark, sf_dir) for s in sources])
    return staged.select(*names(dims.SUPPLIER))


@query(f"""
SELECT {layout_sql(dims.WAREHOUSE)} FROM ({erp.STOCK.sql}) WHERE mlmankey = {dims.WAREHOUSE_TENANT}
""")
def stg_warehouse_all_columns(spark, sf_dir):
    return dims.stage_warehouse(erp.STOCK.frame(spark, sf_dir)).select(*names(dims.WAREHOUSE))
