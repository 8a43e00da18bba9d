"""ERP source tables derived from the test tables, and dimension histories.

Customers have even address numbers and suppliers odd ones.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators.scd import scd2_apply
from ..plans import dimensions as dims
from ..plans.history import DIMENSIONS, first_history
from ..sources.tables import materialize
from .base import Derived, sql_key

CUSTOMERS = Derived("""
SELECT c_custkey AS kdnummer, c_custkey % 20 AS kdbnummer, c_custkey * 2 AS kdadnummer,
  c_custkey % 30 AS kdvart, c_custkey % 40 AS kdzbkenn, concat(' ', c_mktsegment, ' ') AS kdrating,
  substr(c_mktsegment, 1, 1) AS kdtyp, c_custkey % 9 AS kdarchiv, c_custkey % 3 - 1 AS kdliefsp,
  CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 4 END AS kddsgvo,
  CASE WHEN c_custkey % 4 <> 0 THEN 'USD ' END AS kdwaeh,
  CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS kdlimit,
  CAST(NULL AS INT) AS kdrabatt
FROM {customer}
""").wide((dims.CUSTOMER, "kd."))

ADDRESSES = Derived("""
SELECT c_custkey * 2 AS adnummer, c_name AS adname1,
  CASE WHEN c_custkey % 3 = 0 THEN ' GmbH ' END AS adname2,
  concat('Street ', c_nationkey) AS adstrasse, CAST(c_custkey % 90 AS STRING) AS adhausnr,
  concat('Z', c_nationkey, ' ') AS adplz, c_mktsegment AS adort,
  CASE WHEN c_nationkey = 0 THEN 'D' WHEN c_nationkey = 1 THEN ' ' WHEN c_nationkey = 2 THEN NULL
    ELSE concat('N', c_nationkey) END AS adlandkz,
  CASE WHEN c_nationkey > 20 THEN 'Far away' ELSE ' ' END AS adland,
  CAST(NULL AS STRING) AS adurl
FROM {customer}
UNION ALL
SELECT s_suppkey * 2 + 1, s_name, CASE WHEN s_suppkey % 4 = 0 THEN ' AG ' END,
  concat('Road ', s_nationkey), CAST(s_suppkey % 70 AS STRING), concat('Z', s_nationkey, ' '), 'City',
  concat('N', s_nationkey), ' ', concat('www.', s_suppkey)
FROM {supplier}
""").wide((dims.CUSTOMER, "ad."), (dims.SUPPLIER, "ad."), (dims.SUPPLIER_ADDRESS, "a."))

COUNTRIES = Derived("""
SELECT concat('N', n_nationkey) AS lkzlandkz, concat(n_name, ' ') AS lkzland,
  CASE n_regionkey WHEN 3 THEN 1 WHEN 4 THEN NULL ELSE 0 END AS lkzeuaus
FROM {nation}
""")

ADDRESS_LINKS = Derived("""
SELECT c_custkey * 2 AS kradnummer, CASE WHEN c_nationkey < 12 THEN 'A' ELSE ' ' END AS krakenn,
  c_custkey % 2 AS krdirekt
FROM {customer}
""")

# The orders of a customer stand for its contacts, numbered within the address.
CONTACTS = Derived("""
SELECT o_custkey * 2 AS panummer, year(o_orderdate) - 1994 AS palfdnr,
  concat('mail', o_orderkey) AS paemail, concat(' +', o_orderkey) AS patelefon1,
  o_orderpriority AS paname1, CAST(NULL AS STRING) AS paname2
FROM {orders}
""").wide((dims.SUPPLIER_ADDRESS, "ap."))

CATEGORY_LINKS_OF_CUSTOMERS = Derived("""
SELECT c_custkey AS kknummer, c_mktsegment AS kkkat, c_custkey % 3 AS kklfdnr FROM {customer}
""")

CUSTOMER_CATEGORIES = Derived("""
SELECT DISTINCT c_mktsegment AS kakat, concat(' ', lower(c_mktsegment)) AS katext,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN substr(c_mktsegment, 1, 2) END AS kaparent
FROM {customer}
""")

SHIPPING = Derived("""
SELECT s_suppkey AS kovnummer, s_name AS kotext, CASE WHEN s_nationkey <> 5 THEN s_nationkey END AS kovskenn,
  CAST(s_acctbal AS DECIMAL(18,2)) AS koversand, CASE WHEN s_nationkey = 24 THEN 1 ELSE 0 END AS kovmankey
FROM {supplier}
""").wide((dims.SHIPPING_METHOD, ""))

PAYMENT_TERMS = Derived("""
SELECT s_suppkey AS kzzb, concat('Term ', s_nationkey) AS kztext1, s_nationkey % 4 AS kzskproz,
  CASE WHEN s_nationkey <> 6 THEN s_nationkey END AS kzsktage, CAST(s_acctbal AS DECIMAL(18,2)) AS kzmindbetr,
  CASE WHEN s_nationkey = 23 THEN 0 ELSE 1 END AS kzmankey
FROM {supplier}
""").wide((dims.PAYMENT_TERM, ""))

PEOPLE = Derived("""
SELECT s_suppkey AS kobnummer, concat(' ', s_name) AS kobname,
  CASE WHEN s_nationkey <> 7 THEN concat('F', s_nationkey) END AS kobvname, 'Sales ' AS kobfunk,
  CAST(s_nationkey AS STRING) AS kobfil, CAST(NULL AS STRING) AS kobemail,
  CASE WHEN s_nationkey > 20 THEN 1 ELSE 0 END AS kobarchiv, CAST(NULL AS INT) AS kobminroh
FROM {supplier}
""")

PRODUCTS = Derived("""
SELECT p_partkey AS aridnr, concat('P', p_partkey, ' ') AS aranummer, concat(' ', p_name) AS arben,
  concat(p_name, ' ', p_type) AS arerwben, p_type AS artyp,
  CASE WHEN p_size > 5 THEN CAST(p_size AS STRING) END AS arherstnr, p_brand AS arkzselekt,
  CASE WHEN p_size > 10 THEN p_size END AS arme, CASE WHEN p_size > 20 THEN p_size END AS arpe,
  p_size > 25 AS arlagware, p_size - 40 AS arauslauf, CASE WHEN p_size > 30 THEN 1 END AS arnoaktiv,
  CAST(NULL AS INT) AS arsernr, CAST(NULL AS BOOLEAN) AS arnuronline, CAST(NULL AS BOOLEAN) AS arkeinprov,
  CAST(CASE WHEN p_size > 3 THEN '2019-05-06 07:08:09' END AS TIMESTAMP) AS areingabe,
  CAST(CASE WHEN p_size > 1 THEN '2020-01-02 03:04:05' END AS TIMESTAMP) AS updtime
FROM {part}
""").wide((dims.PRODUCT, "a."))

PRODUCT_CATEGORY_LINKS = Derived("""
SELECT l_partkey AS kkidnr, l_linenumber AS kklfdnr, l_returnflag AS kkkat FROM {lineitem}
""")

PRODUCT_CATEGORIES = Derived("""
SELECT DISTINCT l_returnflag AS kakat, CASE WHEN l_returnflag <> 'N' THEN concat('Group ', l_returnflag) END AS katext,
  'Other text' AS kaotext, CASE WHEN l_returnflag = 'R' THEN 'A' ELSE ' ' END AS kaobkat,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS kaoaktiv
FROM {lineitem}
""")

MAKERS = Derived("""
SELECT DISTINCT p_brand AS kohkenn, concat('Maker ', p_brand) AS kohtext FROM {part} WHERE p_brand <> 'Brand#1'
""")

STOCK = Derived("""
SELECT l_partkey AS mlidnr, l_linestatus AS mllager, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS mlekpreis,
  min(CAST(l_extendedprice AS DECIMAL(18,2))) AS mlekprep, CAST(max(l_tax) AS DECIMAL(18,2)) AS mlekrein,
  count(*) AS mlbestand, CASE WHEN l_linestatus = 'F' THEN 1 ELSE max(l_linenumber) % 2 END AS mlmankey
FROM {lineitem} GROUP BY l_partkey, l_linestatus
""").wide((dims.WAREHOUSE, ""))

SUPPLIERS = Derived("""
SELECT s_suppkey AS lfnummer, s_suppkey * 2 + 1 AS lfadnummer, s_nationkey % 2 AS lfmankey,
  CASE WHEN s_nationkey > 12 THEN 'CHF' END AS lfwae, concat(' ', s_nationkey) AS lfzb,
  CASE WHEN s_nationkey > 22 THEN 1 ELSE 0 END AS lfarchiv
FROM {supplier}
""").wide((dims.SUPPLIER, "lf."), (dims.SUPPLIER_ADDRESS, "l."))

SUPPLIER_ADDRESS_LINKS = Derived("""
SELECT s_suppkey AS lanummer, s_nationkey % 2 AS lamankey, s_suppkey * 2 + 1 AS laadnummer, 1 AS lalfdnr,
  'Z ' AS laakenn, 0 AS lanoaktiv FROM {supplier}
UNION ALL SELECT s_suppkey, 1, s_suppkey * 2, 2, CASE WHEN s_nationkey > 12 THEN 'B' ELSE 'X' END, 1 FROM {supplier}
""").wide((dims.SUPPLIER_ADDRESS, "la."))

OFFERS = Derived("""
SELECT concat(' ', event_id) AS id, concat('P', user_id) AS itemnr, user_id AS createdby, ts AS {q}from{q},
  CAST(CASE event_type WHEN 'view' THEN '2024-01-20 00:00:00' ELSE '2024-02-10 00:00:00' END AS TIMESTAMP) AS {q}to{q},
  CASE WHEN event_type <> 'click' THEN concat(event_type, ' ') END AS comment, ts AS created
FROM {events}
""")

FIRST = dt.datetime(1995, 1, 1)
SECOND = dt.datetime(1998, 6, 15, 12)


@dataclass(frozen=True)
class Staged:
    """A staged dimension, its key columns in SQL, and how a second snapshot differs."""

    frame: Callable
    sql: str
    surrogate: str
    shown: tuple[str, ...]
    # SQL conditions on the staged columns, the same in both engines.
    changes: str
    absent: str
    arrives: str
    text: str


def _customer(spark, d, compat=False):
    return dims.stage_customer(
        CUSTOMERS.frame(spark, d),
        ADDRESSES.frame(spark, d),
        COUNTRIES.frame(spark, d),
        ADDRESS_LINKS.frame(spark, d),
        CONTACTS.frame(spark, d),
        first_history(_shipping(spark, d), FIRST),
        first_history(_payment(spark, d), FIRST),
        compat,
    )


def _shipping(spark, d):
    return dims.stage_shipping_method(SHIPPING.frame(spark, d))


def _payment(spark, d):
    return dims.stage_payment_term(PAYMENT_TERMS.frame(spark, d))


def _product(spark, d):
    return dims.stage_product(
        PRODUCTS.frame(spark, d),
        PRODUCT_CATEGORY_LINKS.frame(spark, d),
        PRODUCT_CATEGORIES.frame(spark, d),
        MAKERS.frame(spark, d),
    )


def _category(spark, d):
    return dims.stage_product_category(PRODUCT_CATEGORIES.frame(spark, d))


def _salesperson(spark, d):
    return dims.stage_salesperson(PEOPLE.frame(spark, d))


def _supplier(spark, d):
    return dims.stage_supplier(SUPPLIERS.frame(spark, d), ADDRESSES.frame(spark, d), COUNTRIES.frame(spark, d))


def _supplier_address(spark, d):
    staged = dims.stage_supplier_address(
        SUPPLIERS.frame(spark, d),
        SUPPLIER_ADDRESS_LINKS.frame(spark, d),
        ADDRESSES.frame(spark, d),
        COUNTRIES.frame(spark, d),
        CONTACTS.frame(spark, d),
    )
    return dims.enrich_supplier_address(staged, history(spark, d, "dim_supplier"))


def _warehouse(spark, d):
    return dims.stage_warehouse(STOCK.frame(spark, d))


_SHIPPING_SQL = f"""SELECT {sql_key("kovnummer", "kotext", "kovskenn", "koversand")} AS sk_shipping_method_id,
  kovnummer AS nk_shipping_method_id, kotext AS shipping_method_name, kovskenn AS shipping_type_flag,
  koversand AS shipping_rate FROM ({SHIPPING.sql}) WHERE kovmankey = 0"""
_PAYMENT_SQL = f"""SELECT {sql_key("kzzb", "kztext1", "kzskproz", "kzsktage")} AS sk_payment_term_id,
  kzzb AS nk_payment_term_id, kztext1 AS payment_term_name, kzskproz AS cash_discount_pct,
  kzsktage AS cash_discount_days, kzmindbetr AS minimum_order_value FROM ({PAYMENT_TERMS.sql}) WHERE kzmankey = 1"""

_CUSTOMER_KEY = sql_key(
    "kdnummer",
    "kdbnummer",
    *[f"coalesce({c}, '')" for c in ("adname1", "adname2", "patelefon1", "paemail", "adstrasse", "adhausnr")],
)
_CUSTOMER_SQL = f"""SELECT {_CUSTOMER_KEY} AS sk_customer_id, kdnummer AS nk_customer_id,
  kdbnummer AS account_manager_id, sk_shipping_method_id, sk_payment_term_id,
  trim(concat_ws(' ', coalesce(adname1, ''), coalesce(adname2, ''))) AS customer_name,
  trim(coalesce(adname2, '')) AS customer_name2, trim(coalesce(kdrating, '')) AS customer_segment,
  trim(coalesce(patelefon1, '')) AS phone, trim(coalesce(paemail, '')) AS email,
  trim(coalesce(adstrasse, '')) AS street, trim(coalesce(adhausnr, '')) AS house_number,
  trim(coalesce(adplz, '')) AS postal_code, trim(coalesce(adlandkz, '')) AS country_code,
  CASE WHEN rtrim(adlandkz) IN ('D', '') THEN 'Germany (DE)'
       WHEN adlandkz IS NOT NULL AND lkzeuaus = 1 THEN 'EU (ex. DE)'
       WHEN adlandkz IS NOT NULL AND lkzeuaus = 0 THEN 'Non-EU/International' END AS region,
  kdtyp AS customer_type, kdarchiv = 0 AS is_active, kdliefsp > 0 AS has_delivery_block,
  coalesce(kddsgvo > 0, false) AS gdpr_blocked, trim(coalesce(kdwaeh, 'EUR')) AS currency_code,
  CAST(coalesce(kdlimit, 0) AS DOUBLE) AS credit_limit, coalesce(kdrabatt, 0) AS discount_pct,
  CASE WHEN rtrim(adland) <> '' THEN adland ELSE 'Deutschland' END AS country,
  coalesce(krdirekt = 1, false) AS is_direct_shipping
FROM ({CUSTOMERS.sql}) kd LEFT JOIN ({ADDRESSES.sql}) ad ON kdadnummer = adnummer
LEFT JOIN ({COUNTRIES.sql}) kl ON lkzlandkz = adlandkz
LEFT JOIN (SELECT * FROM ({ADDRESS_LINKS.sql}) WHERE krakenn <> ' ') ka ON kradnummer = adnummer
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY panummer
    ORDER BY palfdnr DESC, paemail, patelefon1) rn FROM ({CONTACTS.sql})) WHERE rn = 1) pa ON panummer = adnummer
LEFT JOIN ({_SHIPPING_SQL}) sh ON kdvart = nk_shipping_method_id
LEFT JOIN ({_PAYMENT_SQL}) pt ON kdzbkenn = nk_payment_term_id"""

_PRODUCT_KEY = sql_key("aridnr", *[f"coalesce({c}, '')" for c in ("aranummer", "arben", "artyp", "arherstnr")])
_PRODUCT_SQL = f"""SELECT {_PRODUCT_KEY} AS sk_product_id, aridnr AS nk_product_id, trim(aranummer) AS product_number,
  trim(arben) AS product_name, substr(trim(arerwben), 1, 500) AS product_name_ext, artyp AS product_type,
  coalesce(kkkat, '') AS nk_category_id, trim(coalesce(katext, kaotext, '')) AS category_name,
  trim(coalesce(kaobkat, '')) AS parent_category, coalesce(arherstnr, '') AS manufacturer_no,
  trim(coalesce(kohtext, arkzselekt, 'Unknown')) AS manufacturer_name, coalesce(arme, 0) AS unit_of_measure,
  coalesce(arpe, 1) AS price_unit, arlagware AS is_stock_item, arauslauf > 0 AS is_discontinued,
  coalesce(arnoaktiv, 0) = 0 AS is_active, false AS is_serial_tracked,
  strftime(coalesce(areingabe, updtime, TIMESTAMP '2000-01-01 00:00:00'), '%Y-%m-%d %H:%M:%S') AS created_date
FROM ({PRODUCTS.sql}) a
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kkidnr ORDER BY kklfdnr, kkkat) rn
  FROM ({PRODUCT_CATEGORY_LINKS.sql})) WHERE rn = 1) ak ON aridnr = kkidnr
LEFT JOIN ({PRODUCT_CATEGORIES.sql}) kc ON kkkat = kakat
LEFT JOIN ({MAKERS.sql}) kh ON arkzselekt = kohkenn"""

_CATEGORY_KEY = sql_key("kakat", "coalesce(katext, '')", "coalesce(kaobkat, '')", "kaoaktiv")
_CATEGORY_SQL = f"""SELECT {_CATEGORY_KEY} AS sk_category_id, kakat AS nk_category_id,
  coalesce(katext, '') AS category_name, trim(kaobkat) AS parent_code,
  CASE WHEN trim(kaobkat) = '' THEN 1 ELSE 2 END AS depth_level, kaoaktiv > 0 AS is_online
FROM ({PRODUCT_CATEGORIES.sql})"""

_PERSON_KEY = sql_key(
    "kobnummer", *[f"coalesce({c}, '')" for c in ("kobname", "kobvname", "kobfunk", "kobfil")]
)
_SALESPERSON_SQL = f"""SELECT {_PERSON_KEY} AS sk_salesperson_id, kobnummer AS nk_salesperson_id,
  concat_ws(' ', trim(kobname), trim(coalesce(kobvname, ''))) AS full_name, trim(kobname) AS last_name,
  trim(coalesce(kobvname, '')) AS first_name, '' AS email, trim(kobfunk) AS department, kobfil AS branch_code,
  kobarchiv = 0 AS is_active, 0 AS min_gross_profit FROM ({PEOPLE.sql})"""

_SUPPLIER_KEY = sql_key("lfnummer", "adname1", "adname2", "adstrasse", "adhausnr", "adurl")
_SUPPLIER_SQL = f"""SELECT {_SUPPLIER_KEY} AS sk_supplier_id, lfnummer AS nk_supplier_id,
  trim(concat_ws(' ', coalesce(adname1, ''), coalesce(adname2, ''))) AS supplier_name, adstrasse AS street,
  adhausnr AS house_number, adlandkz AS country_code, trim(coalesce(lkzland, '')) AS country_name,
  coalesce(adurl, '') AS website, coalesce(lfwae, 'EUR') AS currency_code, trim(lfzb) AS payment_terms,
  lfarchiv = 0 AS is_active
FROM ({SUPPLIERS.sql}) lf LEFT JOIN ({ADDRESSES.sql}) ad ON lfadnummer = adnummer
LEFT JOIN ({COUNTRIES.sql}) lkz ON adlandkz = lkzlandkz"""

_ADDRESS_KEY = sql_key("lfnummer", "lalfdnr", "adname1", "adname2", "adstrasse")


def _address_sql() -> str:
    return f"""SELECT {_ADDRESS_KEY} AS sk_supplier_address_id, lfnummer AS nk_supplier_id,
  lalfdnr AS address_seq_no, trim(laakenn) AS address_type_code,
  CASE trim(laakenn) WHEN 'Z' THEN 'Payment address' WHEN 'S' THEN 'Service address'
    WHEN 'B' THEN 'Order address' ELSE 'Unknown' END AS address_type, lanoaktiv = 0 AS is_active,
  trim(concat_ws(' ', coalesce(adname1, ''), coalesce(adname2, ''))) AS full_name, adstrasse AS street,
  trim(coalesce(lkzland, '')) AS country_name, sk_supplier_id
FROM ({SUPPLIERS.sql}) l JOIN ({SUPPLIER_ADDRESS_LINKS.sql}) la ON lanummer = lfnummer AND lamankey = lfmankey
JOIN ({ADDRESSES.sql}) a ON adnummer = laadnummer
LEFT JOIN ({COUNTRIES.sql}) lkz ON lkzlandkz = adlandkz
LEFT JOIN (SELECT nk_supplier_id k, sk_supplier_id FROM ({history_sql("dim_supplier")}) WHERE __END_AT IS NULL) d
  ON lfnummer = d.k"""


_WAREHOUSE_SQL = f"""SELECT {sql_key("mlidnr", "mllager")} AS sk_warehouse_id, mlidnr AS nk_warehouse_id,
  mllager AS warehouse_name, mlekpreis AS purchase_price_avg, mlekprep AS purchase_price_repair,
  mlekrein AS purchase_price_net, mlbestand AS stock_available FROM ({STOCK.sql}) WHERE mlmankey = 1"""


def _numeric(key: str) -> dict[str, str]:
    return {"changes": f"{key} % 7 = 0", "absent": f"{key} % 11 = 5", "arrives": f"{key} % 10 = 9"}


def history_sql(name: str) -> str:
    """The history after two snapshots, as SQL over the staged dimension."""
    s = STAGED[name]
    both = f"NOT ({s.absent}) AND NOT ({s.arrives})"
    first, second = f"TIMESTAMP '{FIRST}'", f"TIMESTAMP '{SECOND}'"
    new = f"* REPLACE ({s.text} || '*' AS {s.text}, {s.surrogate} || '*' AS {s.surrogate})"
    plain, gone, late = f"NOT ({s.changes})", f"({s.absent}) AND NOT ({s.arrives})", f"({s.arrives}) AND NOT ({s.absent})"
    return f"""
SELECT *, {first} AS __START_AT, CAST(NULL AS TIMESTAMP) AS __END_AT FROM ({s.sql}) WHERE {both} AND {plain}
UNION ALL SELECT *, {first}, {second} FROM ({s.sql}) WHERE {both} AND ({s.changes})
UNION ALL SELECT {new}, {second}, NULL FROM ({s.sql}) WHERE {both} AND ({s.changes})
UNION ALL SELECT *, {first}, {second} FROM ({s.sql}) WHERE {gone}
UNION ALL SELECT *, {second}, NULL FROM ({s.sql}) WHERE {late} AND {plain}
UNION ALL SELECT {new}, {second}, NULL FROM ({s.sql}) WHERE {late} AND ({s.changes})"""


def snapshots(spark, sf_dir, name: str, narrow: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two snapshots of a staged dimension, which is computed once."""
    s = STAGED[name]
    staged = s.frame(spark, sf_dir)
    staged = materialize(staged.select(*s.shown) if narrow else staged)
    changed = {c: F.when(F.expr(s.changes), F.concat(c, F.lit("*"))).otherwise(F.col(c)) for c in (s.text, s.surrogate)}
    return staged.where(f"NOT ({s.arrives})"), staged.where(f"NOT ({s.absent})").withColumns(changed)


def history(spark, sf_dir, name: str) -> DataFrame:
    """The history after the two snapshots, stored for lookups."""
    first, second = snapshots(spark, sf_dir, name, narrow=True)
    spec = DIMENSIONS[name]
    versions = scd2_apply(first_history(first, FIRST), second, spec.keys, spec.tracked, SECOND)
    return materialize(versions)


STAGED: dict[str, Staged] = {}
STAGED["dim_customer"] = Staged(
    _customer,
    _CUSTOMER_SQL,
    "sk_customer_id",
    tuple(
        """sk_customer_id nk_customer_id account_manager_id sk_shipping_method_id sk_payment_term_id customer_name
        customer_name2 customer_segment phone email street house_number postal_code country_code region
        customer_type is_active has_delivery_block gdpr_blocked currency_code credit_limit discount_pct country
        is_direct_shipping""".split()
    ),
    **_numeric("nk_customer_id"),
    text="customer_name",
)
STAGED["dim_product"] = Staged(
    _product,
    _PRODUCT_SQL,
    "sk_product_id",
    tuple(
        """sk_product_id nk_product_id product_number product_name product_name_ext product_type nk_category_id
        category_name parent_category manufacturer_no manufacturer_name unit_of_measure price_unit is_stock_item
        is_discontinued is_active is_serial_tracked created_date""".split()
    ),
    **_numeric("nk_product_id"),
    text="product_name",
)
STAGED["dim_product_category"] = Staged(
    _category,
    _CATEGORY_SQL,
    "sk_category_id",
    tuple("sk_category_id nk_category_id category_name parent_code depth_level is_online".split()),
    changes="nk_category_id = 'A'",
    absent="nk_category_id = 'N'",
    arrives="nk_category_id = 'R'",
    text="category_name",
)
STAGED["dim_salesperson"] = Staged(
    _salesperson,
    _SALESPERSON_SQL,
    "sk_salesperson_id",
    tuple(
        """sk_salesperson_id nk_salesperson_id full_name last_name first_name email department branch_code
        is_active min_gross_profit""".split()
    ),
    **_numeric("nk_salesperson_id"),
    text="last_name",
)
STAGED["dim_supplier"] = Staged(
    _supplier,
    _SUPPLIER_SQL,
    "sk_supplier_id",
    tuple(
        """sk_supplier_id nk_supplier_id supplier_name street house_number country_code country_name website
        currency_code payment_terms is_active""".split()
    ),
    **_numeric("nk_supplier_id"),
    text="supplier_name",
)
STAGED["dim_warehouse"] = Staged(
    _warehouse,
    _WAREHOUSE_SQL,
    "sk_warehouse_id",
    tuple(
        """sk_warehouse_id nk_warehouse_id warehouse_name purchase_price_avg purchase_price_repair
        purchase_price_net stock_available""".split()
    ),
    changes="false",
    absent="nk_warehouse_id % 11 = 5",
    arrives="nk_warehouse_id % 10 = 9",
    text="warehouse_name",
)
STAGED["dim_payment_term"] = Staged(
    _payment,
    _PAYMENT_SQL,
    "sk_payment_term_id",
    tuple(
        """sk_payment_term_id nk_payment_term_id payment_term_name cash_discount_pct cash_discount_days
        minimum_order_value""".split()
    ),
    **_numeric("nk_payment_term_id"),
    text="payment_term_name",
)
STAGED["dim_shipping_method"] = Staged(
    _shipping,
    _SHIPPING_SQL,
    "sk_shipping_method_id",
    tuple(
        """sk_shipping_method_id nk_shipping_method_id shipping_method_name shipping_type_flag
        shipping_rate""".split()
    ),
    **_numeric("nk_shipping_method_id"),
    text="shipping_method_name",
)
STAGED["dim_supplier_address"] = Staged(
    _supplier_address,
    _address_sql(),
    "sk_supplier_address_id",
    tuple(
        """sk_supplier_address_id nk_supplier_id address_seq_no address_type_code address_type is_active full_name
        street country_name sk_supplier_id""".split()
    ),
    **_numeric("nk_supplier_id"),
    text="full_name",
)
