"""Customer features, indicators and churn scores, as of a fixed day."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.dates import Periods
from ..operators import features as feat
from ..operators.observe import observed
from ..operators.scoring import FLAG_RULES, NO_FLAG, band, explain, read_scaler, scale
from ..operators.scoring import fit_scaler, score_batches
from ..operators.upsert import upsert
from ..plans import churn
from ..sources.tables import mark_run, materialize, materialized_view, new_database
from .base import Derived, query, table

AS_OF = dt.date(2001, 8, 1)
PERIODS = Periods(AS_OF)

INVOICES = Derived("""
SELECT concat('C', o_custkey) AS sk_customer_id, o_orderkey AS nk_document_no,
  CAST(o_orderdate AS DATE) AS invoice_date,
  CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'G' ELSE 'M' END AS document_type_code,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'K' WHEN '5-LOW' THEN NULL
    ELSE 'A' END AS document_category_code,
  CAST(o_totalprice AS DECIMAL(18,2)) AS revenue,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 100 AS DECIMAL(18,2)) AS cost_amount,
  CAST(o_totalprice AS DECIMAL(18,2)) AS header_net_total,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount_paid,
  CAST(o_orderkey % 75 AS INT) AS days_to_pay,
  o_orderstatus = 'O' AS is_credit_note, o_orderkey % 11 = 0 AS is_open
FROM {orders}
""")

CUSTOMERS = Derived("""
SELECT concat('C', c_custkey) AS sk_customer_id, c_name AS customer_name,
  substr(c_mktsegment, 1, 1) AS customer_type, c_mktsegment AS customer_segment,
  CASE WHEN n_nationkey <> 3 THEN n_name END AS country, r_name AS region,
  CAST(c_acctbal AS DECIMAL(18,2)) AS credit_limit, CAST(c_custkey % 5 AS INT) AS discount_pct,
  c_custkey % 2 = 0 AS is_direct_shipping, CAST(NULL AS TIMESTAMP) AS __END_AT
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
""")

_DAY = f"DATE '{AS_OF}'"
_ELIGIBLE = f"""e AS (SELECT * FROM ({INVOICES.sql}) WHERE invoice_date >= DATE '{PERIODS.cutoff}'
  AND document_type_code IN ('F', 'G', 'M', 'N') AND document_category_code NOT IN ('U', 'G'))"""
_IN = {
    "last_3m": f"invoice_date >= {_DAY} - 90",
    "last_6m": f"invoice_date >= {_DAY} - 180",
    "this_year": "invoice_date >= DATE '2001-01-01'",
    "last_year": "invoice_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'",
    "period_last_year": "invoice_date BETWEEN DATE '2000-01-01' AND DATE '2000-08-01'",
}
_COUNTS = ", ".join(
    f"count(DISTINCT CASE WHEN {test} THEN nk_document_no END) AS invoices_{name}"
    for name, test in _IN.items()
)


def _yoy(now: str, before: str) -> str:
    return (
        f"CASE WHEN {before} <> 0 THEN round(CAST({now} - {before} AS DOUBLE) "
        f"/ (abs(CAST({before} AS DOUBLE)) + 1e-6) * 100, 1) END"
    )


_RFM = f"""rfm0 AS (SELECT sk_customer_id,
  date_diff('day', max(invoice_date), {_DAY}) AS recency_days, count(*) AS frequency,
  CAST(sum(revenue) AS DOUBLE) AS monetary_total, avg(revenue) AS monetary_avg,
  coalesce(stddev_samp(revenue), 0) AS monetary_std,
  avg(header_net_total) AS avg_order_value, CAST(max(header_net_total) AS DOUBLE) AS max_order_value,
  CAST(min(header_net_total) AS DOUBLE) AS min_order_value, avg(days_to_pay) AS avg_days_to_pay,
  coalesce(stddev_samp(days_to_pay), 0) AS std_days_to_pay,
  count(*) FILTER (is_credit_note) AS num_credit_notes, count(*) FILTER (is_open) AS num_open_invoices,
  avg(amount_paid) AS avg_amount_paid, 2 AS num_channels,
  count(DISTINCT document_type_code) AS num_doc_types, CAST(sum(cost_amount) AS DOUBLE) AS total_cost,
  CAST(sum(revenue - cost_amount) AS DOUBLE) AS total_profit,
  date_diff('day', min(invoice_date), max(invoice_date)) AS customer_lifetime_days,
  max(invoice_date) AS last_invoice_date, {_COUNTS}
  FROM e GROUP BY 1),
rfm AS (SELECT *, total_profit / (monetary_total + 1e-6) AS profit_margin,
  num_credit_notes / (frequency + 1e-6) AS return_rate,
  frequency / (customer_lifetime_days / 30.0 + 1e-6) AS invoice_frequency_per_month,
  frequency / 44.0 AS total_invoice_per_month,
  {_yoy("invoices_this_year", "invoices_period_last_year")} AS freq_yoy_change_pct FROM rfm0)"""

# Averages and ratios are compared to six digits, deviations to four.
_SIX = (
    "monetary_avg",
    "avg_order_value",
    "avg_days_to_pay",
    "avg_amount_paid",
    "profit_margin",
    "return_rate",
    "invoice_frequency_per_month",
    "total_invoice_per_month",
)
_FOUR = ("monetary_std", "std_days_to_pay")


def invoices(spark, sf_dir) -> DataFrame:
    return INVOICES.frame(spark, sf_dir)


def customers(spark, sf_dir) -> DataFrame:
    return CUSTOMERS.frame(spark, sf_dir)


def _rounded(df: DataFrame, six=_SIX, four=_FOUR) -> DataFrame:
    digits = {**{c: 6 for c in six}, **{c: 4 for c in four}}
    return df.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in digits.items()})


def _sql_rounded(six=_SIX, four=_FOUR) -> str:
    parts = [f"round({c}, 6) AS {c}" for c in six] + [f"round({c}, 4) AS {c}" for c in four]
    return ", ".join(parts)


@query(f"""
WITH {_ELIGIBLE}, {_RFM}
SELECT * REPLACE ({_sql_rounded()}, CAST(last_invoice_date AS VARCHAR) AS last_invoice_date) FROM rfm
""")
def q35_rfm(spark, sf_dir):
    return _rounded(feat.rfm(feat.eligible(invoices(spark, sf_dir), PERIODS), PERIODS))


@query(f"SELECT sk_customer_id, {_COUNTS} FROM ({INVOICES.sql}) GROUP BY 1")
def q36_period_distinct(spark, sf_dir):
    rows = invoices(spark, sf_dir)
    wanted = {f"invoices_{n}": c for n, c in PERIODS.conditions("invoice_date").items()}
    return feat.period_counts(rows, ["sk_customer_id"], "nk_document_no", wanted)


def _revenue(*tests: str) -> str:
    test = " AND ".join(["document_type_code = 'F'", *tests])
    return f"round(sum(CASE WHEN {test} THEN revenue ELSE 0 END), 0)"


_KPIS = f"""k0 AS (SELECT sk_customer_id,
  date_diff('day', max(invoice_date), {_DAY}) AS days_since_last_invoice,
  max(CASE WHEN document_type_code IN ('F', 'G', 'M', 'N') AND document_category_code NOT IN ('U', 'G')
    THEN invoice_date END) AS last_invoice_date,
  count(DISTINCT nk_document_no) AS total_invoices, {_COUNTS},
  count(DISTINCT CASE WHEN document_type_code = 'G' AND {_IN["this_year"]} THEN nk_document_no END)
    AS total_returns,
  {_revenue()} AS total_revenue_eur,
  {_revenue(_IN["period_last_year"])} AS revenue_period_year_eur,
  {_revenue(_IN["this_year"])} AS revenue_this_year_eur,
  {_revenue(_IN["last_year"])} AS revenue_last_year_eur,
  round(avg(CASE WHEN document_type_code = 'F' THEN revenue END), 0) AS avg_invoice_value_eur,
  round(sum(CASE WHEN document_type_code = 'F' THEN revenue - cost_amount ELSE 0 END), 0)
    AS total_gross_profit_eur,
  round(avg(days_to_pay), 1) AS avg_days_to_pay, count(*) FILTER (is_open) AS open_invoices,
  count(*) FILTER (document_category_code = 'K') AS goodwill_gestures
  FROM ({INVOICES.sql}) GROUP BY 1),
kpis AS (SELECT *, CASE WHEN invoices_this_year <> 0
    THEN total_returns / CAST(invoices_this_year AS DOUBLE) * 100 END AS return_rate_pct,
  {_yoy("revenue_this_year_eur", "revenue_period_year_eur")} AS revenue_yoy_change_pct,
  {_yoy("invoices_this_year", "invoices_period_last_year")} AS freq_yoy_change_pct FROM k0)"""
_AMOUNTS = (
    "total_revenue_eur",
    "revenue_period_year_eur",
    "revenue_this_year_eur",
    "revenue_last_year_eur",
    "avg_invoice_value_eur",
    "total_gross_profit_eur",
)
_KPI_SHOWN = f"""* REPLACE (CAST(last_invoice_date AS VARCHAR) AS last_invoice_date,
  round(return_rate_pct, 6) AS return_rate_pct,
  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _AMOUNTS)})"""


@query(f"WITH {_KPIS} SELECT {_KPI_SHOWN} FROM kpis")
def q37_kpi_yoy(spark, sf_dir):
    return _rounded(feat.kpis(invoices(spark, sf_dir), PERIODS), ["return_rate_pct"], [])


@query(f"""
SELECT CAST(o_custkey AS VARCHAR) AS sk_customer_id,
  round(sum(date_diff('day', CAST(o_orderdate AS DATE), {_DAY})) / 43.0, 6) AS cycle_day
FROM orders GROUP BY 1
""")
def q38_life_cycle(spark, sf_dir):
    cycles = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("sk_customer_id"),
        F.datediff(F.lit(AS_OF), F.col("o_orderdate").cast("date")).alias("cycle_day"),
    )
    return _rounded(feat.life_cycle(cycles, PERIODS), ["cycle_day"], [])


def _sql_wide() -> str:
    def value(c: str) -> str:
        whole = c.startswith("is_") or c == "days_to_pay"
        return f"CAST({c} AS {'INTEGER' if whole else 'DOUBLE'})"

    return ", ".join(
        f"coalesce(max(CASE WHEN rn = {s} THEN {value(c)} END), 0) AS seq_{c}_{s}"
        for c in feat.SEQUENCE_COLUMNS
        for s in range(1, feat.SEQUENCE_LENGTH + 1)
    )


_SEQUENCE = f"""seq AS (SELECT sk_customer_id, {_sql_wide()} FROM (
  SELECT *, row_number() OVER (PARTITION BY sk_customer_id ORDER BY invoice_date DESC, nk_document_no DESC) rn
  FROM e) WHERE rn <= {feat.SEQUENCE_LENGTH} GROUP BY 1)"""


@query(f"WITH {_ELIGIBLE}, {_SEQUENCE} SELECT * FROM seq")
def q39_sequence_wide(spark, sf_dir):
    return feat.sequence_wide(feat.eligible(invoices(spark, sf_dir), PERIODS))


@query(f"""
WITH {_ELIGIBLE}, {_SEQUENCE}
SELECT sk_customer_id, {", ".join(
    f"seq_{c}_{s} AS step{s}_{c}" for s in (1, 2, 12) for c in ("days_to_pay", "is_open"))} FROM seq
""")
def q50_sequence_array(spark, sf_dir):
    """Elements of the step-by-feature array a model reads."""
    rows = feat.sequence_array(feat.eligible(invoices(spark, sf_dir), PERIODS))
    return rows.select(
        "sk_customer_id",
        *[
            F.col("sequence")[s - 1][feat.SEQUENCE_COLUMNS.index(c)].cast("int").alias(f"step{s}_{c}")
            for s in (1, 2, 12)
            for c in ("days_to_pay", "is_open")
        ],
    )


_CODES = ", ".join(
    f"dense_rank() OVER (ORDER BY coalesce({c}, 'Unknown')) - 1 AS {c}" for c in churn.CATEGORIES
)
_MATRIX = f"""customers AS ({CUSTOMERS.sql}),
joined AS (SELECT rfm.* REPLACE (coalesce(freq_yoy_change_pct, 0) AS freq_yoy_change_pct),
    customer_type, customer_segment, country, region, CAST(coalesce(credit_limit, 0) AS DOUBLE) AS credit_limit,
    coalesce(discount_pct, 0) AS discount_pct, CAST(is_direct_shipping AS INTEGER) AS is_direct_shipping
  FROM rfm LEFT JOIN customers USING (sk_customer_id)),
matrix AS (SELECT * REPLACE ({_CODES}) FROM joined)"""
_MATRIX_SIX = tuple(c for c in churn.STATIC_FEATURES if c not in _FOUR)


def _matrix(spark, sf_dir) -> DataFrame:
    return churn.features(invoices(spark, sf_dir), customers(spark, sf_dir), PERIODS)


@query(f"""
WITH {_ELIGIBLE}, {_RFM}, {_MATRIX}
SELECT sk_customer_id, {", ".join(
    f"round(CAST({c} AS DOUBLE), {4 if c in _FOUR else 6}) AS {c}" for c in churn.STATIC_FEATURES)}
FROM matrix
""")
def q40_feature_matrix(spark, sf_dir):
    matrix = materialize(_matrix(spark, sf_dir))
    codes = materialize(churn.fit_categories(matrix, churn.CATEGORIES))
    ready = churn.model_input(matrix, codes).select("sk_customer_id", *churn.STATIC_FEATURES)
    return _rounded(ready, _MATRIX_SIX)


_SCALED = ("recency_days", "frequency", "monetary_total", "num_doc_types")


@query(f"""
WITH {_ELIGIBLE}, {_RFM}
SELECT sk_customer_id, {", ".join(
    f"round((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"
    for c in _SCALED)} FROM rfm
""")
def q41_scaled(spark, sf_dir):
    base = feat.eligible(invoices(spark, sf_dir), PERIODS)
    rows = feat.numeric_as_double(feat.rfm(base, PERIODS)).select("sk_customer_id", *_SCALED)
    return _rounded(scale(rows, read_scaler(fit_scaler(rows, _SCALED))), _SCALED, [])


# Weights of a stored model; version 2 is the newest.
_WEIGHTS = {"recency_days": 0.8, "frequency": -0.6, "monetary_total": -0.3, "region": 0.2}
_INTERCEPT = -0.4
MODEL = "churn"


def models(spark) -> DataFrame:
    rows = [(MODEL, "1", c, 0.0) for c in _WEIGHTS]
    rows += [(MODEL, "2", c, w) for c, w in _WEIGHTS.items()]
    rows += [(MODEL, "2", "intercept", _INTERCEPT), ("other", "9", "frequency", 1.0)]
    return spark.createDataFrame(rows, "model STRING, version STRING, feature STRING, weight DOUBLE")


_TERMS = " ".join(
    f"+ ({w}) * ((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / stddev_pop({c}) OVER ())"
    for c, w in _WEIGHTS.items()
)
_BAND = "CASE WHEN p <= 0.3 THEN 'Low' WHEN p <= 0.6 THEN 'Medium' ELSE 'High' END"
_SCORES = f"""probability AS (SELECT sk_customer_id, 1 / (1 + exp(-({_INTERCEPT} {_TERMS}))) AS p FROM matrix),
scores AS (SELECT sk_customer_id, p AS churn_probability, {_BAND} AS churn_risk_label, '2' AS model_version
  FROM probability)"""
_SCORED = f"{_ELIGIBLE}, {_RFM}, {_MATRIX}, {_SCORES}"


def _scores(spark, sf_dir) -> DataFrame:
    # The matrix feeds the fit and the score, so it is computed once.
    matrix = materialize(_matrix(spark, sf_dir))
    codes, scaler = churn.fit(matrix)
    return churn.score(matrix, codes, scaler, models(spark), MODEL)


@query(f"""
WITH {_SCORED}
SELECT sk_customer_id, round(churn_probability, 6) AS churn_probability, churn_risk_label, model_version
FROM scores
""")
def q42_score_band(spark, sf_dir):
    return _rounded(_scores(spark, sf_dir), ["churn_probability"], [])


@query(f"""
WITH {_ELIGIBLE}, {_RFM}, p AS (SELECT sk_customer_id, 1 / (1 + exp(-(0.01 * recency_days - 0.1 * frequency))) AS p
  FROM rfm)
SELECT sk_customer_id, round(p, 4) AS churn_probability, {_BAND} AS churn_risk_label FROM p
""")
def q51_score_batches(spark, sf_dir):
    """The same kind of score from a model that runs on Arrow batches."""
    weights = np.array([0.01, -0.1])
    used = ["recency_days", "frequency"]
    rows = feat.rfm(feat.eligible(invoices(spark, sf_dir), PERIODS), PERIODS)

    def predict(flat, _):
        return 1 / (1 + np.exp(-(flat.astype(float) @ weights)))

    scored = score_batches(rows.select("sk_customer_id", *used), predict, used)
    labelled = scored.withColumn("churn_risk_label", band("churn_probability")).drop(*used)
    return _rounded(labelled, [], ["churn_probability"])


def _flag_sql() -> str:
    signs = {"gt": ">", "lt": "<", "le": "<="}
    return ", ".join(
        f"CASE WHEN {c} {signs[how]} {a} THEN '{a_text}' WHEN {c} {signs[how]} {b} THEN '{b_text}' END AS {flag}"
        for flag, c, how, ((a, a_text), (b, b_text)) in FLAG_RULES
    )


_FLAG_NAMES = ", ".join(r[0] for r in FLAG_RULES)
_EXPLAINED = f"""flagged AS (SELECT *, {_flag_sql()} FROM {{source}}),
explained AS (SELECT *, CASE WHEN concat_ws(' | ', {_FLAG_NAMES}) = '' THEN '{NO_FLAG}'
    ELSE concat_ws(' | ', {_FLAG_NAMES}) END AS churn_reasons,
  len(list_filter([{_FLAG_NAMES}], lambda x: x IS NOT NULL)) AS risk_signal_count FROM flagged)"""


@query(f"""
WITH {_KPIS}, {_EXPLAINED.format(source="kpis")}
SELECT sk_customer_id, {_FLAG_NAMES}, churn_reasons, risk_signal_count FROM explained
""")
def q43_rule_flags(spark, sf_dir):
    explained = explain(feat.kpis(invoices(spark, sf_dir), PERIODS))
    flags = [r[0] for r in FLAG_RULES]
    return explained.select("sk_customer_id", *flags, "churn_reasons", "risk_signal_count")


_CAP = 20
_QUIET = f"date_diff('day', last_invoice_date, {_DAY})"
_BASE = """greatest(CAST(round(churn_probability * 100, 0) AS INTEGER),
  least(90, CAST(risk_signal_count * 20 AS INTEGER)))"""
_DETAILS = f"""{_SCORED}, {_KPIS},
together AS (SELECT s.*, c.customer_name, c.customer_segment, c.country, c.credit_limit,
    k.* EXCLUDE (sk_customer_id)
  FROM scores s LEFT JOIN customers c USING (sk_customer_id) LEFT JOIN kpis k USING (sk_customer_id)),
{_EXPLAINED.format(source="together")},
details AS (SELECT *, CASE WHEN {_QUIET} <= 30 THEN least({_CAP}, {_BASE})
    WHEN ({_QUIET} > 60 AND revenue_this_year_eur < 5000) OR {_QUIET} > 90 THEN 95
    ELSE least(100, {_BASE}) END AS score FROM explained)"""


def _details(spark, sf_dir) -> DataFrame:
    rows = invoices(spark, sf_dir)
    return churn.risk_details(
        _scores(spark, sf_dir), customers(spark, sf_dir), rows, PERIODS, cap=_CAP
    )


@query(f"WITH {_DETAILS} SELECT sk_customer_id, score, churn_risk_label, risk_signal_count FROM details")
def q44_hybrid_score(spark, sf_dir):
    return _details(spark, sf_dir).select(
        "sk_customer_id", "score", "churn_risk_label", "risk_signal_count"
    )


@query(f'WITH {_SCORED} SELECT churn_risk_label, count(*) AS "count" FROM scores GROUP BY 1')
def q45_count_by_label(spark, sf_dir):
    return churn.label_counts(_scores(spark, sf_dir))


def _output_sql() -> str:
    fixed = {
        "years": "'2001'",
        "months": "'8'",
        "created_at": f"'{AS_OF}'",
        "last_invoice_date": "CAST(last_invoice_date AS VARCHAR)",
        "return_rate_pct": "round(return_rate_pct, 6)",
        "credit_limit": "CAST(credit_limit AS DOUBLE)",
        **{c: f"CAST({c} AS DOUBLE)" for c in churn.WHOLE_AMOUNTS},
    }
    pairs = [(c, c) if isinstance(c, str) else c for c in churn.OUTPUT]
    return ", ".join(f"{fixed.get(source, source)} AS {name}" for name, source in pairs)


@query(f"WITH {_DETAILS} SELECT {_output_sql()} FROM details")
def churn_risk_details(spark, sf_dir):
    """The stored monthly result, loaded twice for the same month."""
    details = _details(spark, sf_dir)
    target = f"{new_database(spark)}.churn_risk_details"
    for _ in range(2):
        churn.load_risk_details(spark, target, details, AS_OF)
    return _rounded(spark.read.table(target), ["return_rate_pct"], [])


@query(f"""
WITH {_ELIGIBLE}, {_RFM}
SELECT count(*) AS "rows", count(*) FILTER (freq_yoy_change_pct IS NULL) AS nulls_freq_yoy_change_pct,
  count(*) FILTER (monetary_total IS NULL) AS nulls_monetary_total FROM rfm
""")
def q53_feature_diagnostics(spark, sf_dir):
    """Row and null counts taken while the features are written."""
    rows = feat.rfm(feat.eligible(invoices(spark, sf_dir), PERIODS), PERIODS)
    watched, watch = observed(rows, ["freq_yoy_change_pct", "monetary_total"])
    materialize(watched)
    kinds = ", ".join(f"{name} BIGINT" for name in watch.get)
    return spark.createDataFrame([tuple(watch.get.values())], kinds)


@query("""
SELECT o_custkey AS sk_customer_id, count(*) AS orders FROM orders GROUP BY 1
""")
def q54_materialized_view(spark, sf_dir):
    """A recomputed table with comment, clustering and properties, and a run marker."""
    database = new_database(spark)
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("sk_customer_id"))
    counts = orders.agg(F.count(F.lit(1)).alias("orders"))
    for _ in range(2):
        materialized_view(
            spark, counts, f"{database}.counts", "Orders per customer", ["sk_customer_id"], {"layer": "gold"}
        )
        mark_run(spark, f"{database}.runs")
    assert spark.read.table(f"{database}.runs").count() == 2
    return spark.read.table(f"{database}.counts")


@query(f"""
WITH {_ELIGIBLE}, {_RFM}
SELECT * REPLACE ({_sql_rounded()}, CAST(last_invoice_date AS VARCHAR) AS last_invoice_date) FROM rfm
""")
def q58_rfm_of_stored_fact(spark, sf_dir):
    """Features of a fact that is stored by the month of another date, in two loads."""
    fact = f"{new_database(spark)}.invoices"
    created = F.date_format(F.date_add("invoice_date", -F.pmod("nk_document_no", F.lit(40)).cast("int")), "yyyy-MM")
    rows = invoices(spark, sf_dir).withColumns({"created": created, "row_hash": F.lit("")})
    for part in (F.col("nk_document_no") % 3 > 0, F.lit(True)):
        upsert(spark, fact, rows.where(part), ["nk_document_no", "created"], partition_by=["created"], keep_maxima=["invoice_date"])
    return _rounded(feat.rfm(feat.stored_eligible(spark, fact, PERIODS), PERIODS))


_STEPS = range(1, feat.SEQUENCE_LENGTH + 1)
_LENGTHS = " + ".join(f"seq_days_to_pay_{i}" for i in _STEPS)
_DAYS = " UNION ALL ".join(f"SELECT seq_days_to_pay_{i} AS d FROM seq" for i in _STEPS)


@query(f"""
WITH {_ELIGIBLE}, {_RFM}, {_MATRIX}, {_SEQUENCE},
days AS (SELECT avg(d) AS mean, stddev_pop(d) AS size FROM ({_DAYS})),
static AS (SELECT sk_customer_id, (recency_days - avg(recency_days) OVER ()) / stddev_pop(recency_days) OVER () AS r FROM matrix),
scored AS (SELECT sk_customer_id, 1 / (1 + exp(-(0.5 * r + 0.1 * ({_LENGTHS} - {feat.SEQUENCE_LENGTH} * mean) / size))) AS p
  FROM static JOIN seq USING (sk_customer_id) CROSS JOIN days)
SELECT sk_customer_id, round(p, 2) AS churn_probability, '3' AS model_version FROM scored
""")
def q59_score_two_inputs(spark, sf_dir):
    """A model of static features and scaled sequences, in batches on the executors."""
    rows = invoices(spark, sf_dir)
    matrix = materialize(_matrix(spark, sf_dir))
    codes, scaler = churn.fit(matrix)
    sequences = materialize(feat.sequence_array(feat.eligible(rows, PERIODS)))
    recency = churn.STATIC_FEATURES.index("recency_days")
    days = feat.SEQUENCE_COLUMNS.index("days_to_pay")

    def predict(flat, steps):
        return 1 / (1 + np.exp(-(0.5 * flat[:, recency] + 0.1 * steps[:, :, days].sum(axis=1))))

    fitted = churn.fit_sequences(rows, PERIODS)
    scores = churn.score_with(matrix, sequences, codes, scaler, fitted, predict, 3)
    shown = scores.select("sk_customer_id", "churn_probability", "model_version")
    return shown.withColumn("churn_probability", F.round("churn_probability", 2))


def _kept_sequences(spark, sf_dir) -> DataFrame:
    """Three batches, the last of which holds early invoices and repeats others."""
    rows = feat.eligible(invoices(spark, sf_dir), PERIODS)
    target, number = f"{new_database(spark)}.last_invoices", F.col("nk_document_no")
    late = F.col("invoice_date") < F.lit(dt.date(2000, 1, 1))
    for part in (~late & (number % 2 == 0), ~late & (number % 2 == 1), late | (number % 5 == 0)):
        feat.keep_sequences(spark, target, rows.where(part))
    return feat.stored_steps(spark, target)


@query(f"WITH {_ELIGIBLE}, {_SEQUENCE} SELECT * FROM seq")
def q61_kept_sequences(spark, sf_dir):
    return feat.wide_steps(_kept_sequences(spark, sf_dir))
