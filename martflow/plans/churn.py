"""Churn scoring: features, probability, indicators, reasons and final score."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import Periods
from ..operators.features import (
    CUSTOMER,
    SEQUENCE_COLUMNS,
    eligible,
    feature_matrix,
    kpis,
    life_cycle,
    numeric_as_double,
    rfm,
    sequence_array,
    sequence_wide,
)
from ..operators.scd import current
from ..operators.scoring import (
    band,
    encode,
    explain,
    fit_categories,
    fit_scaler,
    fit_sequence_scaler,
    hybrid_score,
    latest_model,
    logistic,
    numeric,
    read_scaler,
    recent_cap,
    scale,
    scale_sequence,
    score_batches,
)
from ..operators.upsert import replace_period
from ..sources.tables import materialize

# Inputs of the model.
CATEGORIES = ("customer_type", "customer_segment", "country", "region")
STATIC_FEATURES = (
    "recency_days",
    "frequency",
    "monetary_total",
    "monetary_avg",
    "monetary_std",
    "avg_order_value",
    "max_order_value",
    "min_order_value",
    "avg_days_to_pay",
    "std_days_to_pay",
    "num_credit_notes",
    "num_open_invoices",
    "avg_amount_paid",
    "num_channels",
    "num_doc_types",
    "total_cost",
    "total_profit",
    "profit_margin",
    "customer_lifetime_days",
    "invoice_frequency_per_month",
    "return_rate",
    "credit_limit",
    "discount_pct",
    "freq_yoy_change_pct",
    "invoices_last_3m",
    "invoices_last_6m",
    "is_direct_shipping",
    *CATEGORIES,
)
ATTRIBUTES = (*CATEGORIES, "credit_limit", "discount_pct", "is_direct_shipping")

# The period columns of the stored result.
PERIOD = ("years", "months")

# Amounts stored as whole numbers.
WHOLE_AMOUNTS = {
    "total_revenue_eur": "decimal(37,0)",
    "revenue_this_year_eur": "decimal(37,0)",
    "revenue_last_year_eur": "decimal(37,0)",
    "avg_invoice_value_eur": "decimal(33,0)",
    "total_gross_profit_eur": "decimal(37,0)",
}

# Output columns in order; (name, source) where they differ.
OUTPUT = (
    "years",
    "months",
    CUSTOMER,
    ("customer", "customer_name"),
    "customer_segment",
    "country",
    "score",
    "churn_risk_label",
    "churn_reasons",
    "risk_signal_count",
    ("trend_pct", "revenue_yoy_change_pct"),
    "last_invoice_date",
    "days_since_last_invoice",
    "total_invoices",
    "invoices_last_3m",
    "invoices_last_6m",
    "invoices_this_year",
    "invoices_last_year",
    "freq_yoy_change_pct",
    "total_revenue_eur",
    "revenue_this_year_eur",
    "revenue_last_year_eur",
    "avg_invoice_value_eur",
    "total_gross_profit_eur",
    "return_rate_pct",
    "total_returns",
    "avg_days_to_pay",
    "open_invoices",
    "goodwill_gestures",
    "credit_limit",
    "created_at",
    "model_version",
)

SEQUENCE = "sequence"


def features(
    invoices: DataFrame, customers: DataFrame, periods: Periods, cycles: DataFrame | None = None
) -> DataFrame:
    """One row per customer: features, current attributes and the wide sequence."""
    base = eligible(invoices, periods)
    summary = rfm(base, periods)
    if cycles is not None:
        summary = summary.join(life_cycle(cycles, periods), CUSTOMER, "left")
    attributes = current(customers).select(CUSTOMER, *ATTRIBUTES)
    return feature_matrix(summary, attributes, sequence_wide(base))


def model_input(matrix: DataFrame, codes: DataFrame) -> DataFrame:
    """Encoded categories and plain numbers, ready to scale."""
    used = matrix.select(CUSTOMER, *STATIC_FEATURES)
    coded = encode(numeric_as_double(used), codes, CATEGORIES)
    return coded.select(CUSTOMER, *[numeric(c).alias(c) for c in STATIC_FEATURES])


def fit(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Category codes and feature scaler, to be stored with the model."""
    codes = materialize(fit_categories(matrix, CATEGORIES))
    return codes, fit_scaler(model_input(matrix, codes), STATIC_FEATURES)


def fit_sequences(invoices: DataFrame, periods: Periods) -> DataFrame:
    """Scaler of the sequence features, over all steps of all customers."""
    steps = sequence_array(eligible(invoices, periods))
    return fit_sequence_scaler(steps, SEQUENCE, SEQUENCE_COLUMNS)


def score(
    matrix: DataFrame,
    codes: DataFrame,
    scaler: DataFrame,
    models: DataFrame,
    model: str,
) -> DataFrame:
    """Score with the newest stored weights, as column expressions."""
    version, weights = latest_model(models, model)
    intercept = weights.pop("intercept", 0.0)
    ready = scale(model_input(matrix, codes), read_scaler(scaler))
    return _scored(ready.withColumn("churn_probability", logistic(weights, intercept)), version)


def score_with(
    matrix: DataFrame,
    sequences: DataFrame,
    codes: DataFrame,
    scaler: DataFrame,
    sequence_scaler: DataFrame,
    predict: Callable,
    version: int,
) -> DataFrame:
    """Score with any two-input model, in batches on the executors."""
    ready = scale(model_input(matrix, codes), read_scaler(scaler))
    steps = scale_sequence(sequences, SEQUENCE, SEQUENCE_COLUMNS, read_scaler(sequence_scaler))
    both = ready.join(steps, CUSTOMER)
    return _scored(score_batches(both, predict, STATIC_FEATURES, SEQUENCE), version)


def _scored(df: DataFrame, version: int) -> DataFrame:
    return df.select(
        CUSTOMER,
        "churn_probability",
        band("churn_probability").alias("churn_risk_label"),
        F.lit(str(version)).alias("model_version"),
    )


def risk_details(
    scores: DataFrame,
    customers: DataFrame,
    invoices: DataFrame,
    periods: Periods,
    cap: Column | int | None = None,
) -> DataFrame:
    """Scores with customer, indicators, reasons and the hybrid score."""
    who = current(customers).select(
        CUSTOMER, "customer_name", "customer_segment", "country", "credit_limit"
    )
    joined = scores.join(who, CUSTOMER, "left").join(kpis(invoices, periods), CUSTOMER, "left")
    explained = explain(joined).withColumns(
        {
            "score": hybrid_score(periods.as_of, recent_cap(CUSTOMER) if cap is None else cap),
            "created_at": F.lit(periods.as_of),
            "years": F.lit(str(periods.as_of.year)),
            "months": F.lit(str(periods.as_of.month)),
            **{c: F.col(c).cast(kind) for c, kind in WHOLE_AMOUNTS.items()},
        }
    )
    pairs = [(c, c) if isinstance(c, str) else c for c in OUTPUT]
    return explained.select(*[F.col(source).alias(name) for name, source in pairs])


def load_risk_details(
    spark: SparkSession, table: str, details: DataFrame, as_of: dt.date
) -> None:
    """Store one month of scores in place of an earlier run of that month.

    Rows are sorted by score within each file; readers order them globally.
    """
    period = dict(zip(PERIOD, (str(as_of.year), str(as_of.month))))
    replace_period(spark, table, details, period, order_by=[F.col("score").desc()])


def top_risks(details: DataFrame) -> DataFrame:
    """The details from the highest score down."""
    return details.orderBy(F.col("score").desc(), CUSTOMER)


def label_counts(scores: DataFrame, label: str = "churn_risk_label") -> DataFrame:
    return scores.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(label)


__all__: Sequence[str] = [
    "Periods",
    "features",
    "fit",
    "fit_sequences",
    "label_counts",
    "load_risk_details",
    "model_input",
    "risk_details",
    "score",
    "score_with",
    "top_risks",
]
