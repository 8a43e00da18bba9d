"""Encoding, scaling, scoring and explaining customers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..sources.tables import materialize

# Risk bands, upper bound included.
BANDS = ((0.3, "Low"), (0.6, "Medium"), (1.0, "High"))

# Flag, indicator, comparison, then threshold and text per level.
FLAG_RULES = (
    (
        "flag_no_recent_order",
        "days_since_last_invoice",
        "gt",
        ((90, "No order in 90+ days"), (60, "No order in 60+ days")),
    ),
    (
        "flag_revenue_decline",
        "revenue_yoy_change_pct",
        "lt",
        ((-30, "Revenue dropped >30% YoY"), (-10, "Revenue dropped >10% YoY")),
    ),
    (
        "flag_frequency_decline",
        "freq_yoy_change_pct",
        "lt",
        ((-30, "Order freq dropped >30% YoY"), (-10, "Order freq dropped >10% YoY")),
    ),
    (
        "flag_high_return_rate",
        "return_rate_pct",
        "gt",
        ((20, "Return rate >20%"), (10, "Return rate >10%")),
    ),
    (
        "flag_payment_delay",
        "avg_days_to_pay",
        "gt",
        ((60, "Avg payment delay >60 days"), (30, "Avg payment delay >30 days")),
    ),
    (
        "flag_open_invoices",
        "open_invoices",
        "gt",
        ((5, "5+ unpaid invoices"), (2, "2+ unpaid invoices")),
    ),
    (
        "flag_low_activity_3m",
        "invoices_last_3m",
        "le",
        ((0, "Zero orders last 3 months"), (1, "Only 1 order last 3 months")),
    ),
)
NO_FLAG = "Model pattern — no explicit flag"
REASON_SEPARATOR = " | "

# Fixed values of the hybrid score.
RECENT_DAYS = 30
RECENT_CAP = (10, 25)
QUIET_DAYS = 60
QUIET_REVENUE = 5000
LOST_DAYS = 90
LOST_SCORE = 95
SIGNAL_POINTS = 20
SIGNAL_MAX = 90

UNKNOWN = "Unknown"
UNSEEN_CODE = -1


def fit_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Code table ``attribute, value, code``: values in order, from 0.

    Fit once and store it, so a category keeps its code in later batches. Only
    the distinct values are shuffled. They are numbered within ranges of values,
    then shifted by the size of the ranges before, so no task holds them all.
    """
    pairs = [
        F.struct(F.lit(c).alias("attribute"), F.coalesce(F.col(c), F.lit(UNKNOWN)).alias("value"))
        for c in columns
    ]
    values = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()
    by_range = values.repartitionByRange("attribute", "value")
    placed = materialize(by_range.withColumn("range", F.spark_partition_id()))
    earlier = Window.partitionBy("attribute").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("attribute", "range").agg(F.count(F.lit(1)).alias("size"))
    shift = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    inside = Window.partitionBy("attribute", "range").orderBy("value")
    return placed.join(
        sizes.select("attribute", "range", shift.alias("shift")), ["attribute", "range"]
    ).select(
        "attribute", "value", (F.row_number().over(inside) - 1 + F.col("shift")).cast("int").alias("code")
    )


def encode(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their codes; values never fitted become -1.

    ``codes`` should be a stored table: then Spark knows its size, and broadcasts
    it or splits the rows of frequent categories.
    """
    out = df
    for c in columns:
        table = codes.where(F.col("attribute") == c).select(
            F.col("value").alias("__value"), F.col("code").cast("double").alias("__code")
        )
        same = F.coalesce(F.col(c), F.lit(UNKNOWN)) == F.col("__value")
        code = F.coalesce(F.col("__code"), F.lit(float(UNSEEN_CODE)))
        out = out.join(table, same, "left").withColumn(c, code).drop("__value", "__code")
    return out


def numeric(c: str) -> Column:
    """A feature as a number; text that is no number, NaN and NULL become 0."""
    value = F.col(c).try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and scale per feature; a constant feature has scale 1."""
    stats = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    )
    rows = [_stat(c, F.col(f"mean_{c}"), F.col(f"std_{c}")) for c in columns]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def fit_sequence_scaler(df: DataFrame, steps: str, columns: Sequence[str]) -> DataFrame:
    """Mean and scale per sequence feature, over all steps of all rows."""
    each = df.select(F.explode(steps).alias("step"))
    values = each.select(*[F.col("step")[i].cast("double").alias(c) for i, c in enumerate(columns)])
    return fit_scaler(values, columns)


def _stat(name: str, mean: Column, std: Column) -> Column:
    scale = F.when(std > 0, std).otherwise(F.lit(1.0))
    return F.struct(F.lit(name).alias("feature"), mean.alias("mean"), scale.alias("scale"))


def read_scaler(stats: DataFrame) -> dict[str, tuple[float, float]]:
    """A fitted scaler as parameters: one short row per feature."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in stats.collect()}


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c) - F.lit(mean)) / F.lit(size) for c, (mean, size) in scaler.items()}
    )


def scale_sequence(
    df: DataFrame, steps: str, columns: Sequence[str], scaler: Mapping[str, tuple[float, float]]
) -> DataFrame:
    def one(step: Column) -> Column:
        parts = [
            ((step[i] - F.lit(scaler[c][0])) / F.lit(scaler[c][1])).cast("float")
            for i, c in enumerate(columns)
        ]
        return F.array(*parts)

    return df.withColumn(steps, F.transform(steps, one))


def latest_model(models: DataFrame, name: str) -> tuple[int, dict[str, float]]:
    """Version and weights of the newest version of a model.

    ``models`` holds ``model, version, feature, weight``, one short row per
    feature.
    """
    mine = models.where(F.col("model") == name)
    version = mine.agg(F.max(F.col("version").cast("int"))).first()[0]
    if version is None:
        raise LookupError(f"model {name!r} has no version; fit and store it first")
    rows = mine.where(F.col("version").cast("int") == version).select("feature", "weight").collect()
    return version, {r["feature"]: r["weight"] for r in rows}


def logistic(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Probability of a logistic model as a column expression."""
    terms = [F.col(c).cast("double") * F.lit(float(w)) for c, w in weights.items()]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))))


Predict = Callable[[np.ndarray, np.ndarray | None], np.ndarray]


def score_batches(
    df: DataFrame,
    predict: Predict,
    static: Sequence[str],
    sequence: str | None = None,
    out: str = "churn_probability",
) -> DataFrame:
    """Score with any model, batch by batch on the executors.

    ``predict`` gets the static features as float32 ``(rows, features)`` and the
    sequences as ``(rows, steps, features)`` or None, and returns one value per
    row.
    """
    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flat = batch[list(static)].to_numpy(dtype=np.float32)
            steps = None
            if sequence is not None and len(batch):
                steps = np.stack([np.vstack(s) for s in batch[sequence]]).astype(np.float32)
            yield batch.assign(**{out: np.asarray(predict(flat, steps), dtype=float).ravel()})

    return df.mapInPandas(run, schema)


def band(probability: Column | str) -> Column:
    """Risk label of a probability. Zero belongs to the lowest band."""
    p = F.col(probability) if isinstance(probability, str) else probability
    label = F.when((p >= 0) & (p <= BANDS[0][0]), BANDS[0][1])
    for upper, name in BANDS[1:]:
        label = label.when((p >= 0) & (p <= upper), name)
    return label


def flags(rules=FLAG_RULES) -> dict[str, Column]:
    """Text of each rule that fires, NULL for the others."""
    compare = {
        "gt": lambda c, limit: c > limit,
        "lt": lambda c, limit: c < limit,
        "le": lambda c, limit: c <= limit,
    }
    out = {}
    for flag, indicator, how, levels in rules:
        (strong, strong_text), (weak, weak_text) = levels
        c, test = F.col(indicator), compare[how]
        out[flag] = F.when(test(c, strong), strong_text).when(test(c, weak), weak_text)
    return out


def explain(df: DataFrame, rules=FLAG_RULES) -> DataFrame:
    """Add the rule flags, the reason text and the number of signals."""
    names = [r[0] for r in rules]
    fired = F.array_compact(F.array(*[F.col(n) for n in names]))
    reasons = F.concat_ws(REASON_SEPARATOR, *[F.col(n) for n in names])
    return df.withColumns(flags(rules)).withColumns(
        {
            "churn_reasons": F.when(reasons == "", F.lit(NO_FLAG)).otherwise(reasons),
            "risk_signal_count": F.size(fired),
        }
    )


def recent_cap(key: str) -> Column:
    """A cap for recently active customers that is stable per customer."""
    low, high = RECENT_CAP
    return F.lit(low) + F.pmod(F.xxhash64(key), F.lit(high - low + 1)).cast("int")


def hybrid_score(as_of: dt.date, cap: Column | int = RECENT_CAP[1]) -> Column:
    """Model score and rule signals in one number from 0 to 100."""
    quiet = F.datediff(F.lit(as_of), F.col("last_invoice_date"))
    model = F.round(F.col("churn_probability") * 100, 0).cast("int")
    signals = F.least(F.lit(SIGNAL_MAX), (F.col("risk_signal_count") * SIGNAL_POINTS).cast("int"))
    base = F.greatest(model, signals)
    limit = cap if isinstance(cap, Column) else F.lit(cap)
    lost = ((quiet > QUIET_DAYS) & (F.col("revenue_this_year_eur") < QUIET_REVENUE)) | (
        quiet > LOST_DAYS
    )
    return (
        F.when(quiet <= RECENT_DAYS, F.least(limit, base))
        .when(lost, F.lit(LOST_SCORE))
        .otherwise(F.least(F.lit(100), base))
        .cast("int")
    )
