import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.functions.dates import Periods
from martflow.operators import features as feat, scoring
from martflow.operators.observe import observed

from .conftest import rows

P = Periods(dt.date(2024, 6, 15))
D = dt.date


@pytest.fixture
def invoices(spark):
    data = [
        ("c1", 1, D(2024, 6, 1), "F", "A", 100.0, 60.0, 10, False, False),
        ("c1", 1, D(2024, 6, 2), "F", "A", 50.0, 60.0, 20, False, True),
        ("c1", 2, D(2023, 6, 10), "G", "A", 10.0, 5.0, None, True, False),
        ("c1", 3, D(2023, 6, 20), "F", None, 40.0, 5.0, 5, False, False),
        ("c1", None, D(2024, 5, 1), "F", "K", 1.0, 1.0, 5, False, False),
        ("c2", 4, D(2022, 1, 1), "F", "U", 7.0, 1.0, 5, False, True),
        (None, 5, D(2024, 6, 1), "F", "A", 9.0, 1.0, 5, False, True),
    ]
    names = """sk_customer_id string, nk_document_no int, invoice_date date, document_type_code string,
    document_category_code string, revenue double, cost_amount double, days_to_pay int, is_credit_note boolean,
    is_open boolean"""
    df = spark.createDataFrame(data, names)
    return df.withColumns({"header_net_total": F.col("revenue"), "amount_paid": F.col("revenue")})


def test_period_counts_are_distinct_and_skip_missing_items(invoices):
    wanted = {"all": F.lit(True), **P.conditions("invoice_date")}
    got = feat.period_counts(invoices, ["sk_customer_id"], "nk_document_no", wanted)
    assert rows(got) == sorted(
        [("c1", 3, 1, 1, 1, 2, 1), ("c2", 1, 0, 0, 0, 0, 0), (None, 1, 1, 1, 1, 0, 0)], key=str
    )


def test_period_counts_need_no_expand(invoices):
    got = feat.period_counts(invoices, ["sk_customer_id"], "nk_document_no", P.conditions("invoice_date"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_kpis_keep_the_customer_without_a_key(invoices):
    got = {r["sk_customer_id"]: r for r in feat.kpis(invoices, P).collect()}
    assert set(got) == {"c1", "c2", None}
    c1 = got["c1"]
    assert (c1["total_invoices"], c1["total_returns"], c1["return_rate_pct"]) == (3, 0, 0.0)
    assert (c1["revenue_this_year_eur"], c1["revenue_period_year_eur"]) == (151.0, 0.0)
    assert c1["revenue_yoy_change_pct"] is None
    assert c1["last_invoice_date"] == D(2024, 6, 2) and c1["goodwill_gestures"] == 1
    assert got["c2"]["last_invoice_date"] is None and got[None]["total_invoices"] == 1


def test_comparison_period_has_the_same_span(invoices):
    wide = {r["sk_customer_id"]: r for r in feat.kpis(invoices, Periods(P.as_of, same_span=False)).collect()}
    assert wide["c1"]["invoices_period_last_year"] == 2
    assert wide["c1"]["revenue_period_year_eur"] == 40.0


def test_rfm(invoices):
    base = feat.eligible(invoices, P)
    got = {r["sk_customer_id"]: r for r in feat.rfm(base, P).collect()}
    c1 = got["c1"]
    assert set(got) == {"c1", None}
    assert (c1["frequency"], c1["recency_days"], c1["num_doc_types"], c1["num_credit_notes"]) == (4, 13, 2, 1)
    assert c1["monetary_total"] == 161.0 and c1["total_profit"] == pytest.approx(35.0)
    assert got[None]["monetary_std"] == 0.0


def test_sequences_are_step_by_feature_and_padded(invoices):
    base = feat.eligible(invoices, P)
    wide = {r["sk_customer_id"]: r for r in feat.sequence_wide(base).collect()}
    array = {r["sk_customer_id"]: r["sequence"] for r in feat.sequence_array(base).collect()}
    c1 = array["c1"]
    assert np.array(c1).shape == (12, 6)
    assert c1[0] == [50.0, 60.0, 20.0, 50.0, 0.0, 1.0] and c1[1][0] == 100.0 and c1[4] == [0.0] * 6
    assert wide["c1"]["seq_revenue_1"] == 50.0 and wide["c1"]["seq_revenue_2"] == 100.0
    assert wide["c1"]["seq_days_to_pay_4"] == 0 and wide["c1"]["seq_is_open_1"] == 1


def test_life_cycle(spark):
    cycles = spark.createDataFrame([(1, 10.0), (1, 31.0), (2, 4.1)], "sk_customer_id int, cycle_day double")
    got = dict(rows(feat.life_cycle(cycles, P)))
    assert got["1"] == pytest.approx(1.0) and got["2"] == pytest.approx(0.1)


def test_codes_are_fitted_once(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("b", "x")], "c string, d string")
    codes = scoring.fit_categories(train, ["c", "d"])
    assert rows(codes) == [("c", "a", 0), ("c", "b", 1), ("d", "Unknown", 0), ("d", "x", 1)]
    later = spark.createDataFrame([("b", None), ("z", "x")], "c string, d string")
    assert [tuple(r) for r in scoring.encode(later, codes, ["c", "d"]).orderBy("c").collect()] == [
        (-1.0, 1.0),
        (1.0, 0.0),
    ]


def test_codes_follow_the_order_across_ranges(spark):
    words = F.format_string("%05d", F.col("id"))
    df = spark.range(0, 20000, 1, 8).select(words.alias("c"), (F.col("id") % 3).cast("string").alias("d"))
    codes = scoring.fit_categories(df, ["c", "d"])
    got = {(a, v): code for a, v, code in (tuple(r) for r in codes.collect())}
    assert got == {("c", f"{i:05d}"): i for i in range(20000)} | {("d", str(i)): i for i in range(3)}


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = scoring.read_scaler(scoring.fit_scaler(df, ["a", "b"]))
    assert scaler == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert rows(scoring.scale(df, scaler)) == [(-1.0, 0.0), (1.0, 0.0)]
    steps = spark.createDataFrame([([[1.0, 5.0], [3.0, 5.0]],)], "s array<array<float>>")
    fitted = scoring.read_scaler(scoring.fit_sequence_scaler(steps, "s", ["a", "b"]))
    assert fitted == scaler
    assert scoring.scale_sequence(steps, "s", ["a", "b"], fitted).first()[0] == [[-1.0, 0.0], [1.0, 0.0]]


def test_numbers_from_anything(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",)], "a string")
    assert [r[0] for r in df.select(scoring.numeric("a")).collect()] == [1.5, 0.0, 0.0, 0.0]


def test_bands_are_closed_below(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.31,), (0.6,), (1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(scoring.band("p")).collect()] == ["Low", "Low", "Medium", "Medium", "High", None]


def test_latest_model(spark):
    models = spark.createDataFrame(
        [("m", "9", "f", 1.0), ("m", "10", "f", 2.0)], "model string, version string, feature string, weight double"
    )
    assert scoring.latest_model(models, "m") == (10, {"f": 2.0})
    with pytest.raises(LookupError, match="no version"):
        scoring.latest_model(models, "other")


def test_batch_scoring_gets_both_inputs(spark):
    df = spark.createDataFrame([(i, float(i), [[1.0, 2.0], [3.0, float(i)]]) for i in range(50)], "k int, a double, s array<array<float>>")

    def predict(flat, steps):
        assert flat.dtype == np.float32 and steps.shape[1:] == (2, 2)
        return flat[:, 0] + steps[:, 1, 1]

    got = scoring.score_batches(df, predict, ["a"], "s", out="p")
    assert rows(got.select("k", "p")) == sorted(((i, 2.0 * i) for i in range(50)), key=str)


def test_flags_reasons_and_signals(spark):
    names = [r[1] for r in scoring.FLAG_RULES]
    df = spark.createDataFrame(
        [(1, 95.0, -40.0, None, 15.0, 10.0, 3.0, 2.0), (2, 10.0, 0.0, 0.0, 0.0, 0.0, 0.0, 9.0)],
        "k int, " + ", ".join(f"{n} double" for n in names),
    )
    got = {r["k"]: r for r in scoring.explain(df).collect()}
    assert got[1]["churn_reasons"] == (
        "No order in 90+ days | Revenue dropped >30% YoY | Return rate >10% | 2+ unpaid invoices"
    )
    assert got[1]["risk_signal_count"] == 4
    assert got[2]["churn_reasons"] == scoring.NO_FLAG and got[2]["risk_signal_count"] == 0


@pytest.mark.parametrize(
    "last, revenue, p, signals, score",
    [
        (D(2024, 6, 10), 0.0, 0.9, 5, 25),
        (D(2024, 6, 10), 0.0, 0.05, 0, 5),
        (D(2024, 4, 1), 100.0, 0.1, 0, 95),
        (D(2024, 4, 1), 9000.0, 0.1, 2, 40),
        (D(2024, 1, 1), 9000.0, 0.1, 0, 95),
        (D(2024, 5, 1), 9000.0, 0.1, 7, 90),
        (D(2024, 5, 1), 9000.0, 0.99, 1, 99),
        (None, 9000.0, 0.5, 0, 50),
    ],
)
def test_hybrid_score(spark, last, revenue, p, signals, score):
    df = spark.createDataFrame(
        [(last, revenue, p, signals)],
        "last_invoice_date date, revenue_this_year_eur double, churn_probability double, risk_signal_count int",
    )
    assert df.select(scoring.hybrid_score(P.as_of)).first()[0] == score


def test_recent_cap_is_stable_and_in_range(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    caps = [r[0] for r in df.select(scoring.recent_cap("k")).collect()]
    assert min(caps) >= 10 and max(caps) <= 25 and len(set(caps)) > 5
    assert caps == [r[0] for r in df.select(scoring.recent_cap("k")).collect()]


def test_counters_ride_along(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    seen, watch = observed(df, ["a"])
    seen.collect()
    assert watch.get == {"rows": 2, "nulls_a": 1}
