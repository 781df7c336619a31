"""Small inputs with known answers, edge rows included."""

import pytest
from pyspark.sql import functions as F

from txnfeatures.functions import cleaning as C
from txnfeatures.functions import scalar as S
from txnfeatures.operators import evaluation as E
from txnfeatures.operators import quality as Q
from txnfeatures.plans import features as P
from txnfeatures.plans.serving import extract_features_serving
from txnfeatures.schema import FINANCIAL, PCA_COLS, UNIVERSAL_COLS, UNIVERSAL_TYPES

FINANCIAL_ROWS = [
    (1, "2024-01-06 00:00:10", 10.0, "A", False),
    (2, "2024-01-06 00:04:59", 30.0, "A", True),
    (3, "2024-01-06 00:05:00", 20.0, "A", None),
    (4, "2024-01-07 06:00:00", 50.0, "B", False),
    (5, "2024-01-07 06:00:01", 40.0, "C", False),
    (6, "2024-01-08 21:59:59", 40.0, "C", True),
    (7, "2024-01-08 22:00:00", None, "A", False),
    (8, "garbage", 1000.0, None, True),
]

# log_amount, amount_z, high, hour, night, dow, user_mean, user_std, user_n, user_z, 5m, label
EXPECTED = {
    1: (2.397895, -0.436869, 0, 0.002778, 1, 7, 20, 10, 4, -1, 2, 0),
    2: (3.433987, -0.382261, 0, 0.083056, 1, 7, 20, 10, 4, 1, 2, 1),
    3: (3.044522, -0.409565, 0, 0.083333, 1, 7, 20, 10, 4, 0, 1, 0),
    4: (3.931826, -0.327652, 0, 6.0, 1, 1, 50, None, 1, 0, 2, 0),
    5: (3.713572, -0.354956, 0, 6.000278, 0, 1, 40, 0, 2, 0, 2, 0),
    6: (3.713572, -0.354956, 0, 21.999722, 0, 2, 40, 0, 2, 0, 1, 1),
    7: (None, None, 0, 22.0, 1, 2, 20, 10, 4, None, 1, 0),
    8: (6.908755, 2.26626, 0, None, 0, None, None, None, None, None, None, 1),
}


def near(got, want):
    return got is None if want is None else got == pytest.approx(want, abs=1e-6)


@pytest.fixture
def financial(spark):
    return spark.createDataFrame(
        FINANCIAL_ROWS, "id bigint, timestamp string, amount double, sender_account string, is_fraud boolean"
    )


COLS = [
    "log_amount", "amount_z", "is_high_amount", "hour", "is_night", "day_of_week", "user_mean_amount",
    "user_std_amount", "user_txn_count", "user_amount_z", "txn_count_5m", "label",
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_financial_edges(financial, conf, zone, ansi):
    conf("spark.sql.session.timeZone", zone)
    conf("spark.sql.ansi.enabled", ansi)
    rows = [tuple(r) for r in P.features_financial(financial).select(*COLS).collect()]
    assert len(rows) == len(EXPECTED)
    left = list(rows)
    for want in EXPECTED.values():
        hit = next((r for r in left if all(near(a, b) for a, b in zip(r, want))), None)
        assert hit is not None, want
        left.remove(hit)


def test_linear_percentile_flags_the_outlier(financial):
    high = P.features_financial(financial, method="linear").where("is_high_amount = 1")
    assert [r["log_amount"] for r in high.collect()] == [pytest.approx(6.908755, abs=1e-6)]


def test_contract_types(financial):
    df = P.features_financial(financial)
    assert df.columns == UNIVERSAL_COLS
    assert dict(df.dtypes) == UNIVERSAL_TYPES


@pytest.mark.parametrize("name", ["AMOUNT", "amount", "Amount"])
def test_amount_names(financial, name):
    renamed = C.rename_ci(financial.withColumnRenamed("amount", name), FINANCIAL.renames)
    assert "Amount" in renamed.columns


def pca_input(spark, v1, v2, v3):
    row = [v1, v2, v3] + [0.0] * 25
    return spark.createDataFrame([tuple(row)], ", ".join(f"{c} double" for c in PCA_COLS))


def test_components(spark):
    full = P.add_pca_features(pca_input(spark, 3.0, -4.0, 0.0)).first()
    assert (full["pca_l2"], full["pca_max_abs"]) == (5.0, 4.0)
    assert full["pca_mean"] == pytest.approx(-0.035714, abs=1e-6)
    gap = P.add_pca_features(pca_input(spark, 3.0, -4.0, None)).first()
    assert (gap["pca_l2"], gap["pca_max_abs"], gap["pca_mean"]) == (None, 4.0, None)
    served = pca_input(spark, 3.0, -4.0, None).withColumn("Amount", F.lit(1.0))
    got = extract_features_serving(served, "Amount").first()
    assert (got["pca_l2"], got["pca_max_abs"]) == (5.0, 4.0)
    assert got["pca_mean"] == pytest.approx(-0.035714, abs=1e-6)


def test_component_names():
    assert C.pca_columns(["V1", "V28", "V", "Vx", "v1", "xV1"]) == ["V1", "V28"]


LABELS = [0, 0, 1, 1, 1, 0]
SCORES = [0.1, 0.4, 0.35, 0.8, 0.4, 0.4]


def test_scores(spark):
    df = spark.createDataFrame(list(zip(LABELS, SCORES)), "label int, probability double")
    for rows_per_range in (None, 1, 2):
        assert E.roc_auc(df, rows_per_range=rows_per_range).first()[0] == pytest.approx(0.666667, abs=1e-6)
        assert E.average_precision(df, rows_per_range=rows_per_range).first()[0] == pytest.approx(0.7)
    cut = E.apply_threshold(df, "probability", 0.4, "prediction")
    cells = {(r["label"], r["prediction"]): r["n_rows"] for r in E.confusion_matrix(cut).collect()}
    assert cells == {(1, 1): 2, (0, 1): 2, (1, 0): 1, (0, 0): 1}
    one = E.classification_report(cut).where("class = '1'").first()
    assert (one["precision"], one["support"]) == (0.5, 3)
    assert one["recall"] == pytest.approx(0.666667, abs=1e-6)
    assert one["f1"] == pytest.approx(0.571429, abs=1e-6)


def test_empty_tables(spark, financial):
    none = spark.createDataFrame([], "label int, probability double, prediction int")
    assert E.roc_auc(none).first()[0] is None
    assert E.average_precision(none).first()[0] is None
    assert E.score_summary(none, "prediction").first()[:] == (0, 0, None)
    assert Q.label_summary(none).first()[:] == (0, 0, None)
    assert all(r["n_rows"] == 0 for r in E.confusion_matrix(none).collect())
    assert all(r["precision"] is None and r["f1"] is None for r in E.classification_report(none).collect())
    assert P.features_financial(financial.limit(0)).count() == 0


def test_class_balance(financial):
    df = financial.select(C.label("is_fraud", "bool").alias("label"))
    assert Q.class_counts(df).first()[:] == (3, 5, 1)
    weights = {r["label"]: r["weight"] for r in Q.with_balanced_weight(df).collect()}
    assert weights[1] == pytest.approx(1.333333, abs=1e-6) and weights[0] == pytest.approx(0.8)


def test_numeric_text(spark):
    df = spark.createDataFrame([("12.5",), ("x",), ("",), (None,), ("NaN",)], "a string")
    assert [r[0] for r in df.select(C.coerce_double("a")).collect()] == [12.5, 0, 0, 0, 0]


def test_infinities(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,), (None,)], "a double")
    assert [r[0] for r in C.inf_to_null(df).collect()] == [None, None, None, 1.0, None]


def test_small_amounts_and_negative_time(spark):
    df = spark.createDataFrame([(-1.0, -3600.0), (-2.0, -3600.0)], "a double, t double")
    row = df.select(S.log_amount("a"), S.hour_fraction("t"), S.hour_fraction_positive("t"), S.time_bucket("t")).first()
    assert row[:] == (None, -1.0, 23.0, -12)


def test_night_differs_between_training_and_serving(spark):
    df = spark.createDataFrame([("2024-01-08 06:30:00", 1.0)], "t string, Amount double")
    assert P.add_time_features_datetime(df, "t").first()["is_night"] == 0
    assert extract_features_serving(df, "Amount", "t").first()["is_night"] == 1


def test_serving_fills(spark):
    df = spark.createDataFrame(
        [("2024-01-08 10:30:00", "5", "A"), ("bad", "x", None), ("2024-01-13 23:00:00", "7", "A"), (None, "9", "B")],
        "t string, Amount string, u string",
    )
    rows = extract_features_serving(df, "Amount", "t", user="u", keep_raw=True).collect()
    by_amount = {r["_raw"]["Amount"]: r for r in rows}
    bad = by_amount["x"]
    assert (bad["log_amount"], bad["hour"], bad["day_of_week"], bad["user_mean_amount"]) == (0, 0, 0, 0)
    assert (bad["user_std_amount"], bad["user_txn_count"], bad["user_amount_z"]) == (1, 0, 0)
    assert (by_amount["5"]["user_mean_amount"], by_amount["5"]["user_txn_count"]) == (6, 2)
    assert (by_amount["7"]["day_of_week"], by_amount["7"]["is_weekend"], by_amount["7"]["is_night"]) == (5, 1, 1)
    assert (by_amount["9"]["user_std_amount"], by_amount["9"]["user_amount_z"]) == (1, 0)


def test_serving_without_columns(spark):
    row = extract_features_serving(spark.createDataFrame([(3.0,), (3.0,)], "Amount double"), "Amount", "absent", user="no").first()
    assert (row["hour"], row["user_std_amount"], row["amount_z"], row["is_high_amount"]) == (0, 0, 0, 0)


def test_statistic_fallbacks(spark):
    from txnfeatures.operators.stats import fit_amount_stats

    same = spark.createDataFrame([(4.0,), (4.0,)], "Amount double")
    assert fit_amount_stats(same).std == 1.0
    zeros = spark.createDataFrame([(0.0,)] * 99 + [(10.0,)], "Amount double")
    assert fit_amount_stats(zeros).p95 == pytest.approx(0.2)
    assert fit_amount_stats(zeros, method="linear", fill=0.0).p95 == 0.0
    empty = fit_amount_stats(same.limit(0))
    assert (empty.mean, empty.std, empty.p95, empty.n) == (0.0, 1.0, 0.0, 0)


def test_label_search():
    assert C.detect_target(["a", "label", "Class"]) == "Class"
    with pytest.raises(ValueError, match="no label column"):
        C.detect_target(["a", "b"])
