"""Evaluation of a labelled score table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.operators.ranks import running_totals


def apply_threshold(df: DataFrame, probability: str, threshold: float = 0.5, name: str = "fraud_predicted") -> DataFrame:
    return df.withColumn(name, (F.col(probability) >= F.lit(float(threshold))).cast("int"))


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"n{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction), cells without rows included."""
    return _cells(df, label, prediction).selectExpr(
        "stack(4, 0, 0, n00, 0, 1, n01, 1, 0, n10, 1, 1, n11) AS (label, prediction, n_rows)"
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, plain and
    support-weighted averages.  An undefined ratio counts as 0; of an empty
    table all rates are null."""

    def ratio(a: str, b: str) -> str:
        return f"IF(n = 0, NULL, coalesce(try_divide(CAST({a} AS DOUBLE), {b}), 0D))"

    rates = _cells(df, label, prediction).selectExpr("*", "n00 + n01 + n10 + n11 AS n").selectExpr(
        "n",
        "n00 + n01 AS s0",
        "n10 + n11 AS s1",
        f"{ratio('n00', 'n00 + n10')} AS p0",
        f"{ratio('n11', 'n11 + n01')} AS p1",
        f"{ratio('n00', 'n00 + n01')} AS r0",
        f"{ratio('n11', 'n11 + n10')} AS r1",
        f"{ratio('2 * n00', '2 * n00 + n01 + n10')} AS f0",
        f"{ratio('2 * n11', '2 * n11 + n01 + n10')} AS f1",
        f"{ratio('n00 + n11', 'n')} AS acc",
    )

    def macro(x: str) -> str:
        return f"({x}0 + {x}1) / 2"

    def weighted(x: str) -> str:
        return f"try_divide({x}0 * s0 + {x}1 * s1, n)"

    none = "CAST(NULL AS DOUBLE)"
    rows = [
        ("0", "p0", "r0", "f0", "s0"),
        ("1", "p1", "r1", "f1", "s1"),
        ("accuracy", none, none, "acc", "n"),
        ("macro avg", macro("p"), macro("r"), macro("f"), "n"),
        ("weighted avg", weighted("p"), weighted("r"), weighted("f"), "n"),
    ]
    cells = ", ".join(f"'{name}', {', '.join(rest)}" for name, *rest in rows)
    return rates.selectExpr(f"stack({len(rows)}, {cells}) AS (class, precision, recall, f1, support)")


def _per_score(df: DataFrame, label: str, probability: str, rows_per_range: int | None):
    """Positives and negatives per distinct score, and below it."""
    scored = df.where(F.col(label).isin(0, 1)).select(F.col(probability).alias("score"), F.col(label).alias("y"))
    return running_totals(
        scored, "score", {"pos": F.count_if(F.col("y") == 1), "neg": F.count_if(F.col("y") == 0)}, rows_per_range
    )


def _auc(p: float, n: float):
    """A positive beats the negatives below it and half of those it ties with."""
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    return F.try_divide(wins, F.lit(p * n))


def _average_precision(p: float, n: float):
    """Precision at each score that has positives, weighted by their share."""
    hits = F.lit(p) - F.col("pos_before")
    flagged = hits + F.lit(n) - F.col("neg_before")
    return F.try_divide(F.sum(F.try_divide(F.col("pos") * hits, flagged)), F.lit(p))


def roc_auc(df: DataFrame, label: str = "label", probability: str = "probability", rows_per_range: int | None = None) -> DataFrame:
    per, n = _per_score(df, label, probability, rows_per_range)
    return per.agg(_auc(float(n["pos"]), float(n["neg"])).alias("roc_auc"))


def average_precision(
    df: DataFrame, label: str = "label", probability: str = "probability", rows_per_range: int | None = None
) -> DataFrame:
    """Step-wise area: the sum of recall gains times precision."""
    per, n = _per_score(df, label, probability, rows_per_range)
    return per.agg(_average_precision(float(n["pos"]), float(n["neg"])).alias("average_precision"))


def evaluate(
    df: DataFrame, n_features: int, label: str = "label", probability: str = "probability", rows_per_range: int | None = None
) -> DataFrame:
    """One metrics row; the areas are rounded to four places."""
    per, n = _per_score(df, label, probability, rows_per_range)
    p, q = float(n["pos"]), float(n["neg"])
    return per.agg(
        F.round(_auc(p, q), 4).alias("roc_auc"),
        F.round(_average_precision(p, q), 4).alias("pr_auc"),
        F.lit(n["pos"] + n["neg"]).cast("bigint").alias("n_test"),
        F.lit(n["pos"]).cast("bigint").alias("n_fraud"),
        F.lit(n_features).alias("features"),
    )


def score_summary(df: DataFrame, prediction: str = "fraud_predicted") -> DataFrame:
    """Rows scored, predicted fraud and its rate (null without rows)."""
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(prediction) == 1).alias("n_predicted")
    ).withColumn("predicted_rate", F.try_divide(F.col("n_predicted").cast("double"), F.col("n_rows")))
