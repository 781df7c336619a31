"""Counts and checks that describe a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnfeatures.functions.cleaning import detect_target
from txnfeatures.schema import FEATURE_COLS


def row_count(df: DataFrame) -> DataFrame:
    """Rows and columns as one row."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def label_summary(df: DataFrame, by: str | None = None, label: str = "label") -> DataFrame:
    """Rows, fraud rows and fraud rate, overall or per ``by``; the rate of no
    rows is null."""
    fraud = F.count_if(F.col(label) == 1)
    groups = df.groupBy(by) if by else df.groupBy()
    return groups.agg(F.count("*").alias("n_rows"), fraud.alias("n_fraud")).withColumn(
        "fraud_rate", F.try_divide(F.col("n_fraud").cast("double"), F.col("n_rows"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))


def target_counts(df: DataFrame) -> DataFrame:
    """Value counts of whichever label column is present."""
    target = detect_target(df.columns)
    return value_counts(df, target).withColumnRenamed(target, "target_value").withColumn("target", F.lit(target))


def _long(row: DataFrame, name: str, columns: list[str], fields: dict[str, str]) -> DataFrame:
    """Turn one row of ``<field><i>`` columns into a row per column name."""
    structs = ", ".join(
        "named_struct('{n}', '{c}', {f})".format(
            n=name, c=c.replace("'", "\\'"), f=", ".join(f"'{f}', `{p}{i}`" for f, p in fields.items())
        )
        for i, c in enumerate(columns)
    )
    return row.selectExpr(f"inline(array({structs}))")


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null (or NaN) rows per column, only for columns that have any."""
    columns = columns or df.columns
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    tests = [F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull() for c in columns]
    row = df.agg(*[F.count_if(t).alias(f"m{i}") for i, t in enumerate(tests)])
    return _long(row, "column_name", columns, {"n_missing": "m"}).where("n_missing > 0")


# Inclusive ranges that follow from the feature definitions.
FEATURE_RANGES = {
    "is_high_amount": (0, 1),
    "hour": (0, 24),
    "hour_sin": (-1, 1),
    "hour_cos": (-1, 1),
    "is_night": (0, 1),
    "day_of_week": (0, 7),
    "is_weekend": (0, 1),
    "txn_month": (0, 12),
    "pca_l2": (0, float("inf")),
    "pca_max_abs": (0, float("inf")),
}


def contract_check(df: DataFrame, columns: list[str] = FEATURE_COLS) -> DataFrame:
    """Per required column: is it there, and how many of its rows are null, not
    finite, or outside the range its definition allows."""
    have = set(df.columns)
    counts: list[Column] = []
    for i, c in enumerate(columns):
        if c not in have:
            counts += [F.lit(None).cast("bigint").alias(f"{p}{i}") for p in "nfr"] + [F.lit(False).alias(f"p{i}")]
            continue
        x = F.col(c).cast("double")
        inf = F.isnan(x) | (F.abs(x) == float("inf"))
        low, high = FEATURE_RANGES.get(c, (float("-inf"), float("inf")))
        counts += [
            F.count_if(F.col(c).isNull()).alias(f"n{i}"),
            F.count_if(inf).alias(f"f{i}"),
            F.count_if((x < float(low)) | (x > float(high))).alias(f"r{i}"),
            F.lit(True).alias(f"p{i}"),
        ]
    fields = {"present": "p", "n_null": "n", "n_not_finite": "f", "n_out_of_range": "r"}
    return _long(df.agg(*counts), "column_name", columns, fields)


def column_profile(df: DataFrame, key: str, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct count per column and the value in the row with the smallest ``key``.

    The exact form first groups by (column, value), so the distinct values are
    spread over all tasks and the second grouping only counts rows.
    """
    columns = columns or [c for c in df.columns if c != key]
    texts = df.select(key, *[F.col(c).cast("string").alias(c) for c in columns])
    example = _long(
        texts.agg(*[F.min_by(c, key).alias(f"e{i}") for i, c in enumerate(columns)]),
        "column_name",
        columns,
        {"example": "e"},
    )
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)])
        distinct = _long(row, "column_name", columns, {"n_distinct": "d"})
    else:
        pairs = texts.select(*columns).unpivot([], columns, "column_name", "value").where("value IS NOT NULL")
        distinct = (
            pairs.groupBy("column_name", "value")
            .agg(F.lit(1).alias("one"))
            .groupBy("column_name")
            .agg(F.count("*").alias("n_distinct"))
        )
    # Both sides have one row per profiled column.
    return example.join(distinct, "column_name", "left").select(
        "column_name", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct"), "example"
    )


def class_counts(df: DataFrame, label: str = "label", floor: int = 0) -> DataFrame:
    """Positives, negatives and ``int(negatives / max(positives, 1))``."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("n_positive"), F.count_if(F.col(label) == 0).alias("n_negative")
    ).withColumn(
        "scale_pos_weight",
        F.greatest(
            F.floor(F.col("n_negative") / F.greatest("n_positive", F.lit(1))).cast("bigint"), F.lit(floor).cast("bigint")
        ),
    )


def class_weights(df: DataFrame, label: str = "label") -> dict[int, float]:
    """``n / (classes * n_class)`` per class present."""
    row = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    ).first()
    counts = {k: n for k, n in ((1, row["pos"]), (0, row["neg"])) if n}
    total = sum(counts.values())
    return {k: total / (len(counts) * n) for k, n in counts.items()}


def with_balanced_weight(df: DataFrame, label: str = "label", name: str = "weight", positive_factor: float = 1.0) -> DataFrame:
    """Row weights that give both classes the same total.  ``positive_factor``
    multiplies those of class 1, for parity with trainers that weight it twice."""
    expr = None
    for value, weight in class_weights(df, label).items():
        hit = F.lit(weight * (positive_factor if value == 1 else 1.0))
        expr = F.when(F.col(label) == value, hit) if expr is None else expr.when(F.col(label) == value, hit)
    return df.withColumn(name, F.lit(None).cast("double") if expr is None else expr)
