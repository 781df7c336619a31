"""Projections, label handling and repair of raw values."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnfeatures.functions.scalar import _c
from txnfeatures.schema import FEATURE_COLS, UNIVERSAL_TYPES

# Names under which a label is looked for, in this order.
TARGET_CANDIDATES = ["is_fraud", "fraud", "Class", "fraud_label", "isFraud", "label", "target", "Fraud"]

# Identifier and bookkeeping columns a trainer leaves out.
NON_FEATURE_COLS = [
    "weight", "transaction_id", "timestamp", "sender_account", "receiver_account",
    "ip_address", "device_hash", "ts", "bucket_5m",
]


def rename_ci(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename columns, matching the old names without regard to case."""
    wanted = {old.lower(): new for old, new in renames.items()}
    return df.withColumnsRenamed({c: wanted[c.lower()] for c in df.columns if c.lower() in wanted})


def select_universal(df: DataFrame, types: dict[str, str] = UNIVERSAL_TYPES) -> DataFrame:
    """The output contract: its columns, in order, in their types."""
    return df.selectExpr(*[f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in types.items()])


def label(c, kind: str = "int") -> Column:
    """``bool``: true is 1, everything else (null too) 0.  ``int``: plain cast."""
    if kind == "bool":
        return F.when(_c(c).try_cast("boolean"), 1).otherwise(0)
    return _c(c).try_cast("int")


CONSTANT_GROUPS = {
    "calendar": {"day_of_week": 0, "is_weekend": 0, "txn_month": 0},
    "user": {"user_mean_amount": 0.0, "user_std_amount": 0.0, "user_txn_count": 0, "user_amount_z": 0.0},
    "pca": {"pca_l2": 0.0, "pca_max_abs": 0.0, "pca_mean": 0.0},
}


def constants(*groups: str) -> dict[str, Column]:
    """Typed constants for feature groups a source cannot supply."""
    types = UNIVERSAL_TYPES
    return {c: F.expr(f"CAST({v} AS {types[c]})") for g in groups for c, v in CONSTANT_GROUPS[g].items()}


def fill_missing_groups(df: DataFrame, *groups: str, source: str | None = None) -> DataFrame:
    cols = constants(*groups)
    if source is not None:
        cols["source"] = F.lit(source)
    return df.withColumns(cols)


def filter_fraud(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.where(F.col(label_col) == 1)


def drop_columns(df: DataFrame, cols: list[str] = NON_FEATURE_COLS) -> DataFrame:
    return df.drop(*cols)


def align(df: DataFrame, cols: list[str] = FEATURE_COLS, fill: float = 0.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly ``cols`` in order; absent ones become ``fill``, others go."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else F.lit(fill).alias(c) for c in cols])


def inf_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Infinities and NaN become null in the floating-point columns."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = floating if cols is None else [c for c in cols if c in floating]
    return df.withColumns({c: finite_or_null(c) for c in cols})


def finite_or_null(c) -> Column:
    x = _c(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns in new types; what cannot be read in its type becomes null."""
    return df.withColumns({c: _c(c).try_cast(kind) for c, kind in types.items()})


def fill_missing(df: DataFrame, cols: list[str] | None = None, value: float = 0) -> DataFrame:
    return df.fillna(value, subset=cols)


def coerce_double(c, fill: float | None = 0.0) -> Column:
    """Number text to double; what cannot be read (or is NaN) becomes ``fill``."""
    x = _c(c).try_cast("double")
    x = F.when(~F.isnan(x), x)
    return x if fill is None else F.coalesce(x, F.lit(fill))


def coerce_ts(c) -> Column:
    return _c(c).try_cast("timestamp_ntz")


def detect_target(columns: list[str]) -> str:
    """The first candidate name present; says which were tried otherwise."""
    for name in TARGET_CANDIDATES:
        if name in columns:
            return name
    raise ValueError(f"no label column: looked for {TARGET_CANDIDATES} among {list(columns)}")


def pca_columns(columns: list[str]) -> list[str]:
    """Names made of a capital V and digits only."""
    return [c for c in columns if re.fullmatch(r"V\d+", c)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
