"""Imputing, scaling and encoding, fitted on training rows."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from txnfeatures.functions.cleaning import finite_or_null
from txnfeatures.operators.joins import attach_by_key
from txnfeatures.operators.numbering import numbered
from txnfeatures.operators.quantiles import exact_quantiles
from txnfeatures.sources.writers import scratch_uri

SCALED = "_scaled"


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians of the present values; 0 for a column without any."""
    found = exact_quantiles(df, dict.fromkeys(columns, 0.5), method="linear")
    return {c: 0.0 if m is None else m for c, m in found.items()}


def _finite(c: str):
    return finite_or_null(F.col(f"`{c}`").cast("double"))


def impute_median(df: DataFrame, columns: list[str], medians: dict[str, float] | None = None) -> DataFrame:
    """Fill null, NaN and infinite values with the column's median."""
    if medians is None:
        medians = fit_medians(df.select(*[_finite(c).alias(c) for c in columns]), columns)
    return df.withColumns({c: F.coalesce(_finite(c), F.lit(medians[c])) for c in columns})


def fit_scales(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Population deviations of the finite values; 1 where there is none."""
    row = df.agg(*[F.stddev_pop(_finite(c)).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] or 1.0 for i, c in enumerate(columns)}


def scale_std(df: DataFrame, columns: list[str], scales: dict[str, float] | None = None) -> DataFrame:
    """Divide by the deviation, without centring."""
    if scales is None:
        scales = fit_scales(df, columns)
    return df.withColumns({c: F.col(c) / F.lit(scales[c]) for c in columns})


def fit_preprocess(df: DataFrame, columns: list[str]) -> SQLTransformer:
    """Median filling and scaling as a pipeline stage that can be stored.

    Adds ``<column>_scaled`` columns; infinities and NaN count as missing.
    """
    clean = df.select(*[finite_or_null(F.col(c).cast("double")).alias(c) for c in columns])
    medians = fit_medians(clean, columns)
    scales = fit_scales(impute_median(clean, columns, medians), columns)
    # x - x is 0 for finite numbers and NaN otherwise.
    value = "CAST(`{c}` AS DOUBLE)"
    exprs = [
        "coalesce(IF({v} - {v} = 0D, {v}, NULL), {m!r}D) / {s!r}D AS `{c}{suffix}`".format(
            v=value.format(c=c), m=medians[c], s=scales[c], c=c, suffix=SCALED
        )
        for c in columns
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def index_levels(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """Replace text columns by the rank of their value by frequency, then text (1 is the most frequent; null and new values 0).

    The levels are a table joined on, not literals of the plan, so their number
    has no limit; hot levels go by a bounded broadcast.  Returns the rows and the new columns' names.
    """
    names = []
    for c in columns:
        counts = _level_counts(df, c)
        ranked = numbered(counts, [F.col("_n").desc(), F.col(f"`{c}`")], "_at")
        rank = (F.col("_at") + 1).cast("double")
        name = f"{c}_level"
        df = attach_by_key(df, ranked.select(f"`{c}`", "_n", rank.alias(name)), c, "_n", [name]).drop(c)
        df = df.withColumn(name, F.coalesce(name, F.lit(0.0)))
        names.append(name)
    return df, names


def _level_counts(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").cast("string").alias(c)).agg(F.count("*").alias("_n"))


def sparse_indicators(df: DataFrame, columns: list[str], name: str = "indicators") -> tuple[DataFrame, DataFrame]:
    """Replace text columns by one sparse vector of 0/1 indicators, one for each level but the first of its column.

    Levels count in the order of their text.  They are a table that is numbered
    by ranges and joined on, so no task and no plan holds all of them.  Missing
    values, like the first level, have no indicator; a column without two
    levels has none at all.  Returns the rows, stored, and the levels (column,
    level, place in the vector; null for the first).
    """
    spark = df.sparkSession
    levels, places, size = None, [], 0
    for i, c in enumerate(columns):
        known = numbered(_level_counts(df, c), [f"`{c}`"], "_at")
        n = known.count()
        place, offset = f"_place{i}", size
        at = F.when(F.col("_at") > 0, F.col("_at") - 1 + offset).cast("int")
        df = attach_by_key(df, known.select(f"`{c}`", "_n", at.alias(place)), c, "_n", [place]).drop(c)
        mine = known.select(F.lit(c).alias("column"), F.col(f"`{c}`").alias("level"), at.alias("place"))
        levels = mine if levels is None else levels.unionByName(mine)
        places.append(place)
        size += max(0, n - 1)
    if levels is None:
        levels = spark.createDataFrame([], "column string, level string, place int")
    here = F.array_compact(F.array(*[F.col(p) for p in places])) if places else F.array().cast("array<int>")
    kept = [f for f in df.schema.fields if f.name not in places]
    # The layout of a sparse vector, read back as one.
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), here.alias("indices"),
        F.transform(here, lambda _: F.lit(1.0)).alias("values"),
    )
    uri = scratch_uri(spark, "indicators")
    df.select(*[F.col(f"`{f.name}`") for f in kept], vector.alias(name)).write.parquet(uri)
    schema = StructType([*kept, StructField(name, VectorUDT())])
    return spark.read.schema(schema).parquet(uri), levels


def category_levels(df: DataFrame, column: str, max_levels: int = 1000) -> list[str]:
    """Sorted distinct values; refuses a column with more than ``max_levels``."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_levels + 1).collect()
    if len(found) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels: too many to encode")
    return sorted(r[0] for r in found)


def one_hot_drop_first(
    df: DataFrame, columns: list[str], levels: dict[str, list[str]] | None = None, max_levels: int = 1000
) -> DataFrame:
    """Replace string columns by 0/1 indicators per level but the first, as columns of their own.

    :func:`sparse_indicators` has no limit on the number of levels.
    """
    levels = levels or {c: category_levels(df, c, max_levels) for c in columns}
    flags = [
        F.when(F.col(f"`{c}`") == level, 1).otherwise(0).alias(f"{c}_{level}") for c in columns for level in levels[c][1:]
    ]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *flags)
