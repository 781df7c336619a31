"""The two training jobs as one call each: prepare, split, fit, measure, store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.functions.cleaning import (
    NON_FEATURE_COLS,
    align,
    categorical_columns,
    detect_target,
    drop_columns,
    inf_to_null,
    numeric_columns,
)
from txnfeatures.operators import encoding, evaluation, learning
from txnfeatures.operators.boosting import Boosted, boost
from txnfeatures.operators.sampling import HASH_RANGE, row_hash, stratified_split
from txnfeatures.operators.smote import smote
from txnfeatures.schema import FEATURE_COLS
from txnfeatures.sources.writers import replicate, scratch, scratch_uri, write_metrics

ROW = "_row"
TEST = "_is_test"
WATCHED = "_watched"
INDICATORS = "indicators"


@dataclass
class Trained:
    """A fitted model, how it grew, its metrics on the test rows (one row), the scored test
    rows (stored in scratch space; the caller's to delete), the numbers of rows
    on each side, and how storing went."""

    model: PipelineModel
    boosted: Boosted
    metrics: DataFrame
    test: DataFrame
    n_train: int
    n_test: int
    stores: DataFrame | None


def _split(df: DataFrame, label: str, test_share: float, seed: int, uri: str) -> DataFrame:
    """Rows with their side: fit and test read the same stored rows, the side is told from the stored hash.

    The side follows a hash of the row, so equal rows never stand on both.
    """
    df.withColumn(ROW, row_hash(*df.columns, seed=seed)).write.parquet(uri)
    return stratified_split(df.sparkSession.read.parquet(uri), ROW, label, test_share, seed, TEST)


def _watched(share: float, seed: int):
    return row_hash(ROW, seed=seed + 1) < F.lit(int(share * HASH_RANGE))


def _stored(trained: Trained, uris: list[str]) -> Trained:
    """Model and metrics to every store, the first one being the primary."""
    if uris:

        def write(uri: str) -> None:
            learning.save_model(trained.model, f"{uri.rstrip('/')}/model")
            write_metrics(trained.metrics, f"{uri.rstrip('/')}/metrics")

        trained.stores = replicate(trained.test.sparkSession, uris, write)
    return trained


def _measured(model: PipelineModel, boosted: Boosted, split: DataFrame, test: DataFrame, label: str, n_features: int, threshold: float) -> Trained:
    spark = split.sparkSession
    uri = scratch_uri(spark, "test-scores")
    learning.predict(model, test, threshold).write.parquet(uri)
    scored = spark.read.parquet(uri)
    metrics = evaluation.evaluate(scored, n_features, label, "fraud_probability")
    sides = split.agg(F.count_if(F.col(TEST) == 0), F.count_if(F.col(TEST) == 1)).first()
    return Trained(model, boosted, metrics, scored, sides[0], sides[1], None)


def train_universal(
    features: DataFrame,
    label: str = "label",
    test_share: float = 0.2,
    seed: int = 42,
    uris: list[str] = (),
    threshold: float = 0.5,
    watch_share: float = 0.1,
    **settings,
) -> Trained:
    """Stored universal features to a stored model with its metrics.

    Columns are aligned to the contract, infinities are missing, statistics are
    fitted on training rows only, and metrics come from the test rows.
    ``watch_share`` of the training rows are not fitted but watched: trees grow
    until their average precision has not risen for 30 rounds (the test rows
    have no say in that), up to 300 of depth 6.  ``settings`` go to the trainer.
    """
    rows = inf_to_null(align(features.where(F.col(label).isin(0, 1)), FEATURE_COLS, keep=(label,)))
    with scratch(features.sparkSession, "split") as uri:
        split = _split(rows, label, test_share, seed, uri)
        train = split.where(F.col(TEST) == 0).withColumn(WATCHED, _watched(watch_share, seed))
        model, boosted = learning.train_boosted(train, FEATURE_COLS, label, WATCHED, **settings)
        test = split.where(F.col(TEST) == 1).drop(TEST, ROW)
        trained = _measured(model, boosted, split, test, label, len(FEATURE_COLS), threshold)
    return _stored(trained, list(uris))


def train_baseline(
    df: DataFrame,
    label: str | None = None,
    drop: list[str] = NON_FEATURE_COLS,
    test_share: float = 0.2,
    seed: int = 42,
    k: int = 5,
    uris: list[str] = (),
    threshold: float = 0.5,
    watch_share: float = 0.1,
    method: str = "graph",
    **settings,
) -> Trained:
    """The older trainer on one table whose columns are not known beforehand.

    Finds the label, drops listed columns, turns text columns into indicators
    and keeps numeric ones, splits, imputes and scales by training statistics,
    adds synthetic minority rows (``method``: how neighbours are found) to the
    training side, fits and measures.  Growth stops as in
    :func:`train_universal`.  Levels of text columns come from all rows.  Trees
    and synthetic rows hold indicators densely: memory grows with their number.
    """
    label = label or detect_target(df.columns)
    rows = drop_columns(df, [c for c in drop if c != label])
    text = [c for c in categorical_columns(rows) if c != label]
    numeric = [c for c in numeric_columns(rows) if c != label]
    rows = inf_to_null(rows.select(*numeric, *text, F.col(label).cast("int").alias(label)).where(F.col(label).isin(0, 1)))
    spark = df.sparkSession
    rows, _ = encoding.sparse_indicators(rows, text, INDICATORS)
    wide = rows.select(INDICATORS).first()
    names = [*numeric, *([INDICATORS] if wide and wide[0].size else [])]
    with scratch(spark, "split") as split_uri, scratch(spark, "ready") as ready_uri:
        split = _split(rows, label, test_share, seed, split_uri)
        train = split.where(F.col(TEST) == 0)
        medians = encoding.fit_medians(train, numeric)
        scales = encoding.fit_scales(encoding.impute_median(train, numeric, medians), numeric)
        ready = encoding.scale_std(encoding.impute_median(split, numeric, medians), numeric, scales)
        ready.withColumn("_id", F.monotonically_increasing_id()).write.parquet(ready_uri)
        ready = spark.read.parquet(ready_uri)
        assemble = VectorAssembler(inputCols=names, outputCol=learning.VECTOR)
        sides = assemble.transform(ready.where(F.col(TEST) == 0)).withColumn(WATCHED, _watched(watch_share, seed))
        fit = sides.where(~F.col(WATCHED)).select("_id", label, vector_to_array(learning.VECTOR).alias("x"))
        balanced = smote(fit, "x", "_id", label, k, seed, method=method)
        weighted = learning.with_training_weight(balanced.select(array_to_vector("x").alias(learning.VECTOR), label), label)
        watched = sides.where(WATCHED).select(learning.VECTOR, label, F.lit(1.0).alias(learning.WEIGHT), F.lit(True).alias(WATCHED))
        both = weighted.withColumn(WATCHED, F.lit(False)).unionByName(watched)
        boosted = boost(both, learning.VECTOR, label, learning.WEIGHT, WATCHED, **learning.boost_settings(settings))
        model = PipelineModel([assemble, boosted.model])
        test = ready.where(F.col(TEST) == 1).drop(TEST, ROW, "_id")
        trained = _measured(model, boosted, split, test, label, boosted.model.numFeatures, threshold)
    return _stored(trained, list(uris))
