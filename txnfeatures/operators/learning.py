"""Training, applying and storing the boosted-tree classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnfeatures.operators.boosting import Boosted, boost
from txnfeatures.operators.encoding import SCALED, fit_preprocess
from txnfeatures.operators.evaluation import apply_threshold
from txnfeatures.operators.quality import class_counts, with_balanced_weight
from txnfeatures.schema import FEATURE_COLS
from txnfeatures.sources.writers import replicate

VECTOR = "_features"
WEIGHT = "_weight"

# The trainer's settings.
GBT_SETTINGS = {
    "maxIter": 300,
    "maxDepth": 6,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}


def with_training_weight(df: DataFrame, label: str = "label", parity: bool = False) -> DataFrame:
    """Balanced class weights.  ``parity`` also multiplies class 1 by the
    negatives-to-positives ratio, which weights it twice."""
    factor = 1.0
    if parity:
        factor = float(class_counts(df, label, floor=1).first()["scale_pos_weight"])
    return with_balanced_weight(df, label, WEIGHT, factor)


def train_gbt(
    df: DataFrame,
    features: list[str] = FEATURE_COLS,
    label: str = "label",
    validation: str | None = None,
    validation_tol: float = 0.01,
    parity: bool = False,
    **settings,
) -> PipelineModel:
    """Preprocess and boosted trees, fitted on the rows with a label.

    ``validation`` names a boolean column: its true rows are left out of the
    fit and stop it once their loss no longer improves.  Statistics are fitted
    on training rows only.  With ``spark.checkpoint.dir`` set, the lineage of
    the rounds is cut every ten.
    """
    rows = df.where(F.col(label).isin(0, 1)).withColumn(label, F.col(label).cast("double"))
    train = rows.where(~F.col(validation)) if validation else rows
    prepare = fit_preprocess(train, features)
    assemble = VectorAssembler(inputCols=[f"{c}{SCALED}" for c in features], outputCol=VECTOR)
    params = {**GBT_SETTINGS, "checkpointInterval": 10, **settings}
    if validation:
        params |= {"validationIndicatorCol": validation, "validationTol": validation_tol}
    trees = GBTClassifier(featuresCol=VECTOR, labelCol=label, weightCol=WEIGHT, **params)
    if validation:
        weighted = with_training_weight(train, label, parity).unionByName(
            rows.where(F.col(validation)).withColumn(WEIGHT, F.lit(1.0))
        )
    else:
        weighted = with_training_weight(train, label, parity)
    return Pipeline(stages=[prepare, assemble, trees]).fit(weighted)


def train_boosted(
    df: DataFrame,
    features: list[str] = FEATURE_COLS,
    label: str = "label",
    validation: str | None = None,
    parity: bool = False,
    **settings,
) -> tuple[PipelineModel, Boosted]:
    """As :func:`train_gbt`, but each tree uses a sample of the columns, and with
    ``validation`` growth stops 30 rounds after the best average precision.

    ``settings`` go to :func:`~txnfeatures.operators.boosting.boost`; the
    trainer's names (``maxIter``, ``maxDepth``, ...) are understood too.
    """
    rows = df.where(F.col(label).isin(0, 1)).withColumn(label, F.col(label).cast("double"))
    held_out = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    train = rows.where(~held_out)
    prepare = fit_preprocess(train, features)
    assemble = VectorAssembler(inputCols=[f"{c}{SCALED}" for c in features], outputCol=VECTOR)
    weighted = with_training_weight(train, label, parity).unionByName(rows.where(held_out).withColumn(WEIGHT, F.lit(1.0)))
    ready = assemble.transform(prepare.transform(weighted))
    boosted = boost(ready, VECTOR, label, WEIGHT, validation, **boost_settings(settings))
    return PipelineModel([prepare, assemble, boosted.model]), boosted


def boost_settings(settings: dict) -> dict:
    names = {"maxIter": "rounds", "maxDepth": "depth", "stepSize": "rate", "subsamplingRate": "row_share"}
    return {names.get(k, k): v for k, v in settings.items()}


def n_trees(model: PipelineModel) -> int:
    return len(model.stages[-1].treeWeights)


def feature_names(model: PipelineModel) -> list[str]:
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return [c.removesuffix(SCALED) for c in inputs]


def predict(
    model: PipelineModel,
    df: DataFrame,
    threshold: float = 0.5,
    probability: str = "fraud_probability",
    prediction: str = "fraud_predicted",
) -> DataFrame:
    """Append the probability of class 1 and the class at ``threshold``."""
    scored = model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias(probability))
    return apply_threshold(scored, probability, threshold, prediction)


def save_model(model: PipelineModel, uri: str) -> None:
    """Preprocessing, feature names and trees in one place."""
    model.write().overwrite().save(uri)


def save_model_replicated(model: PipelineModel, uris: list[str]) -> DataFrame:
    """The model to a primary and further stores; see ``replicate``."""
    return replicate(SparkSession.active(), uris, lambda uri: save_model(model, uri))


def load_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)
