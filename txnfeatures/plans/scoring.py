"""Scoring tables with a fitted model."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from txnfeatures.operators.evaluation import classification_report
from txnfeatures.operators.learning import predict
from txnfeatures.plans.serving import RAW, extract_features_serving
from txnfeatures.schema import CARD_FRAUD, CREDITCARD, FINANCIAL, MIXED, SourceSpec
from txnfeatures.sources.writers import write_scores

SCORED_SPECS = [CREDITCARD, FINANCIAL, CARD_FRAUD, MIXED]


def score_table(model: PipelineModel, df: DataFrame, features: DataFrame, threshold: float = 0.5) -> DataFrame:
    """All columns of the input rows carried in ``features`` plus
    ``fraud_probability`` and ``fraud_predicted``; ``df`` gives the columns."""
    names = [c for c in df.columns if c not in ("fraud_probability", "fraud_predicted")]
    scored = predict(model, features, threshold)
    return scored.select(*[f"{RAW}.`{c}`" for c in names], "fraud_probability", "fraud_predicted")


def score_source(
    model: PipelineModel,
    df: DataFrame,
    amount: str,
    time: str | None = None,
    time_is_numeric: bool = False,
    user: str | None = None,
    threshold: float = 0.5,
    uri: str | None = None,
    **frozen,
) -> DataFrame:
    """Features with scoring semantics, model, and optionally the CSV output."""
    return score_and_summarise(model, df, amount, time, time_is_numeric, user, threshold, uri, **frozen).scores


@dataclass
class Scored:
    """``summary`` holds rows, predicted rows and their rate; None when nothing was written yet."""

    scores: DataFrame
    summary: dict | None


def score_and_summarise(
    model: PipelineModel,
    df: DataFrame,
    amount: str,
    time: str | None = None,
    time_is_numeric: bool = False,
    user: str | None = None,
    threshold: float = 0.5,
    uri: str | None = None,
    **frozen,
) -> Scored:
    """As ``score_source``; with ``uri`` the model runs once: counts are observed
    on the write, and the returned scores are what was written."""
    features = extract_features_serving(df, amount, time, time_is_numeric, user, keep_raw=True, **frozen)
    scored = score_table(model, df, features, threshold)
    if not uri:
        return Scored(scored, None)
    seen = Observation()
    hits = F.count_if(F.col("fraud_predicted") == 1)
    write_scores(scored.observe(seen, F.count("*").alias("n_rows"), hits.alias("n_predicted")), uri)
    n, hit = seen.get["n_rows"], seen.get["n_predicted"]
    back = df.sparkSession.read.schema(scored.schema).option("header", True).csv(uri)
    return Scored(back, {"n_rows": n, "n_predicted": hit, "predicted_rate": hit / n if n else None})


@dataclass
class ScoredSources:
    scores: dict[str, DataFrame]
    report: DataFrame | None
    summaries: dict[str, dict]


def score_all_sources(
    model: PipelineModel,
    frames: dict[str, DataFrame],
    specs: list[SourceSpec] = SCORED_SPECS,
    uri: str | None = None,
    threshold: float = 0.5,
) -> ScoredSources:
    """Score several sources side by side, each to its own directory, and report
    on the labelled mixed set if it is among them.  Without ``uri`` nothing is
    written, and each use of a result runs the model again."""
    mine = [spec for spec in specs if spec.name in frames]

    def score(spec: SourceSpec) -> Scored:
        df = frames[spec.name]
        amount = next(c for c in df.columns if c.lower() == spec.amount.lower())
        target = f"{uri.rstrip('/')}/{spec.name}_predictions" if uri else None
        return score_and_summarise(
            model, df, amount, spec.time, spec.time_kind == "numeric", spec.user, threshold, target
        )

    found = {}
    if mine:
        session = frames[mine[0].name].sparkSession
        with ThreadPoolExecutor(len(mine)) as pool:
            found = dict(zip([s.name for s in mine], pool.map(inheritable_thread_target(session)(score), mine)))
    label = next((s.label for s in mine if s.name == MIXED.name), None)
    report = classification_report(found[MIXED.name].scores, label, "fraud_predicted") if label else None
    summaries = {name: r.summary for name, r in found.items() if r.summary}
    return ScoredSources({name: r.scores for name, r in found.items()}, report, summaries)
