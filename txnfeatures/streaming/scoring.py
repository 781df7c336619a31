"""Scoring a stream of transactions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from txnfeatures.operators.stats import AmountStats
from txnfeatures.plans.scoring import score_source


def stream_score(
    model: PipelineModel,
    stream: DataFrame,
    amount: str,
    amount_stats: AmountStats,
    time: str | None = None,
    time_is_numeric: bool = False,
    user: str | None = None,
    user_table: DataFrame | None = None,
    threshold: float = 0.5,
    salts: int = 8,
) -> DataFrame:
    """Stateless scoring against statistics frozen from a batch.

    Dataset-wide and per-user statistics cannot be computed over an unbounded
    stream, so both come from the training side; the per-user table is joined
    as the static side.  A user who is frequent in the table is served by
    broadcast; one who is frequent only in the stream is spread over ``salts``
    partitions, as adaptive execution does not split the joins of a stream.
    """
    if user is not None and user_table is None:
        raise ValueError("a stream with a user column needs a frozen user table")
    return score_source(
        model, stream, amount, time, time_is_numeric, user, threshold, amount_stats=amount_stats, user_table=user_table, salts=salts
    )
