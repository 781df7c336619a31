"""Attaching one-row-per-key tables to facts whose keys may be very uneven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least 1/HOT_KEYS of the counted rows, so there
# are never more than HOT_KEYS of them: that bound is what allows broadcasting.
HOT_KEYS = 1000
# Places over which rows without an open key are spread.
SPREAD = 16384


def attach_by_key(
    df: DataFrame, stats: DataFrame, key: str, weight: str, values: list[str], total: int | None = None, salts: int = 1
) -> DataFrame:
    """Left join ``values`` of ``stats`` (unique ``key``; ``weight`` is its row
    count, at least 1; ``total`` is the sum of weights or more, if known).

    Rows of hot keys get their values from a broadcast of the hot keys.  For the
    shuffle that serves the others, the key of hot and null-key rows is hidden
    and a salt made of the row and its input partition takes its place, so they
    spread over all partitions even if they are copies of each other.  (The
    input partition of a row is the same when a task is repeated, so a retry
    sends every row where it went before.)  The salt is part of the join key on
    both sides, which also gives both sides an exchange of their own and lets
    adaptive execution split what is still uneven.

    ``salts`` over 1 repeats each row of ``stats`` that often and spreads the
    rows of every key over as many partitions: for plans that adaptive execution
    does not reach, and rows whose keys weigh otherwise than ``stats`` says.
    """
    df = df.drop(*values)
    rows = ", ".join(f"`{c}`" for c in df.columns)
    keyed = stats.where(f"`{key}` IS NOT NULL")
    if total is None:
        is_hot = F.col(weight) * HOT_KEYS >= keyed.agg(F.sum(weight)).scalar()
    else:
        is_hot = F.expr(f"`{weight}` * {HOT_KEYS} >= {total}")
    hot = keyed.where(is_hot).selectExpr(f"`{key}` AS _hot_key", *[f"`{v}` AS `_hot_{v}`" for v in values])
    cold = keyed.where(~is_hot).selectExpr(
        # Always 0, but not a literal: it has to stay part of the join key.
        f"`{key}` AS _cold_key",
        f"IF(`{key}` IS NULL, 1, 0) AS _cold_spread" if salts == 1 else f"explode(sequence(0, {salts - 1})) AS _cold_spread",
        *[f"`{v}` AS `_cold_{v}`" for v in values],
    )
    salt = lambda n: f"CAST(pmod(xxhash64({rows}, spark_partition_id()), {n}) AS INT)"
    return (
        df.join(F.broadcast(hot), F.expr(f"`{key}` = _hot_key"), "left")
        .selectExpr(
            "*",
            f"IF(_hot_key IS NULL, `{key}`, NULL) AS _open_key",
            f"IF(_hot_key IS NULL AND `{key}` IS NOT NULL, {0 if salts == 1 else salt(salts)}, {salt(SPREAD)}) AS _spread",
        )
        .join(cold, F.expr("_open_key = _cold_key AND _spread = _cold_spread"), "left")
        .selectExpr(*[f"`{c}`" for c in df.columns], *[f"coalesce(`_hot_{v}`, `_cold_{v}`) AS `{v}`" for v in values])
    )
