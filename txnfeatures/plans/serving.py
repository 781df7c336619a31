"""Feature engineering with scoring semantics.

The scorer's definitions differ from the training ones on purpose: whole hours,
Monday-first days, an interpolated percentile, statistics of the scored file
itself, and 0 for whatever cannot be computed.  Passing frozen training
statistics replaces the last but one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnfeatures.functions import cleaning as C
from txnfeatures.functions import scalar as S
from txnfeatures.operators.stats import AmountStats, attach_user_stats, fit_amount_stats, user_stats_serving
from txnfeatures.schema import FEATURE_TYPES

RAW = "_raw"


def extract_features_serving(
    df: DataFrame,
    amount: str,
    time: str | None = None,
    time_is_numeric: bool = False,
    user: str | None = None,
    amount_stats: AmountStats | None = None,
    user_table: DataFrame | None = None,
    keep_raw: bool = False,
    salts: int = 1,
) -> DataFrame:
    """The 18 model features of any table with an amount column.

    ``keep_raw`` carries the input row along as the struct ``_raw``.  Frozen
    ``amount_stats`` and ``user_table`` score against the training data; they
    also make the plan free of actions, so that it works on a stream; ``salts``
    spreads the rows of every user there.
    """
    time = time if time in df.columns else None
    user = user if user in df.columns else None
    components = C.pca_columns(df.columns)

    base = {"amount": C.coerce_double(amount)}
    if keep_raw:
        base[RAW] = F.struct("*")
    if user:
        base |= {"user": F.col(user), "user_amount": C.coerce_double(amount, None)}
    if time:
        base["clock"] = C.coerce_double(time, None) if time_is_numeric else C.coerce_ts(time)
    if components:
        base |= {
            "pca_l2": S.pca_l2(components, missing_as_zero=True),
            "pca_max_abs": S.pca_max_abs(components, missing_as_zero=True),
            "pca_mean": S.pca_mean(components, missing_as_zero=True),
        }
    out = df.select(*[e.alias(c) for c, e in base.items()])

    rows = None
    if amount_stats is None:
        amount_stats = fit_amount_stats(df, amount, method="linear", fill=0.0)
        rows = amount_stats.rows
    if user:
        own = user_table is None
        table = user_stats_serving(out, "user", "user_amount") if own else user_table.withColumnRenamed(user, "user")
        out = attach_user_stats(out, "user", "user_amount", table, rows if own else None, salts)

    exprs = {
        "log_amount": S.log_amount("amount"),
        "amount_z": S.zscore("amount", F.lit(amount_stats.mean), F.lit(amount_stats.std)),
        "is_high_amount": S.high_flag("amount", F.lit(amount_stats.p95)),
        "txn_count_5m": F.lit(0),
    }
    if time:
        hour = S.hour_fraction_positive("clock") if time_is_numeric else S.hour_int("clock")
        exprs |= {"hour": hour, "hour_sin": S.hour_sin(hour), "hour_cos": S.hour_cos(hour), "is_night": S.night_flag(hour)}
        if time_is_numeric:
            exprs |= C.constants("calendar")
        else:
            day = S.day_of_week_serving("clock")
            exprs |= {"day_of_week": day, "is_weekend": S.weekend_flag_serving(day), "txn_month": S.month("clock")}
    if user:
        exprs |= {
            "user_std_amount": F.coalesce("user_std_amount", F.lit(1.0)),
            "user_amount_z": S.user_amount_z_serving("amount", "user_mean_amount", "user_std_amount"),
        }
    else:
        exprs |= C.constants("user")
    out = out.withColumns(exprs)

    have = set(out.columns)
    features = [
        f"CAST(coalesce(`{c}`, 0) AS {t}) AS `{c}`" if c in have else f"CAST(0 AS {t}) AS `{c}`"
        for c, t in FEATURE_TYPES.items()
    ]
    return out.selectExpr(*([RAW] if keep_raw else []), *features)
