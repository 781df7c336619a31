"""Feature groups and whole feature plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnfeatures.checks import tables as t
from txnfeatures.functions import cleaning as C
from txnfeatures.plans import features as plans
from txnfeatures.schema import UNIVERSAL_COLS, UNIVERSAL_COLS_V1, UNIVERSAL_TYPES_V1

# -- SQL building blocks ------------------------------------------------------


def amount_stats_sql(rel: str, amount: str) -> str:
    return f"""(SELECT coalesce(avg({amount}), 0) AS m, coalesce(nullif(stddev_samp({amount}), 0), 1) AS s,
       coalesce(nullif(quantile_disc({amount}, 0.95), 0), 2 * coalesce(avg({amount}), 0)) AS p FROM {rel})"""


def amount_sql(a: str) -> dict[str, str]:
    return {
        "log_amount": f"CASE WHEN {a} > -1 THEN ln(1 + {a}) END",
        "amount_z": f"({a} - st.m) / st.s",
        "is_high_amount": f"CAST(CASE WHEN {a} > st.p THEN 1 ELSE 0 END AS INTEGER)",
    }


def clock_sql(h: str) -> dict[str, str]:
    return {
        "hour": h,
        "hour_sin": f"sin(2 * pi() * ({h}) / 24)",
        "hour_cos": f"cos(2 * pi() * ({h}) / 24)",
        "is_night": f"CAST(CASE WHEN ({h}) >= 22 OR ({h}) <= 6 THEN 1 ELSE 0 END AS INTEGER)",
    }


def calendar_sql(ts: str) -> dict[str, str]:
    return {
        "day_of_week": f"CAST(dayofweek({ts}) + 1 AS INTEGER)",
        "is_weekend": f"CAST(CASE WHEN dayofweek({ts}) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER)",
        "txn_month": f"CAST(month({ts}) AS INTEGER)",
    }


NO_CALENDAR_SQL = {c: "CAST(0 AS INTEGER)" for c in ("day_of_week", "is_weekend", "txn_month")}
NO_USER_SQL = {
    "user_mean_amount": "CAST(0 AS DOUBLE)",
    "user_std_amount": "CAST(0 AS DOUBLE)",
    "user_txn_count": "CAST(0 AS BIGINT)",
    "user_amount_z": "CAST(0 AS DOUBLE)",
}
NO_PCA_SQL = {c: "CAST(0 AS DOUBLE)" for c in ("pca_l2", "pca_max_abs", "pca_mean")}


def user_sql(a: str) -> dict[str, str]:
    return {
        "user_mean_amount": "u.mean_a",
        "user_std_amount": "u.std_a",
        "user_txn_count": "u.n",
        "user_amount_z": f"({a} - u.mean_a) / CASE WHEN u.std_a > 0 THEN u.std_a ELSE 1 END",
    }


def pca_sql() -> dict[str, str]:
    v = [f"V{i}" for i in range(1, 29)]
    return {
        "pca_l2": f"sqrt({' + '.join(f'{c} * {c}' for c in v)})",
        "pca_max_abs": f"greatest({', '.join(f'abs({c})' for c in v)})",
        "pca_mean": f"({' + '.join(v)}) / 28.0::DOUBLE",
    }


DOUBLES = {c for c, ty in UNIVERSAL_TYPES_V1.items() if ty == "double"}


def select_sql(exprs: dict[str, str]) -> str:
    return ", ".join(f"round({e}, 6) AS {c}" if c in DOUBLES else f"{e} AS {c}" for c, e in exprs.items())


def epoch_sql(ts: str) -> str:
    return f"floor(epoch({ts}))"


def dataset_sql(name: str, rel: str, amount: str, time: str, user: str | None, label: str, version: str = "v2") -> str:
    """One dataset's features as a SELECT over a relation defined before."""
    a = f't."{amount}"'
    seconds = f't."{time}"' if user is None else epoch_sql(f't."{time}"')
    exprs = amount_sql(a)
    pct = f'percent_rank() OVER (ORDER BY {a} NULLS FIRST)'
    exprs |= clock_sql(f"fmod({seconds} / 3600.0::DOUBLE, 24)")
    if user is None:
        exprs |= NO_CALENDAR_SQL | NO_USER_SQL | pca_sql()
    else:
        exprs |= calendar_sql(f't."{time}"') | user_sql(a) | NO_PCA_SQL
    exprs |= {
        "txn_count_5m": "b.n",
        "label": f"CAST({label} AS INTEGER)",
        "source": f"'{name}'",
    }
    if version == "v1":
        exprs["amount_pct"] = pct
    cols = UNIVERSAL_COLS_V1 if version == "v1" else UNIVERSAL_COLS
    bucket = f"CAST(floor({seconds} / 300) AS BIGINT)"
    users = (
        f"""LEFT JOIN (SELECT {user} AS k, avg("{amount}") AS mean_a, stddev_samp("{amount}") AS std_a,
             count(*) AS n FROM {rel} GROUP BY 1) u ON t.{user} = u.k"""
        if user
        else ""
    )
    return f"""SELECT {select_sql({c: exprs[c] for c in cols})}
      FROM {rel} t CROSS JOIN {amount_stats_sql(rel, f'"{amount}"')} st {users}
      LEFT JOIN (SELECT {bucket.replace('t.', '')} AS k, count(*) AS n FROM {rel} GROUP BY 1) b ON {bucket} = b.k"""


def datasets_sql(version: str = "v2") -> dict[str, str]:
    return {
        "financial": dataset_sql(
            "financial", "financial", "amount", "timestamp", "sender_account",
            "CASE WHEN is_fraud THEN 1 ELSE 0 END", version,
        ),
        "creditcard": dataset_sql("creditcard", "creditcard", "Amount", "Time", None, '"Class"', version),
        "card_fraud": dataset_sql(
            "credit_card_fraud", "card_fraud", "Amount", "TransactionDate", "MerchantID", "IsFraud", version
        ),
    }


ALL_SQL = f"WITH {t.FINANCIAL_SQL}, {t.CREDITCARD_SQL}, {t.CARD_FRAUD_SQL}"


def universal_sql(version: str = "v2") -> str:
    parts = datasets_sql(version)
    return f"{ALL_SQL} " + " UNION ALL ".join(f"({p})" for p in parts.values())


# -- queries ------------------------------------------------------------------


def universal(spark, sf_dir, **options):
    return plans.universal_features(
        t.financial(spark, sf_dir), t.creditcard(spark, sf_dir), t.card_fraud(spark, sf_dir), **options
    )


def h1(spark, sf_dir):
    df = plans.add_amount_features(t.financial(spark, sf_dir), "amount", version="v1")
    return t.rounded(df.select("row_id", "log_amount", "amount_z", "amount_pct", "is_high_amount"))


def h2(spark, sf_dir):
    df = plans.add_time_features_numeric(t.creditcard(spark, sf_dir), "Time")
    cols = ["hour", "hour_sin", "hour_cos", "is_night", "day_of_week", "is_weekend", "txn_month"]
    return t.rounded(df.select("row_id", *cols))


def h3(spark, sf_dir):
    df = plans.add_time_features_datetime(t.financial(spark, sf_dir), "timestamp")
    cols = ["ts", "hour", "hour_sin", "hour_cos", "is_night", "day_of_week", "is_weekend", "txn_month"]
    return t.rounded(df.select("row_id", *cols))


def h4(spark, sf_dir):
    df = plans.add_user_features(t.financial(spark, sf_dir), "sender_account", "amount")
    cols = ["user_mean_amount", "user_std_amount", "user_txn_count", "user_amount_z"]
    return t.rounded(df.select("row_id", *cols))


def h5(spark, sf_dir):
    df = plans.add_time_features_datetime(t.financial(spark, sf_dir), "timestamp")
    return plans.add_velocity_features(df, "ts").select("row_id", "txn_count_5m")


def h6(spark, sf_dir):
    df = plans.add_pca_features(t.creditcard(spark, sf_dir))
    return t.rounded(df.select("row_id", "pca_l2", "pca_max_abs", "pca_mean"))


QUERIES = {
    "add_amount_features": h1,
    "add_time_features_numeric": h2,
    "add_time_features_datetime": h3,
    "add_user_features": h4,
    "add_velocity_features": h5,
    "add_pca_features": h6,
    "features_financial": lambda s, d: t.rounded(plans.features_financial(t.financial(s, d))),
    "features_creditcard": lambda s, d: t.rounded(plans.features_creditcard(t.creditcard(s, d))),
    "features_card_fraud": lambda s, d: t.rounded(plans.features_card_fraud(t.card_fraud(s, d))),
    "universal_features": lambda s, d: t.rounded(universal(s, d)),
    "universal_features_v1": lambda s, d: t.rounded(universal(s, d, version="v1")),
    "union_sources": lambda s, d: universal(s, d)
    .groupBy("source")
    .agg(F.count("*").alias("n_rows"), F.sum("user_txn_count").alias("sum_user_txn_count")),
    "project_universal": lambda s, d: t.rounded(
        C.select_universal(plans.features_creditcard(t.creditcard(s, d)).withColumn("extra", F.lit(1)))
    ),
}

_parts = datasets_sql()

ORACLES = {
    "add_amount_features": f"""WITH {t.FINANCIAL_SQL}
      SELECT row_id, {select_sql(amount_sql("t.amount"))},
             round(percent_rank() OVER (ORDER BY t.amount NULLS FIRST), 6) AS amount_pct
      FROM financial t CROSS JOIN {amount_stats_sql("financial", "amount")} st""",
    "add_time_features_numeric": f"""WITH {t.CREDITCARD_SQL}
      SELECT row_id, {select_sql(clock_sql('fmod("Time" / 3600.0::DOUBLE, 24)') | NO_CALENDAR_SQL)} FROM creditcard""",
    "add_time_features_datetime": f"""WITH {t.FINANCIAL_SQL}
      SELECT row_id, CAST({epoch_sql('"timestamp"')} AS BIGINT) AS ts,
        {select_sql(clock_sql(f'''fmod({epoch_sql('"timestamp"')} / 3600.0::DOUBLE, 24)''') | calendar_sql('"timestamp"'))}
      FROM financial""",
    "add_user_features": f"""WITH {t.FINANCIAL_SQL}
      SELECT row_id, {select_sql(user_sql("t.amount"))}
      FROM financial t LEFT JOIN (SELECT sender_account AS k, avg(amount) AS mean_a, stddev_samp(amount) AS std_a,
        count(*) AS n FROM financial GROUP BY 1) u ON t.sender_account = u.k""",
    "add_velocity_features": """SELECT event_id AS row_id,
        count(*) OVER (PARTITION BY floor(floor(epoch(ts)) / 300)) AS txn_count_5m FROM events""",
    "add_pca_features": f"WITH {t.CREDITCARD_SQL} SELECT row_id, {select_sql(pca_sql())} FROM creditcard",
    "features_financial": f"WITH {t.FINANCIAL_SQL} {_parts['financial']}",
    "features_creditcard": f"WITH {t.CREDITCARD_SQL} {_parts['creditcard']}",
    "features_card_fraud": f"WITH {t.CARD_FRAUD_SQL} {_parts['card_fraud']}",
    "universal_features": universal_sql(),
    "universal_features_v1": universal_sql("v1"),
    "union_sources": f"""{ALL_SQL}, u AS ({" UNION ALL ".join(f"({p})" for p in _parts.values())})
      SELECT source, count(*) AS n_rows, CAST(sum(user_txn_count) AS BIGINT) AS sum_user_txn_count FROM u GROUP BY 1""",
    "project_universal": f"WITH {t.CREDITCARD_SQL} {_parts['creditcard']}",
}
