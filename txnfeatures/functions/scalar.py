"""Row-local expressions.  Everything here is a Catalyst expression: no UDFs.

Datetimes are handled as ``timestamp_ntz`` so that results do not move with the
session time zone, and raw text goes through ``try_cast`` so that they do not
depend on the ANSI setting either.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnfeatures.schema import BUCKET_SECONDS


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    return _c(c).try_cast("double")


# -- amount -----------------------------------------------------------------


def log_amount(amount) -> Column:
    """``log1p``; null for amounts of -1 and below."""
    return F.log1p(as_double(amount))


def zscore(x, mean, std) -> Column:
    return (as_double(x) - mean) / std


def high_flag(amount, cut) -> Column:
    return F.when(as_double(amount) > cut, 1).otherwise(0)


# -- time -------------------------------------------------------------------


def parse_ts(c) -> Column:
    return _c(c).try_cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """Whole seconds of a ``timestamp_ntz`` read as UTC."""
    return F.unix_timestamp(_c(ts))


def hour_fraction(seconds) -> Column:
    """Hour of the day with its fraction; keeps the sign of the dividend."""
    return (_c(seconds).cast("double") / F.lit(3600.0)) % F.lit(24.0)


def hour_fraction_positive(seconds) -> Column:
    """The scoring-side variant, in [0, 24) for negative seconds as well."""
    return F.pmod(_c(seconds).cast("double") / F.lit(3600.0), F.lit(24.0))


def hour_int(ts) -> Column:
    return F.hour(_c(ts))


def _angle(hour) -> Column:
    return F.lit(2 * math.pi) * _c(hour) / F.lit(24.0)


def hour_sin(hour) -> Column:
    return F.sin(_angle(hour))


def hour_cos(hour) -> Column:
    return F.cos(_angle(hour))


def night_flag(hour) -> Column:
    h = _c(hour)
    return F.when((h >= 22) | (h <= 6), 1).otherwise(0)


def day_of_week(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(ts))


def day_of_week_serving(ts) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(ts))


def weekend_flag(dow) -> Column:
    return F.when(_c(dow).isin(1, 7), 1).otherwise(0)


def weekend_flag_serving(dow) -> Column:
    return F.when(_c(dow) >= 5, 1).otherwise(0)


def month(ts) -> Column:
    return F.month(_c(ts))


def txn_year(seconds=None) -> Column:
    """Column of the first contract version that, despite its name, holds the
    epoch seconds (0 where the source has no calendar)."""
    return F.lit(0.0) if seconds is None else _c(seconds).cast("double")


def time_bucket(seconds, width: int = BUCKET_SECONDS) -> Column:
    return F.floor(_c(seconds) / F.lit(width)).cast("bigint")


# -- component magnitudes ----------------------------------------------------


# Written as one SQL string each: a sum of 28 terms built operator by operator
# costs more to construct than to run.


def _components(cols, missing_as_zero: bool) -> list[str]:
    doubles = [f"try_cast(`{c}` AS DOUBLE)" for c in cols]
    return [f"coalesce({d}, 0D)" for d in doubles] if missing_as_zero else doubles


def pca_l2(cols, missing_as_zero: bool = False) -> Column:
    return F.expr(f"sqrt({' + '.join(f'{d} * {d}' for d in _components(cols, missing_as_zero))})")


def pca_max_abs(cols, missing_as_zero: bool = False) -> Column:
    """One n-ary ``greatest``; skips nulls, null only if all are null."""
    mags = [f"abs({d})" for d in _components(cols, missing_as_zero)]
    return F.expr(f"greatest({', '.join(mags)})" if len(mags) > 1 else mags[0])


def pca_mean(cols, missing_as_zero: bool = False) -> Column:
    parts = _components(cols, missing_as_zero)
    return F.expr(f"({' + '.join(parts)}) / {len(parts)}D")


# -- user -------------------------------------------------------------------


def user_amount_z(amount, mean, std) -> Column:
    s = _c(std)
    return (as_double(amount) - _c(mean)) / F.when(s > 0, s).otherwise(F.lit(1.0))


def user_amount_z_serving(amount, mean, std) -> Column:
    """Scoring side: only a missing deviation becomes 1, a zero one gives null."""
    return F.try_divide(as_double(amount) - _c(mean), F.coalesce(_c(std), F.lit(1.0)))
