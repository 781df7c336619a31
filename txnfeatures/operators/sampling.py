"""Caps and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnfeatures.operators.ranks import value_at_rank
from txnfeatures.sources.writers import discard, scratch_uri

# Row hashes lie in [0, HASH_RANGE), where doubles are exact.
HASH_BITS = 53
HASH_RANGE = 2**HASH_BITS
# Bits of the hash that one round of a search by source looks at: a source's counts of a round are at most 2**STEP_BITS.
STEP_BITS = 12
# Rows of one source that are sorted together once its cut is known that closely.
SMALL_GROUP = 100_000


def key_cut(df: DataFrame, n: int, key: str) -> float | int | None:
    """The ``n``-th smallest ``key``; None when there are fewer."""
    cut = value_at_rank(df, key, n)
    whole = dict(df.dtypes)[key] in ("bigint", "int")
    if cut is not None and whole and abs(cut) >= 2**53:
        # Whole numbers this large share doubles: settle the last few by value.
        as_double = F.col(key).cast("double")
        below = df.where(as_double < cut).count()
        tied = df.where(as_double == cut).select(key).orderBy(key).limit(n - below)
        return tied.agg(F.max(key)).first()[0]
    return int(cut) if cut is not None and whole else cut


def cap_rows(df: DataFrame, n: int, order_key: str) -> DataFrame:
    """The ``n`` rows with the smallest ``order_key`` (a unique number).

    The cut is found as an exact order statistic, so no task has to hold ``n``
    rows, as one would with a sort and a limit.
    """
    if n < 1:
        return df.limit(0)
    cut = key_cut(df, n, order_key)
    return df.where(F.col(order_key).isNotNull() if cut is None else F.col(order_key) <= F.lit(cut))


def cap_rows_by_source(df: DataFrame, n: int, order_key: str, source: str = "source") -> DataFrame:
    """About ``n`` rows with about the sources' shares.

    Keeps rows whose hashed source and key fall below the wanted share: no
    shuffle, and the same rows every time.  Sources are drawn independently.
    """
    total = df.count()
    share = min(1.0, n / total) if total else 1.0
    return df.where(row_hash(source, order_key, seed=7919) < F.lit(int(share * HASH_RANGE)))


def shares_by_source(counts: DataFrame, n: int, source: str) -> DataFrame:
    """Largest-remainder shares of ``n`` rows: ``source``, its count ``_rows`` and its share ``_take``.

    ``counts`` has one row (``source``, ``_rows``) a source; the one window over
    all of them is as long as there are sources.  Equal remainders go by source, null first.
    """
    total = counts.agg(F.sum("_rows")).first()[0] or 1
    wide = "CAST(CAST(_rows AS DECIMAL(19,0)) * CAST({} AS DECIMAL(19,0)) AS DECIMAL(38,0))".format(min(n, total))
    split = counts.selectExpr("*", f"CAST({wide} DIV {total} AS BIGINT) AS _whole", f"CAST({wide} % {total} AS BIGINT) AS _rest")
    left = F.lit(min(n, total)) - F.sum("_whole").over(Window.partitionBy())
    turn = F.row_number().over(Window.orderBy(F.desc("_rest"), source))
    return split.withColumns({"_left": left, "_turn": turn}).select(
        source, "_rows", (F.col("_whole") + (F.col("_turn") <= F.col("_left")).cast("bigint")).alias("_take")
    )


def cap_rows_exact(df: DataFrame, n: int, order_key: str, source: str = "source", small: int = SMALL_GROUP) -> DataFrame:
    """Exactly ``n`` rows (all, where there are fewer), each source within one row of its share, null a source like others.

    Of a source the rows with the smallest hash of ``order_key`` stay, so the
    choice is random but the same on every run; ``order_key`` must be unique
    in its source and of a type that can be ordered.  Every source's cut is found in the same jobs: a round counts
    the rows per source and ``STEP_BITS`` bits of the hash below the prefix that
    the cut is known to have, until no source has more than ``small`` rows with
    its prefix; those are then ordered by hash and key.  A round leaves about a
    4,096th of the rows, two rounds serve 10**12 rows of a source.  The counts are
    added up before they are shuffled, so a source may hold all rows.  Other
    columns, of whatever name, travel only in the last join, on a table of one row a source.
    """
    if n < 1:
        return df.limit(0)
    spark = df.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.select(F.col(f"`{source}`").alias("s"), F.col(f"`{order_key}`").alias("k"))
    keyed = keyed.select("s", "k", _hash_of("s", "k").alias("h"))
    counts = keyed.groupBy("s").agg(F.count("*").alias("_rows"))
    state = shares_by_source(counts, n, "s").select("s", F.lit(0).cast("bigint").alias("prefix"), "_rows", "_take")
    paths: list[str] = []

    def keep(table: DataFrame) -> DataFrame:
        paths.append(scratch_uri(spark, "source-cuts"))
        table.write.parquet(paths[-1])
        return spark.read.schema(table.schema).parquet(paths[-1])

    try:
        state, bits = keep(state), 0
        while bits < HASH_BITS and not state.where(F.col("_rows") > small).isEmpty():
            step = min(STEP_BITS, HASH_BITS - bits)
            inside = _with_prefix(keyed, state, bits).groupBy("s", F.shiftrightunsigned("h", HASH_BITS - bits - step).alias("prefix"))
            inside = inside.agg(F.count("*").alias("_rows"), F.first("_take").alias("_take"))
            ahead = Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
            found = inside.withColumn("_ahead", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
            # The prefix in which the source's last row lies; a source that gives nothing has none.
            found = found.where((F.col("_ahead") < F.col("_take")) & (F.col("_take") <= F.col("_ahead") + F.col("_rows")))
            state = keep(found.select("s", "prefix", "_rows", (F.col("_take") - F.col("_ahead")).alias("_take")))
            bits += step
        place = F.row_number().over(Window.partitionBy("s").orderBy("h", "k"))
        last = _with_prefix(keyed, state, bits).withColumn("_place", place).where(F.col("_place") == F.col("_take"))
        # Not deleted: what is returned reads it.
        cuts = last.select(F.col("s").alias("_s"), F.struct("h", "k").alias("_cut"))
        uri = scratch_uri(spark, "source-cuts")
        cuts.write.parquet(uri)
        cuts = spark.read.schema(cuts.schema).parquet(uri)
    finally:
        for path in paths:
            discard(spark, path)
    own = F.col("_row").getField(source), F.col("_row").getField(order_key)
    at = F.struct(_hash_of(*own).alias("h"), own[1].alias("k"))
    kept = df.select(row.alias("_row")).join(cuts, own[0].eqNullSafe(F.col("_s")) & (at <= F.col("_cut")), "left_semi")
    return kept.select("_row.*")


def _hash_of(source: Column | str, key: Column | str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(7919), source, key), 64 - HASH_BITS)


def _with_prefix(keyed: DataFrame, state: DataFrame, bits: int) -> DataFrame:
    """Rows whose hash starts with the prefix of their source's cut, with what the source still takes."""
    prefixes = state.select(F.col("s").alias("_s"), F.col("prefix").alias("_prefix"), "_take")
    # All 64 places of a shift by HASH_BITS are gone, so a prefix of no bits is 0.
    same = F.col("s").eqNullSafe(F.col("_s")) & (F.shiftrightunsigned("h", HASH_BITS - bits) == F.col("_prefix"))
    return keyed.join(prefixes, same).drop("_s", "_prefix")


def row_hash(*keys: str, seed: int = 42) -> Column:
    """Hash of the key columns in [0, ``HASH_RANGE``)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)


def stratified_split(
    df: DataFrame, key: str, label: str = "label", test_share: float = 0.2, seed: int = 42, name: str = "is_test", exact: bool = True
) -> DataFrame:
    """Mark ``test_share`` of the rows as test rows, every row 0 or 1.

    With exactly two classes each is cut at the order statistic of its rows'
    hashes, so shares are exact to one row (``key`` unique); with any other
    number of classes, or rows without one, all rows are cut together.  A row's
    side depends on its key: the same split on every run.  ``exact=False`` marks
    rows by hash alone, without a job, and does not look at the label.
    """
    h = row_hash(key, seed=seed)
    if not exact:
        return df.withColumn(name, (h < F.lit(int(test_share * HASH_RANGE))).cast("int"))
    hashed = df.select(h.alias("h"), F.col(label).alias("y"))
    classes = [r["y"] for r in hashed.groupBy("y").agg(F.count("*").alias("n")).limit(3).collect()]
    strata = [F.col(label) == y for y in classes] if len(classes) == 2 and None not in classes else [F.lit(True)]
    out = F.lit(0)
    for i, stratum in enumerate(strata):
        mine = hashed.where(F.col("y") == classes[i]) if len(strata) == 2 else hashed
        n = mine.count()
        cut = value_at_rank(mine, "h", round(n * test_share)) if n else None
        hit = F.lit(0) if cut is None else (h <= F.lit(int(cut))).cast("int")
        out = F.when(stratum, hit).otherwise(out)
    return df.withColumn(name, out)


def head(df: DataFrame, n: int, order_key: str, columns: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_key``, chosen columns only."""
    out = df.orderBy(order_key).limit(n)
    return out.select(*columns) if columns else out
