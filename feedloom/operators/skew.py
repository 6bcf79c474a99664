"""Skew-safe equi-join for the fan-out: hot keys are split on both sides.

A key's work is the product of its rows on the two sides.  Where that exceeds
``split_rows``, the large side's rows are dealt over ``_se`` salt values (by a
hash of a spreading column) and the other side's over ``_st``; each side is
replicated over the other's salts, so every pair of rows still meets once, in a
task that makes about ``split_rows`` rows.  An author with many followers, one
with many tweets and one with both are all split.  Cold keys keep salt 0 on
both sides, so for them the join is the plain equi-join.

The hot-key table is broadcast.  Its size is bounded without looking at the
data: every hot key makes more than ``split_rows`` output rows, so there are at
most (output rows) / ``split_rows`` of them (at 2M: 500k keys, some 10 MB, for a
trillion rows written).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def hot_keys(small: DataFrame, big_counts: DataFrame, key: str | list[str], split_rows: int) -> DataFrame:
    """(key, _se, _st) of the keys whose product exceeds ``split_rows``.

    big_counts: (key, _n), rows of the large side per key."""
    key = _keys(key)
    t = small.groupBy(*key).agg(F.count(F.lit(1)).alias("_t"))         # partial agg
    n_, t_, split = F.col("_n"), F.col("_t"), F.lit(split_rows)
    se = F.least(n_, F.ceil(n_ * t_ / split))
    return (big_counts.select(*key, "_n").join(t, key).filter(n_ * t_ > split)
            .withColumn("_se", se.cast("int"))
            .withColumn("_st", F.ceil(t_ * F.ceil(n_ / F.col("_se")) / split).cast("int"))
            .select(*key, "_se", "_st"))


def salted_join(small: DataFrame, big: DataFrame, key: str | list[str], spread_col: str, small_spread: str,
                split_rows: int, big_counts: DataFrame | None = None, spread: bool = False,
                order: list | None = None, tasks: int | None = None, small_keys: DataFrame | None = None) -> DataFrame:
    """Inner join ``small`` to ``big`` on ``key`` (a column or several) with hot keys split.

    ``spread``: the join makes far more than it reads (a fan-out), so its tasks must not be
    merged by the size of their input: both sides keep all shuffle partitions, or
    ``tasks`` if these are more.
    ``order`` (with ``spread``): the large side is sorted by it within tasks before the join,
    and the joined rows come in that order, so what the small side adds is never sorted.
    ``small_keys``: rows with the keys of ``small``, if these are cheaper to count.
    Output has the columns of both sides (``key`` once); no helper columns."""
    key = _keys(key)
    if big_counts is None:
        big_counts = big.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(hot_keys(small if small_keys is None else small_keys, big_counts, key, split_rows))   # bounded, see module doc
    own = lambda col, n: F.coalesce(F.pmod(F.xxhash64(F.col(col)), F.col(n)), F.lit(0)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))
    big_s = (big.join(hot, key, "left").withColumn("_e", own(spread_col, "_se")).withColumn("_s", every("_st"))
             .drop("_se", "_st"))
    small_s = (small.join(hot, key, "left").withColumn("_s", own(small_spread, "_st")).withColumn("_e", every("_se"))
               .drop("_se", "_st"))
    on = [*key, "_e", "_s"]
    if spread:
        n = max(int(small.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks or 1)
        small_s, big_s = small_s.repartition(n, *on), big_s.repartition(n, *on)
    if order is None:
        return small_s.join(big_s, on, "inner").drop("_e", "_s")
    joined = in_order(big_s, order).join(small_s.hint("shuffle_hash"), on, "inner")
    return joined.filter(PLACE_USED).drop("_e", "_s", "_place")


#: the optimizer drops a sort below a join unless the place of a row in it is used
PLACE_USED = "_place >= 0"


def in_order(df: DataFrame, order: list) -> DataFrame:
    """Rows sorted within their tasks, with their ``_place``; a hash join that streams them keeps the order."""
    return df.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
