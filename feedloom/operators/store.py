"""Table semantics the timeline stores rely on (T1-T6), as explicit operators.

Plain parquet has no keys or TTL, so the stores are merge-on-read:
every write appends rows stamped with ``ingest_ts``, ``expire_at`` and
``batch_id``; readers resolve keys (last write wins) and hide expired rows;
compaction applies the same resolution once and writes a new table.

Resolution is built from hash-aggregatable ``max`` aggregates wherever the
table has no payload column, so it runs map-side partial aggregation and
keeps the key's rows spread by the full (uid, time) key (a hot reader's rows
do not meet in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.config import FeedConfig
from feedloom.functions.parse import utc_time

META = ("ingest_ts", "expire_at")


def with_expiry(df: DataFrame, cfg: FeedConfig = FeedConfig(), ingest_col: str | None = "time") -> DataFrame:
    """W9. Stamp ingest time and expiry (ingest_ts + ttl).

    ``ingest_col`` None stamps the write time (UTC, as the TTL of a store
    counts from the write); a column name stamps that column (deterministic)."""
    if ingest_col is None:
        ing = utc_time(F.unix_micros(F.current_timestamp()) / F.lit(1_000_000).cast("decimal(18,6)"))
    else:
        ing = F.col(ingest_col).cast("timestamp_ntz")
    return df.withColumn("ingest_ts", ing).withColumn(
        "expire_at", ing + F.make_dt_interval(secs=F.lit(cfg.ttl_seconds)))


def upsert_uid_time(df: DataFrame, policy: str = "upsert", payload: tuple[str, ...] = (), placed: bool = False,
                    tasks: int | None = None) -> DataFrame:
    """T1. One row per (uid, time): the largest tid wins, of its writes the latest
    (then the longest lived, then the largest payload hash), and every column is that
    row's.  ``keep_all`` keys rows by (uid, time, tid) instead.  ``placed``: rows of a key
    already lie in one partition.  ``tasks``: at least so many, where rows were counted."""
    meta = [c for c in META if c in df.columns]
    key = ["uid", "time", "tid"] if policy == "keep_all" else ["uid", "time"]
    hashed = ["tweet_hash"] if "tweet_hash" in df.columns else []
    order = [c for c in ("tid", *meta, *(hashed or payload)) if c not in key]
    if not order:
        return df.groupBy(*key).count().drop("count")
    if payload and hashed:
        # payloads (VARIANT) have no order of their own
        last = F.struct(*order)
        out = df.groupBy(*key).agg(F.max(last).alias("_w"), F.max_by(F.struct(*payload), last).alias("_p"))
        return out.select(*key, *[F.col("_w")[c].alias(c) for c in order], *[F.col("_p")[c].alias(c) for c in payload])
    if payload or not meta:
        best = F.max(F.struct(*order)).alias("_w") if len(order) > 1 else F.max(order[0]).alias(order[0])
        out = df.groupBy(*key).agg(best)
        return out.select(*key, *[F.col("_w")[c].alias(c) for c in order]) if len(order) > 1 else out
    # fixed-width columns only: the same order by hash aggregates, inside one partitioning
    # (all shuffle partitions: several aggregates hold a task's keys at a time)
    most = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks or 1)
    rows = df if placed else df.repartition(most, *key)
    for k in range(len(order) - 1, -1, -1):
        by, after = order[k], order[k + 1:]
        rows = rows.groupBy(*key, *order[:k]).agg(F.max(by).alias(by), *[F.max_by(c, by).alias(c) for c in after])
    return rows


def upsert_placed(df: DataFrame, part: str) -> DataFrame:
    """T1 of narrow rows (uid, ``part``, time, tid) that already lie together by (uid, ``part``),
    ``part`` being one for all rows of a (uid, time): the largest tid wins, nothing is moved."""
    return df.groupBy("uid", part, "time").agg(F.max("tid").alias("tid")).drop(part)


def upsert_tid(df: DataFrame, payload: str = "tweet") -> DataFrame:
    """T2. One row per tid; the latest write wins, ties broken by payload hash (or raw payload)."""
    meta = [c for c in META if c in df.columns]
    if "tweet_hash" in df.columns:
        last = F.struct(*meta, "tweet_hash")
        out = df.groupBy("tid").agg(F.max(last).alias("_w"), F.max_by(payload, last).alias(payload))
        return out.select("tid", payload, *[F.col("_w")[c].alias(c) for c in ("tweet_hash", *meta)])
    w = F.max(F.struct(*meta, F.col(payload))).alias("_w")
    return df.groupBy("tid").agg(w).select("tid", F.col(f"_w.{payload}").alias(payload), *[F.col(f"_w.{c}").alias(c) for c in meta])


def visible(df: DataFrame, as_of: str) -> DataFrame:
    """T4. Rows whose TTL has not run out at ``as_of`` (always an argument)."""
    return df.filter(F.col("expire_at") > F.lit(as_of).cast("timestamp_ntz"))


def clustered(df: DataFrame) -> DataFrame:
    """T3. Newest-first order inside each written file (no shuffle)."""
    return df.sortWithinPartitions("uid", F.desc("time"))


def resolve(table: str, df: DataFrame, cfg: FeedConfig = FeedConfig(), as_of: str | None = None,
            placed: bool = False, tasks: int | None = None) -> DataFrame:
    """Expiry, then the key semantics of ``table`` (``as_of`` None: keep expired).

    Columns that are neither key nor stamp are payload: the winning row's.

    Expired writes leave first, as in a store where each written cell lives for
    its own time: they can neither hide nor outlive another write of their key.
    The filter is on a stored column, so it reaches the scan."""
    live = df if as_of is None else visible(df, as_of)
    if table == "tweets":
        return upsert_tid(live)
    own = ("uid", "time", "tid", "tweet_hash", *META)
    return upsert_uid_time(live, cfg.policy, tuple(c for c in df.columns if c not in own), placed, tasks)
