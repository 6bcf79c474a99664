"""Follower lookup and fan-out on write.

The reference looks up a follower set per tweet with a point query and
flat-maps it.  Here the lookup is one equi-join of the tweet frame with the
edge frame ``(uid, follower)``: exploded edges ship 16-byte rows, never copy
a popular author's follower array into each tweet row, and hot authors are
salted (``operators.skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.config import FeedConfig
from feedloom.operators.skew import PLACE_USED, in_order, salted_join

AUTHOR_BUCKET = "author_bucket"


def list_store_edges(edges: DataFrame) -> DataFrame:
    """J2/J7/W8. List-store adjacency: edge rows as pushed (duplicates kept),
    follower ids cast from text when needed; no listener."""
    return edges.select(F.col("uid").cast("bigint").alias("uid"),
                        F.col("follower").try_cast("bigint").alias("follower")) \
                .filter(F.col("follower").isNotNull())


def author_stats(edges: DataFrame, listener: int | None) -> DataFrame:
    """One row per author with a follower row: edge count and whether the
    listener already follows (one partial aggregation, shared by the listener
    injection and the hot-key detection)."""
    has = (F.col("follower") == listener).cast("int") if listener is not None else F.lit(0)
    return edges.groupBy("uid").agg(F.count(F.lit(1)).alias("_n"), F.max(has).alias("_has"))


def with_listener(edges: DataFrame, listener: int | None, stats: DataFrame | None = None) -> DataFrame:
    """J3. ``listener`` joins every EXISTING follower set (authors without a
    row stay without one).  Set semantics: the pair is added only where it is
    missing, found by one per-uid aggregation (no distinct over all edges)."""
    if listener is None:
        return edges
    stats = stats if stats is not None else author_stats(edges, listener)
    missing = stats.filter(F.col("_has") == 0).select(
        "uid", F.lit(listener).cast("bigint").alias("follower"))
    return edges.unionByName(missing)


def delivery_edges(edges: DataFrame, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Who receives an author's tweets: set store = distinct follower sets
    plus the listener; list store = the edges as stored."""
    return delivery_plan(edges, cfg)[0]


def delivery_plan(edges: DataFrame, cfg: FeedConfig = FeedConfig()) -> tuple[DataFrame, DataFrame]:
    """(delivery edges, receivers per author) from one per-author aggregation.

    The counts (uid, _n) tell the fan-out which authors to split."""
    if cfg.store == "list":
        e = list_store_edges(edges)
        return e, author_stats(e, None).select("uid", "_n")
    e = edges.select("uid", "follower")
    stats = author_stats(e, cfg.listener)
    more = 1 - F.col("_has") if cfg.listener is not None else F.lit(0)
    return with_listener(e, cfg.listener, stats), stats.select("uid", (F.col("_n") + more).alias("_n"))


def author_bucket(uid, buckets: int):
    return F.pmod(F.xxhash64(uid), F.lit(buckets)).cast("int")


def publish_delivery(edges: DataFrame, cfg: FeedConfig, path: str) -> None:
    """Append the delivery rows of ``edges`` (listener injected) to the delivery
    table.  A stream re-reads the table every batch (ST3) and runs with
    ``listener=None``, so no batch re-aggregates the edges; appending never
    touches files that a running batch reads."""
    append_delivery(delivery_edges(edges, cfg), cfg, path)


def append_delivery(rows: DataFrame, cfg: FeedConfig, path: str) -> None:
    """ST3. Delivery rows, parted by author bucket.

    Rows of a bucket meet in one task (the rebalance splits a bucket that is too large
    for one), so an append adds about one file a bucket."""
    parted = rows.withColumn(AUTHOR_BUCKET, author_bucket(F.col("uid"), cfg.author_buckets))
    parted.hint("rebalance", AUTHOR_BUCKET).write.mode("append").partitionBy(AUTHOR_BUCKET).parquet(path)


def read_delivery(spark, path: str) -> DataFrame:
    """The delivery table as it is now: (uid, follower, author_bucket)."""
    return spark.read.schema(f"uid bigint, follower bigint, {AUTHOR_BUCKET} int").parquet(path)


def list_store_rows(edges: DataFrame) -> DataFrame:
    """W8. The list store as rows: every edge pushed once in each direction
    (``followers`` of uid and ``following`` of follower); no set semantics."""
    fwd = edges.select(F.lit("followers").alias("direction"), F.col("uid").alias("owner"),
                       F.col("follower").cast("string").alias("member"))
    back = edges.select(F.lit("following").alias("direction"), F.col("follower").alias("owner"),
                        F.col("uid").cast("string").alias("member"))
    return fwd.unionByName(back)


def publish_list_store(edges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """W8 load: both directions, partitioned by direction so a reader of one
    direction prunes the other."""
    list_store_rows(edges).write.mode(mode).partitionBy("direction").parquet(path)


def read_list_store(spark, path: str, direction: str = "followers") -> DataFrame:
    """J2 lookup side: (uid, follower) as stored text ids (cast by J7)."""
    rows = spark.read.parquet(path).filter(F.col("direction") == direction)
    return rows.select(F.col("owner").alias("uid"), F.col("member").alias("follower"))


def of_buckets(delivery: DataFrame, buckets: list[int] | None) -> DataFrame:
    """The parts of a delivery table that hold the authors of a measured batch.

    The optimizer's own pruning by a broadcast side is lost where that side is a cached
    micro-batch, so the buckets, at most ``cfg.author_buckets`` numbers, are a filter on
    the partition column: the other parts are not even listed as input."""
    if buckets is None or AUTHOR_BUCKET not in delivery.columns:
        return delivery
    return delivery.filter(F.col(AUTHOR_BUCKET).isin(buckets) if buckets else F.lit(False))


def follower_stats(followers: DataFrame) -> DataFrame:
    """Per-author size and id sum of the delivery set (pre-aggregated lookup side)."""
    return followers.groupBy("uid").agg(F.count(F.lit(1)).alias("n_followers"),
                                        F.sum("follower").alias("sum_followers"))


def join_followers_left(tweets: DataFrame, followers: DataFrame) -> DataFrame:
    """J1. Every tweet with its author's follower set summary; null = no row.
    The set is aggregated per author before the join, so the lookup side has
    one row per author whatever the follower counts are."""
    return tweets.join(follower_stats(followers), "uid", "left")


def _authors(followers: DataFrame) -> DataFrame:
    # distinct authors: partial aggregation turns a hot author's edges into one
    # row per map task before anything is shuffled
    return followers.select("uid").distinct()


def authors_without_followers(tweets: DataFrame, followers: DataFrame) -> DataFrame:
    """J4 complement (audit): tweets nobody receives (anti join)."""
    return tweets.join(_authors(followers), "uid", "left_anti")


def fanout(tweets: DataFrame, followers: DataFrame, cfg: FeedConfig = FeedConfig(),
           carry: tuple[str, ...] = (), counts: DataFrame | None = None,
           tweets_bytes: int | None = None, tasks: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """J5. One row per (follower, tweet): ``uid`` is the receiving user.

    ``carry`` adds tweet columns.  Authors without a follower row produce nothing
    (inner join).

    ``tweets_bytes`` is the measured size of the tweet side (a cached
    micro-batch).  When it is within ``cfg.broadcast_bytes`` the tweets are
    broadcast and the edge table is only scanned - never shuffled - so a hot
    author's edges stay spread over the partitions they are read from.
    Otherwise both sides shuffle on (uid, salts); authors whose tweets times
    receivers exceed ``cfg.skew_split_rows`` are split on both sides, and there are at
    least ``tasks`` tasks (see fanout_tasks).  ``keys``: the same tweets, narrow, to be counted by author."""
    t = tweets.select("uid", "time", "tid", *carry)
    if fits(tweets_bytes, cfg):
        joined = followers.select("uid", "follower").join(F.broadcast(t), "uid", "inner")
    else:
        joined = salted_join(t, followers.select("uid", "follower"), key="uid",
                             spread_col="follower", small_spread="tid", split_rows=cfg.skew_split_rows,
                             big_counts=counts, spread=True, tasks=tasks, small_keys=keys)
    return joined.select(F.col("follower").alias("uid"), "time", "tid", *carry)


def fanout_tasks(tweets: DataFrame, counts: DataFrame, cfg: FeedConfig) -> int:
    """Tasks of a fan-out of about ``cfg.skew_split_rows`` rows each, so that none has to sort or
    hold more, whatever the number of shuffle partitions.  One number, from the tweets and the
    receivers (uid, _n) of each author."""
    made = tweets.groupBy("uid").agg(F.count(F.lit(1)).alias("_t")).join(counts, "uid")
    return -(-(made.agg(F.sum(F.col("_n") * F.col("_t"))).first()[0] or 0) // cfg.skew_split_rows)


#: part of a receiver's rows, by time; rows of a (uid, time) have one part
PART = "part"
#: bytes of a packed tweet (time, tid) and of an author's row around them
PACKED_TWEET, PACKED_AUTHOR = 16, 96
#: a placed fan-out broadcasts at most so many slices of its tweets, ``cfg.broadcast_bytes`` each
MOST_SLICES = 8


def packed_tweets(tweets: DataFrame, counts: DataFrame) -> DataFrame:
    """(uid, times, tids): one row an author with receivers, 16 bytes a tweet."""
    rows = tweets.groupBy("uid").agg(F.collect_list(F.struct("time", "tid")).alias("_r"))
    return rows.join(counts.select("uid"), "uid", "left_semi").select(
        "uid", F.col("_r.time").alias("_times"), F.col("_r.tid").alias("_tids"))


def fanout_placed(tweets: DataFrame, followers: DataFrame, cfg: FeedConfig, counts: DataFrame,
                  tasks: int | None = None) -> DataFrame:
    """J5 with all rows of a receiver in one task: (uid, part, time, tid), placed by (uid, part).

    What is shuffled is the edges, by receiver; the tweets come to them, packed by author and
    broadcast.  So keys are resolved where the rows are made, and no row of a receiver is ever
    shuffled.  A receiver of more than ``cfg.skew_split_rows`` rows is split by time: ``part``
    is one for all rows of a (uid, time), and to be a key beside these.

    The packed tweets are measured first.  Beyond ``cfg.broadcast_bytes`` they are cut into slices
    of authors, each of which meets the edges of its own; beyond ``MOST_SLICES`` of them the rows
    are made by author and shuffled to their places."""
    spark = tweets.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks or 1)
    per_author = tweets.groupBy("uid").agg(F.count(F.lit(1)).alias("_t")).join(counts.select("uid"), "uid")
    authors, packed = per_author.agg(F.count(F.lit(1)), F.coalesce(F.sum("_t"), F.lit(0))).first()     # one row
    slices = max(1, -(-(packed * PACKED_TWEET + authors * PACKED_AUTHOR) // cfg.broadcast_bytes))
    if slices > MOST_SLICES:
        rows = fanout(tweets, followers, cfg, (), counts, tasks=tasks)
        return rows.repartition(n, "uid", "time").select("uid", F.lit(0).alias(PART), "time", "tid")
    # bounded like the hot keys of a salted join: each makes more than split_rows rows
    hot = (followers.join(per_author, "uid").groupBy("follower").agg(F.sum("_t").alias("_n"))
           .filter(F.col("_n") > F.lit(cfg.skew_split_rows))
           .select("follower", F.ceil(F.col("_n") / F.lit(cfg.skew_split_rows)).cast("int").alias("_of")))
    edges = (followers.select("uid", "follower").join(F.broadcast(hot), "follower", "left")
             .withColumn(PART, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_of"), F.lit(1)) - 1))))
    by_author, out = packed_tweets(tweets, counts), None
    for k in range(slices):
        mine = F.lit(True) if slices == 1 else F.pmod(F.xxhash64("uid"), F.lit(slices)) == F.lit(k)
        met = edges.filter(mine).repartition(n, "follower", PART).join(F.broadcast(by_author.filter(mine)), "uid")
        rows = met.select(F.col("follower").alias("uid"), PART, "_of", "_tids", F.posexplode("_times").alias("_at", "time"))
        rows = (rows.filter(F.col("_of").isNull() | (F.pmod(F.xxhash64("time"), F.col("_of")) == F.col(PART)))
                .select("uid", PART, "time", F.col("_tids")[F.col("_at")].alias("tid")))
        out = rows if out is None else out.unionByName(rows)
    return out


def fits(tweets_bytes: int | None, cfg: FeedConfig) -> bool:
    """Is the tweet side measured, and small enough to be broadcast?"""
    return tweets_bytes is not None and tweets_bytes <= cfg.broadcast_bytes


#: a version of a tweet's payload
VERSION = ["tid", "tweet_hash"]


def payloads(tweets: DataFrame, *columns: str) -> DataFrame:
    """(tid, tweet_hash, columns): one row a version, however often it was delivered."""
    return tweets.select(*VERSION, *(columns or ("tweet",))).dropDuplicates(VERSION)


def receivers(tweets: DataFrame, counts: DataFrame) -> DataFrame:
    """(tid, tweet_hash, _n): rows that the fan-out makes of each version, from the receivers of
    its author: no pass over the fan-out."""
    return tweets.select("uid", *VERSION).join(counts, "uid").groupBy(*VERSION).agg(F.sum("_n").alias("_n"))


def attach_payloads(rows: DataFrame, versions: DataFrame, cfg: FeedConfig = FeedConfig(),
                    counts: DataFrame | None = None, order: list | None = None, tasks: int | None = None) -> DataFrame:
    """J6. Narrow fan-out rows (uid, ..., tid, tweet_hash) with their payload.

    A payload moves once a version, never once a receiver: what is shuffled per receiver
    is the narrow row.  A tweet with more than ``cfg.skew_split_rows`` receivers is split
    over tasks.  ``counts`` (tid, tweet_hash, _n): rows of ``rows`` a version.
    ``order``: rows come in this order within their tasks."""
    return salted_join(versions, rows, key=VERSION, spread_col="uid", small_spread="tid",
                       split_rows=cfg.skew_split_rows, big_counts=counts, spread=order is not None, order=order,
                       tasks=tasks)


def fanout_denorm(tweets: DataFrame, followers: DataFrame, cfg: FeedConfig = FeedConfig(),
                  carry: tuple[str, ...] = (), payload: tuple[str, ...] = ("tweet",),
                  counts: DataFrame | None = None, tweets_bytes: int | None = None,
                  narrow: DataFrame | None = None, tasks: int | None = None, stored: bool = True) -> DataFrame:
    """J6. Fan-out carrying the payload columns.  ``narrow``: the tweets without them, if written.

    The fan-out is narrow and sorted as it is stored (by receiver, newest first) before the
    payloads are attached: a measured, small batch's by broadcast, otherwise in the tasks of
    their versions.  So no payload is sorted or moved once a receiver.

    Rows that are not to be ``stored`` need no order: payloads go to the author's task with
    their tweet, once, and no receiver's row is moved to meet one."""
    carry = tuple(c for c in carry if c != "tweet_hash")
    columns = ["uid", "time", "tid", *carry, "tweet_hash", *payload]
    if not stored:
        rows = fanout(tweets, followers, cfg, (*carry, "tweet_hash", *payload), counts, tweets_bytes, tasks, narrow)
        return rows.select(*columns)
    versions, order = payloads(tweets, *payload), [F.col("uid"), F.desc("time")]
    few = tweets if narrow is None else narrow
    narrow = fanout(few, followers, cfg, (*carry, "tweet_hash"), counts, tweets_bytes, tasks)
    if fits(tweets_bytes, cfg):
        rows = in_order(narrow, order).join(F.broadcast(versions), VERSION, "inner").filter(PLACE_USED)
        return rows.select(*columns)
    if counts is None:
        counts = followers.groupBy("uid").agg(F.count(F.lit(1)).alias("_n"))
    return attach_payloads(narrow, versions, cfg, receivers(few, counts), order, tasks).select(*columns)
