"""Follower-graph preparation (G1-G6) from an edge frame (uid, follower).

Set-valued views (followerslists / followinglists) are chunked: a user's ids are dealt
by a hash of the id into ``DEFAULT_CHUNKS`` chunks, or, for a user with more than
``CHUNK_IDS`` ids a chunk, into as many as keep to that size.  So no group - not even a
user who is followed by a third of everyone - is collected into a large array; the
row says in how many chunks its user's set lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNKS = 16
CHUNK_IDS = 65_536


def follower_edges(edges: DataFrame) -> DataFrame:
    """G1/T5 input: set semantics, self excluded."""
    return edges.select("uid", "follower").filter(F.col("uid") != F.col("follower")).distinct()


def chunk_of(member, chunks: int):
    """Chunk of an id: the first hex digits of the MD5 of its text, mod ``chunks``."""
    chunks = chunks if isinstance(chunks, Column) else F.lit(chunks)
    return F.pmod(F.conv(F.substring(F.md5(member.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint"),
                  chunks.cast("bigint"))


def _chunked_sets(pairs: DataFrame, key: str, member: str, chunks: int, chunk_ids: int) -> DataFrame:
    # users with large sets: at most (pairs) / (chunks * chunk_ids) of them, so they are broadcast
    large = (pairs.groupBy(key).count().filter(F.col("count") > chunks * chunk_ids)
             .select(key, F.ceil(F.col("count") / chunk_ids).cast("int").alias("chunks")))
    dealt = pairs.join(F.broadcast(large), key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(chunks)))
    return dealt.groupBy(key, chunk_of(F.col(member), F.col("chunks")).alias("chunk"), "chunks").agg(
        F.array_sort(F.collect_list(member)).alias("ids"))


def followers_lists(edges: DataFrame, chunks: int = DEFAULT_CHUNKS, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """G1/W6. (uid, chunk, chunks, followerslist) - distinct followers, self excluded."""
    return _chunked_sets(follower_edges(edges), "uid", "follower", chunks, chunk_ids) \
        .withColumnRenamed("ids", "followerslist")


def following_lists(edges: DataFrame, users: DataFrame, chunks: int = DEFAULT_CHUNKS, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """G2/W7. Inverted sets: (uid, chunk, chunks, followinglist); every user appears,
    users following nobody with one empty chunk 0 (a full inversion, not the
    reference's partial flush)."""
    inv = follower_edges(edges).select(F.col("follower").alias("uid"), F.col("uid").alias("followee"))
    sets = _chunked_sets(inv, "uid", "followee", chunks, chunk_ids).withColumnRenamed("ids", "followinglist")
    none = users.select("uid").join(sets.select("uid"), "uid", "left_anti").select(
        "uid", F.lit(0).cast("bigint").alias("chunk"), F.lit(chunks).alias("chunks"),
        F.array().cast("array<bigint>").alias("followinglist"))
    return sets.unionByName(none)


def follower_counts(edges: DataFrame) -> DataFrame:
    """G3. Followers per user with a follower set."""
    return follower_edges(edges).groupBy("uid").agg(F.count(F.lit(1)).alias("n_followers"))


def following_counts(edges: DataFrame, users: DataFrame) -> DataFrame:
    """G4. Followees per user; 0 for users following nobody."""
    c = follower_edges(edges).groupBy(F.col("follower").alias("uid")).agg(
        F.count(F.lit(1)).alias("n_following"))
    return users.select("uid").join(c, "uid", "left").select(
        "uid", F.coalesce(F.col("n_following"), F.lit(0)).cast("bigint").alias("n_following"))


def graph_totals(edges: DataFrame) -> DataFrame:
    """G6. Total edges, users with followers, largest set (one row)."""
    c = follower_counts(edges)
    return c.agg(F.sum("n_followers").cast("bigint").alias("n_edges"),
                 F.count(F.lit(1)).alias("n_users_with_followers"),
                 F.max("n_followers").alias("max_followers"))


# Fixed values of the audience tiers: (tier, upper cut-off in % of n, mean,
# variance).  Mean/variance given as (numerator, denominator) of n use integer
# division of n; plain integers are absolute.  Cut-offs compare as doubles.
TIERS = (
    ("t1", 0.05, (10, 100), (4, 100)),
    ("t2", 0.15, (5, 100), (2, 100)),
    ("t3", 0.3, (2, 100), (1, 100)),
    ("t4", 0.5, (1, 100), (1, 200)),
    ("t5", 10.5, 200, 100),
    ("t6", 50.5, 60, 20),
    ("t7", 90.5, 30, 10),
    ("t8", None, 5, 0),
)


def _amount(v, n: int) -> int:
    return (n * v[0]) // v[1] if isinstance(v, tuple) else v


def tier_table(n: int) -> list[tuple[str, float | None, int, int]]:
    """Per tier: upper position bound (exclusive, as a double), lo, hi followers.
    A drawn size is mean + (r mod variance), so it lies in
    [mean - variance + 1, mean + variance - 1] (exactly mean when variance is 0)."""
    out = []
    for name, cut, mean, var in TIERS:
        m, v = _amount(mean, n), _amount(var, n)
        lo, hi = (m - v + 1, m + v - 1) if v else (m, m)
        out.append((name, None if cut is None else n * cut / 100, lo, hi))
    return out


def audience_tiers(users: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """G5 re-aimed: each user's degree tier by uid position, its expected
    follower bounds, and the observed follower count."""
    tiers = tier_table(n)
    pos = F.col("uid").cast("double")
    tier = lo = hi = None
    for name, cut, t_lo, t_hi in tiers:
        cond = F.lit(True) if cut is None else pos < F.lit(cut)
        tier = (F.when(cond, F.lit(name)) if tier is None else tier.when(cond, F.lit(name)))
        lo = (F.when(cond, F.lit(t_lo)) if lo is None else lo.when(cond, F.lit(t_lo)))
        hi = (F.when(cond, F.lit(t_hi)) if hi is None else hi.when(cond, F.lit(t_hi)))
    u = users.select("uid", tier.alias("tier"), lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"))
    return u.join(counts, "uid", "left").select(
        "uid", "tier", "lo", "hi",
        F.coalesce(F.col("n_followers"), F.lit(0)).cast("bigint").alias("n_followers"))


def tier_summary(per_user: DataFrame) -> DataFrame:
    """G5 per-tier audit: users, bounds, observed min/avg/max, users in bounds."""
    inb = ((F.col("n_followers") >= F.col("lo")) & (F.col("n_followers") <= F.col("hi"))).cast("bigint")
    return per_user.groupBy("tier", "lo", "hi").agg(
        F.count(F.lit(1)).alias("n_users"),
        F.min("n_followers").alias("min_followers"),
        F.round(F.avg("n_followers"), 6).alias("avg_followers"),
        F.max("n_followers").alias("max_followers"),
        F.sum(inb).cast("bigint").alias("n_in_bounds"))
