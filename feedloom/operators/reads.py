"""Timeline reads for many users in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.config import PAGE_CAP, PAGE_STEP, FeedConfig
from feedloom.operators.bloom import may_hold
from feedloom.operators.skew import salted_join
from feedloom.operators.store import resolve, visible
from feedloom.sources.tables import cut


def page_size(n: Column) -> Column:
    """R7. Rows shown for a request of n: n + 5 below 50, else n (uncapped)."""
    return F.when(n < PAGE_CAP, n + PAGE_STEP).otherwise(n).cast("int")


def _order(df: DataFrame):
    # (uid, time) is unique after upsert; under keep_all tid breaks ties.
    return [F.desc("time"), F.desc("tid")] if "tid" in df.columns else [F.desc("time")]


def newest_n(df: DataFrame, n: int, key: str = "uid") -> DataFrame:
    """R1/R2/R5. Newest ``n`` rows per ``key`` with their rank ``rn``.

    ``row_number() <= literal`` plans as WindowGroupLimit, which also cuts
    each map partition to n rows per key BEFORE the shuffle - so a reader who
    receives everything (the listener) ships n rows per task, not all."""
    w = Window.partitionBy(key).orderBy(*_order(df))
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.lit(n))


def newest_stored(df: DataFrame, n: int, cfg: FeedConfig = FeedConfig(), as_of: str | None = None) -> DataFrame:
    """R1 over stored rows (every version): expiry, keys (T1), then the newest ``n`` per uid.

    The newest n resolved rows of a user lie in its newest n seconds, so live rows are cut to
    these first (each map partition before the shuffle, as in ``newest_n``).  Keys are then
    resolved and ranked where the rows of a user lie: one shuffle, and only pages are resolved."""
    live = df if as_of is None else visible(df, as_of)
    place = F.dense_rank().over(Window.partitionBy("uid").orderBy(F.desc("time")))
    few = live.withColumn("_place", place).filter(F.col("_place") <= F.lit(n)).drop("_place")
    return newest_n(resolve("inboxes", few, cfg, placed=True), n)


def user_page(df: DataFrame, uid: int, n: int) -> DataFrame:
    """R1 for one user (the per-request read).  The uid filter reaches the parquet scans,
    where sorted row groups and Bloom filters leave few of them to read; the limit plans
    as a top-n."""
    return df.filter(F.col("uid") == F.lit(uid)).orderBy(*_order(df)).limit(n)


def page_bounds(requests: DataFrame) -> tuple[DataFrame, int, int]:
    """(uid, page_size) per request, plus the largest page and the sum of all
    pages - the latter bounds the rows any timeline read can return."""
    pages = requests.select("uid", page_size(F.col("n")).alias("page_size"))
    mx, total = pages.agg(F.max("page_size"), F.sum("page_size")).first()   # one row
    return pages, int(mx or 0), int(total or 0)


def newest_for_requests(df: DataFrame, requests: DataFrame, bounds=None,
                        as_of: str | None = None, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """R7. Newest rows per requested user with a page size per user.

    Only requested users are ranked (semi join); the largest page is taken as
    the literal bound so the per-key partial limit still applies.  ``df`` may
    be stored rows (every version): they are cut to the requested users
    first - whole uid groups, so exact - and only their newest are resolved
    (see newest_stored)."""
    pages, mx, _ = bounds or page_bounds(requests)
    mine = df.join(pages.select("uid"), "uid", "left_semi")
    if "ingest_ts" in mine.columns:
        ranked = newest_stored(mine, mx, cfg, as_of).select("uid", "time", "tid", "rn")
    else:
        ranked = newest_n(mine.select("uid", "time", "tid"), mx)
    return ranked.join(pages, "uid", "inner").filter(F.col("rn") <= F.col("page_size"))


def _cut_to(tweets: DataFrame, ids: DataFrame, max_ids: int | None, cfg: FeedConfig) -> DataFrame:
    """Tweet rows whose tid is among ``ids``.

    ``max_ids``: a proven bound on the id rows.  Within ``cfg.broadcast_bytes`` the ids are
    broadcast and the tweets only scanned.  Beyond it the ids make a Bloom filter of
    bounded size, which thins the tweets out before both sides shuffle; the join
    removes what the filter lets through by chance."""
    keys = ids.select("tid")
    if max_ids is not None and max_ids * 16 <= cfg.broadcast_bytes:
        return tweets.join(F.broadcast(keys), "tid", "left_semi")
    # one row an id (partial aggregation first), written once: the filter and the join read it
    keys = cut(ids.sparkSession, keys.distinct(), "id-set")
    return tweets.filter(may_hold(F.col("tid"), keys, "tid", cfg.bloom_bits)).join(keys, "tid", "left_semi")


def with_facts(tweets: DataFrame, facts: dict[str, Column] | None) -> DataFrame:
    """Stored tweets with ``facts`` (name -> Column over the stored row) in place of the payload."""
    if facts is None:
        return tweets
    return tweets.withColumn("tweet", F.struct(*[c.alias(n) for n, c in facts.items()]))


def resolve_tweets(ids: DataFrame, tweets: DataFrame, max_ids: int | None = None,
                   cfg: FeedConfig = FeedConfig(), as_of: str | None = None,
                   facts: dict[str, Column] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """J8. Attach the stored payload by tid; missing tweets vanish (inner).

    ``tweets`` are stored tweet rows (all written versions).  They are first
    cut to the ids asked for - a semi join on the upsert key drops whole tid
    groups, so resolving afterwards (T2, then T4 at ``as_of``) gives exactly
    the resolved table's rows - and only those few tweets are resolved and
    joined.  ``max_ids`` is a proven upper bound on the id rows (the sum of
    page sizes).  Without one the ids may be of any number: they are written once,
    and a tid that more than ``cfg.skew_split_rows`` of them name is split.

    ``facts``: what to attach instead of the payload, taken once a stored tweet.
    ``counts`` (tid, _n): at most so many ids name a tid.  Then the ids are read once, and the
    tweets (their facts are small) are not cut to them before the join."""
    tweets, shown = with_facts(tweets, facts), ["tweet"] if facts is None else ["tweet.*"]
    if counts is not None:
        needed = resolve("tweets", tweets, as_of=as_of).select("tid", *shown)
        return salted_join(needed, ids, "tid", "uid", "tid", cfg.skew_split_rows, counts)
    if max_ids is None:
        ids = cut(ids.sparkSession, ids, "resolve-ids")
    needed = tweets_in_set(tweets, ids, max_ids, cfg, as_of).select("tid", *shown)
    if max_ids is None:
        return salted_join(needed, ids, "tid", "uid", "tid", cfg.skew_split_rows)
    return ids.join(needed, "tid", "inner")


def tweets_in_set(tweets: DataFrame, ids: DataFrame, max_ids: int | None = None,
                  cfg: FeedConfig = FeedConfig(), as_of: str | None = None) -> DataFrame:
    """J9. Stored tweets whose tid is in the id set (semi join, empty set ok);
    stored rows are resolved after the cut, as in ``resolve_tweets``."""
    found = _cut_to(tweets, ids, max_ids, cfg)
    if "ingest_ts" in found.columns:
        found = resolve("tweets", found, as_of=as_of)
    return found


def with_username(df: DataFrame, usernames: DataFrame, default: str) -> DataFrame:
    """J10. uname from the usernames table, ``default`` when absent."""
    u = usernames.select("uid", F.col("uname").alias("_uname"))
    return df.join(u, "uid", "left").withColumn(
        "uname", F.coalesce(F.col("_uname"), F.lit(default))).drop("_uname")


def timeline_state(requests: DataFrame, timeline: DataFrame) -> DataFrame:
    """R8. Per requested user: rows shown and whether the timeline is empty."""
    counts = timeline.groupBy("uid").agg(F.count(F.lit(1)).alias("n_rows"))
    return (requests.select("uid").join(counts, "uid", "left")
            .select("uid", F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
                    F.col("n_rows").isNotNull().alias("has_tweets")))


def followers_of(edges: DataFrame, uids: DataFrame) -> DataFrame:
    """R9. Adjacency rows for a set of users (semi join, no collect)."""
    return edges.join(uids.select("uid"), "uid", "left_semi")
