"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the given test tables (through ``sources.fixtures``) and
runs over them whole.  Column names match the oracle SQL in
``plans.oracle``.  Queries that exercise a sink write into a fresh folder
under the cluster's shared folder and return what a reader sees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.config import FEED_READ_SIZE, FeedConfig
from feedloom.functions import parse as P
from feedloom.functions import payload as PL
from feedloom.functions.render import join_hashtags, local_time, render
from feedloom.operators import fanout as J
from feedloom.operators import graph as G
from feedloom.operators import reads as R
from feedloom.operators import store as T
from feedloom.plans import batch
from feedloom.plans import timelines as tl
from feedloom.session import scratch_path
from feedloom.sources import fixtures, ingest
from feedloom.sources.store import TimelineStore, compact, read_compacted
from feedloom.sources.tables import cut, shuffles_dropped
from feedloom.streaming import fanout_stream as ST
from feedloom.streaming import newest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CFG = FeedConfig()
HALF_MONTH = "2024-01-16 00:00:00"   # feed split into two deliveries at this time


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _tables(spark, sf_dir, cfg=CFG, as_of="default"):
    return batch.resolved_tables(spark, sf_dir, cfg, as_of)


def _stored_rows(spark, sf_dir, cfg=CFG):
    """Unresolved sink rows (every written version), as a store holds them."""
    return batch.batch_tables(spark, sf_dir, cfg)


def _stored_and_resolved(spark, sf_dir, cfg=CFG):
    rows = _stored_rows(spark, sf_dir, cfg)
    return rows, batch.resolved_view(rows, cfg)


def _tweets(spark, sf_dir, cfg=CFG):
    return P.ingest(fixtures.raw_tweets(spark, sf_dir), cfg)


def _parsed(spark, sf_dir, cfg=CFG):
    return P.valid_tweets(P.parse_raw(fixtures.raw_tweets(spark, sf_dir), cfg))


def _delivery(spark, sf_dir, cfg=CFG):
    return J.delivery_edges(fixtures.edges(spark, sf_dir, distinct=(cfg.store == "set")), cfg)


def _text(col="tweet"):
    return PL.text(F.col(col)).alias("text")


def _text_md5(col="tweet"):
    return PL.text_md5(F.col(col)).alias("text_md5")


def _digest():
    """What a query shows of a payload that comes once per receiving user."""
    return {"text_md5": PL.text_md5(F.col("tweet"))}


def _halves(df, col="time"):
    early = F.col(col) < F.lit(HALF_MONTH).cast("timestamp_ntz")
    return df.filter(early), df.filter(~early)


# ---------------------------------------------------------------------------
# 2.1 Sources, ingest, parse
# ---------------------------------------------------------------------------
@query("parse_tweets")
def q_parse_tweets(spark, sf_dir):
    """Every valid record, typed."""
    t = _parsed(spark, sf_dir)
    return t.select("tid", "uid_raw", "created_at", "lang", "text", "author_name",
                    "author_screen_name", join_hashtags(F.col("hashtags")).alias("hashtags"))


@query("parse_created_at")
def q_parse_created_at(spark, sf_dir):
    """Delivered time string -> UTC timestamp -> stored time string."""
    t = _parsed(spark, sf_dir)
    return t.select("tid", "time", P.format_store_time(F.col("time")).alias("stored_time"))


@query("fold_users")
def q_fold_users(spark, sf_dir):
    """P5: user.id_str mod n."""
    return _parsed(spark, sf_dir).select("tid", "uid_raw", "uid")


@query("filter_language")
def q_filter_language(spark, sf_dir):
    """English tweets only."""
    return _tweets(spark, sf_dir).select("tid", "uid", "time", "lang")


@query("dead_letter")
def q_dead_letter(spark, sf_dir):
    """The feed, a damaged copy of every record and one with odd optional fields
    (valid); the damaged ones are dead-lettered."""
    parsed = P.parse_raw(fixtures.dirty_raw_tweets(spark, sf_dir), CFG)
    return P.dead_letters(parsed).select(
        "reason", F.regexp_extract("value", '"id_str":"([^"]*)"', 1).alias("ref"))


@query("raw_roundtrip")
def q_raw_roundtrip(spark, sf_dir):
    """Publish the raw records to the file sink, read them back and parse
    again: nothing may change, also no field that this system does not read."""
    out = scratch_path(spark, "raw-roundtrip")
    ingest.publish_text(fixtures.raw_tweets(spark, sf_dir), out)
    t = P.valid_tweets(P.parse_raw(ingest.read_text(spark, out), CFG))
    return t.select("tid", "uid", "time", "text", "author_name", "author_screen_name",
                    join_hashtags(F.col("hashtags")).alias("hashtags"),
                    F.get_json_object("tweet", "$.retweet_count").cast("bigint").alias("retweet_count"))


def _publish_feed(spark, sf_dir, root, part="all", name=None):
    """Publish the raw feed (all, or the early / late half by event time) as
    text files in its own delivery folder under ``root/feed``."""
    raw = fixtures.raw_tweets(spark, sf_dir, keep_ts=True)
    if part != "all":
        raw = _halves(raw, "ts")[0 if part == "early" else 1]
    ingest.publish_text(raw, f"{root}/feed/{name or part}")


def _publish_both_deliveries(spark, sf_dir, root):
    """Both halves of the feed in one job: folders delivery=early|late."""
    raw = fixtures.raw_tweets(spark, sf_dir, keep_ts=True)
    half = F.when(F.col("ts") < F.lit(HALF_MONTH).cast("timestamp_ntz"), "early").otherwise("late")
    ingest.text_writer(raw.select("value", half.alias("delivery"))).partitionBy("delivery").text(f"{root}/feed")


def _feed_source(spark, root, max_files=None):
    # glob over delivery folders: folders published later are picked up later
    return ingest.read_text_stream(spark, f"{root}/feed/*", max_files_per_trigger=max_files)


@query("stream_ingest_parse")
def q_stream_ingest_parse(spark, sf_dir):
    """S1-S3 + P1-P5 + S5 as a stream over the file source, drained to parquet."""
    root = scratch_path(spark, "ingest-stream")
    _publish_feed(spark, sf_dir, root)
    return ST.parsed_stream_to_parquet(spark, _feed_source(spark, root), f"{root}/out", f"{root}/ckpt", CFG)


# ---------------------------------------------------------------------------
# 2.2 Joins and fan-out
# ---------------------------------------------------------------------------
@query("join_followers_left")
def q_join_followers_left(spark, sf_dir):
    """Each tweet with its author's follower-set size (null: no row)."""
    t = _tweets(spark, sf_dir).select("tid", "uid")
    return J.join_followers_left(t, _delivery(spark, sf_dir)).select(
        "tid", "uid", "n_followers", "sum_followers")


@query("fanout_listener")
def q_fanout_listener(spark, sf_dir):
    """Delivery sets with the listener added to every existing set."""
    return _delivery(spark, sf_dir)


@query("authors_without_followers")
def q_authors_without_followers(spark, sf_dir):
    """Tweets whose author has no follower row (nobody receives them)."""
    e = fixtures.edges(spark, sf_dir)
    return J.authors_without_followers(_tweets(spark, sf_dir), e).select("tid", "uid")


@query("fanout_norm")
def q_fanout_norm(spark, sf_dir):
    """One inbox row per (follower, tweet), before upsert."""
    return batch.batch_tables(spark, sf_dir, CFG)["inboxes"].select("uid", "time", "tid")


@query("fanout_denorm")
def q_fanout_denorm(spark, sf_dir):
    """Fan-out carrying the payload; per tweet, the payloads delivered and to whom."""
    return _receiver_rows(spark, sf_dir).groupBy("tid", "payload_id", "text_md5").agg(
        F.count(F.lit(1)).alias("n_receivers"), F.sum("uid").alias("sum_uid"))


def _receiver_rows(spark, sf_dir):
    """The denormalized fan-out, payload and all, with what the queries show of the payload that each
    row received."""
    return batch.denorm_rows(spark, sf_dir, CFG, {"payload_id": PL.payload_id(F.col("tweet")), **_digest()})


@query("fanout_denorm_receivers")
def q_fanout_denorm_receivers(spark, sf_dir):
    """One payload row per (follower, tweet): who receives which payload, and when."""
    return _receiver_rows(spark, sf_dir).select("uid", "time", "tid", "payload_id", "text_md5")


@query("fanout_list_store")
def q_fanout_list_store(spark, sf_dir):
    """The edges loaded into the list store (both directions, as
    text, duplicates kept), read back by direction and fanned out without a
    listener."""
    path = scratch_path(spark, "list-store")
    J.publish_list_store(fixtures.edges(spark, sf_dir, distinct=False), path)
    cfg = CFG.with_(store="list")
    rows = batch.timeline_rows(_tweets(spark, sf_dir, cfg), J.read_list_store(spark, path), cfg, once=True)
    return rows["inboxes"].select("uid", "time", "tid")


@query("list_store_following")
def q_list_store_following(spark, sf_dir):
    """The other direction of the list store, read back: whom each requested
    user follows, as often as it was pushed."""
    path = scratch_path(spark, "list-store")
    J.publish_list_store(fixtures.edges(spark, sf_dir, distinct=False), path)
    e = J.list_store_edges(J.read_list_store(spark, path, "following"))
    mine = R.followers_of(e, fixtures.requests(spark, sf_dir))
    return mine.groupBy("uid", F.col("follower").alias("followee")).agg(F.count(F.lit(1)).alias("n_pushed"))


@query("fanout_variants")
def q_fanout_variants(spark, sf_dir):
    """ST5: the four (layout, store) variants - receiving-side rows before and
    after key resolution.  One variant runs after the other, and leaves the disks before the next."""
    out = None
    # denormalized rows count by their payload, so that it travels with them
    for layout, sink, what in (("norm", "inboxes", "tid"), ("denorm", "feedslists", "tweet")):
        for store in ("set", "list"):
            with shuffles_dropped(spark):
                tables = batch.batch_tables(spark, sf_dir, CFG.with_(layout=layout, store=store))
                rows, at = (tables.placed(), ["uid", J.PART, "time"]) if layout == "norm" else (tables[sink], ["uid", "time"])
                keys = rows.groupBy(*at).agg(F.count(what).alias("n"))
                counts = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_resolved"))
                one = cut(spark, counts.select(F.lit(layout).alias("layout"), F.lit(store).alias("store"),
                                               "n_rows", "n_resolved"), "variant")
            out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------------------
# 2.3 Sinks (written to the store, read back resolved and unexpired)
# ---------------------------------------------------------------------------
def _half_tweets(spark, sf_dir, cfg, part):
    """Tweets of the early or late half, cut on the raw event time before the parse."""
    raw = _halves(fixtures.raw_tweets(spark, sf_dir, keep_ts=True), "ts")[part]
    return P.ingest(raw.select("value"), cfg)


def _stored(spark, sf_dir, cfg, tables):
    """Write the feed as two deliveries into a fresh store; return the store."""
    store = TimelineStore(spark)
    edges = fixtures.edges(spark, sf_dir, distinct=(cfg.store == "set"))
    for bid in (0, 1):
        rows = batch.timeline_rows(_half_tweets(spark, sf_dir, cfg, bid), edges, cfg, once=True)
        for t in tables:
            store.write_batch(t, rows[t], bid)
    return store


@query("sink_tweets")
def q_sink_tweets(spark, sf_dir):
    """W1 + T2 + T4."""
    s = _stored(spark, sf_dir, CFG, ("tweets",))
    return s.read("tweets", CFG, CFG.as_of).select("tid", _text(), "expire_at")


@query("sink_homepages")
def q_sink_homepages(spark, sf_dir):
    """W2 + T1 + T4."""
    s = _stored(spark, sf_dir, CFG, ("homepages",))
    return s.read("homepages", CFG, CFG.as_of).select("uid", "time", "tid", "expire_at")


@query("sink_inboxes")
def q_sink_inboxes(spark, sf_dir):
    """W3 + T1 + T4."""
    s = _stored(spark, sf_dir, CFG, ("inboxes",))
    return s.read("inboxes", CFG, CFG.as_of).select("uid", "time", "tid", "expire_at")


@query("sink_historytweets")
def q_sink_historytweets(spark, sf_dir):
    """W4 + T1 + T4 (denormalized own tweets)."""
    cfg = CFG.with_(layout="denorm")
    s = _stored(spark, sf_dir, cfg, ("historytweets",))
    return s.read("historytweets", cfg, cfg.as_of).select("uid", "time", "tid", _text(), "expire_at")


@query("sink_feedslists")
def q_sink_feedslists(spark, sf_dir):
    """W5 + T1 + T4 (denormalized inbox)."""
    cfg = CFG.with_(layout="denorm")
    s = _stored(spark, sf_dir, cfg, ("feedslists",))
    return s.read("feedslists", cfg, cfg.as_of, facts=_digest()).select("uid", "time", "tid", "text_md5", "expire_at")


def _csv(col):
    return F.array_join(F.col(col).cast("array<string>"), ",")


@query("followers_lists")
def q_followers_lists(spark, sf_dir):
    """G1 + W6: follower sets (self excluded), written and read back."""
    out = scratch_path(spark, "followerslists")
    G.followers_lists(fixtures.edges(spark, sf_dir)).write.parquet(out)
    f = spark.read.parquet(out)
    return f.select("uid", "chunk", F.size("followerslist").cast("bigint").alias("n_followers"),
                    _csv("followerslist").alias("followerslist"))


@query("following_lists")
def q_following_lists(spark, sf_dir):
    """G2 + W7: inverted sets for every user (empty when following nobody)."""
    out = scratch_path(spark, "followinglists")
    G.following_lists(fixtures.edges(spark, sf_dir), fixtures.users(spark, sf_dir)).write.parquet(out)
    f = spark.read.parquet(out)
    return f.select("uid", "chunk", F.size("followinglist").cast("bigint").alias("n_following"),
                    _csv("followinglist").alias("followinglist"))


# ---------------------------------------------------------------------------
# 2.4 Table semantics
# ---------------------------------------------------------------------------
@query("upsert_uid_time")
def q_upsert_uid_time(spark, sf_dir):
    """T1 on a coarse copy (time truncated to the hour): collisions are common."""
    hour = F.date_trunc("hour", "time").cast("timestamp_ntz")
    coarse = batch.batch_tables(spark, sf_dir, CFG).placed(time=hour)
    return T.upsert_placed(coarse, J.PART).select("uid", "time", "tid")


@query("upsert_tid")
def q_upsert_tid(spark, sf_dir):
    """The tweets delivered twice (an hour later with an added field); the
    later write wins, one row per tid."""
    # parted by key once: both deliveries are read from there, and the upsert moves nothing more
    t = _tweets(spark, sf_dir).select("tid", "uid", "tweet", "time").repartition("tid")
    edited = F.regexp_replace("tweet", "}$", ',"edited":1}')
    again = t.withColumn("time", F.col("time") + F.expr("INTERVAL 1 HOUR")).withColumn("tweet", edited)
    res = T.upsert_tid(batch.stamped(t, CFG).unionByName(batch.stamped(again, CFG)).drop("uid", "time"))
    return res.select("tid", _text(), PL.field(F.col("tweet"), "edited", "int").alias("edited"), "ingest_ts")


@query("ttl_visible")
def q_ttl_visible(spark, sf_dir):
    """T4: per user, inbox rows stored vs visible at as_of."""
    rows = _tables(spark, sf_dir, CFG, as_of=None)["inboxes"]
    vis = (F.col("expire_at") > F.lit(CFG.as_of).cast("timestamp_ntz")).cast("bigint")
    return rows.groupBy("uid").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(vis).cast("bigint").alias("n_visible"))


@query("compact_store")
def q_compact_store(spark, sf_dir):
    """Two deliveries compacted at as_of, the second delivery replayed as a later
    batch, and that compacted with the table before: each key once, unexpired."""
    s = _stored(spark, sf_dir, CFG, ("inboxes",))
    compact(s.raw("inboxes"), "inboxes", f"{s.root}/compact-0", CFG, CFG.as_of)
    late = _half_tweets(spark, sf_dir, CFG, 1)
    s.write_batch("inboxes", batch.timeline_rows(late, fixtures.edges(spark, sf_dir), CFG, once=True)["inboxes"], 2)
    both = read_compacted(spark, "inboxes", f"{s.root}/compact-0").unionByName(s.raw("inboxes", after=1).drop("batch_id"))
    compact(both, "inboxes", f"{s.root}/compact-1", CFG, CFG.as_of)
    return read_compacted(spark, "inboxes", f"{s.root}/compact-1").select("uid", "time", "tid", "expire_at")


@query("user_page")
def q_user_page(spark, sf_dir):
    """R1 + T3: one request - the listener's newest 20 - read from the compacted table
    by the uid filter of its sorted row groups."""
    s = _stored(spark, sf_dir, CFG, ("inboxes",))
    compact(s.raw("inboxes"), "inboxes", f"{s.root}/compact", CFG, CFG.as_of)
    rows = T.visible(read_compacted(spark, "inboxes", f"{s.root}/compact"), CFG.as_of)
    return R.user_page(rows, CFG.listener, FEED_READ_SIZE).select("uid", "time", "tid")


# ---------------------------------------------------------------------------
# 2.5 Timeline reads
# ---------------------------------------------------------------------------
@query("home_timeline")
def q_home_timeline(spark, sf_dir):
    """R3 (flagship): every user's newest page of the inbox, rendered."""
    rows = _stored_rows(spark, sf_dir)
    return tl.home_timeline(rows["inboxes"], rows["tweets"],
                            fixtures.usernames(spark, sf_dir), fixtures.requests(spark, sf_dir), CFG)


@query("profile_timeline")
def q_profile_timeline(spark, sf_dir):
    """Every user's newest page of own tweets, author shown by username."""
    rows = _stored_rows(spark, sf_dir)
    return tl.profile_timeline(rows["homepages"], rows["tweets"],
                               fixtures.usernames(spark, sf_dir), fixtures.requests(spark, sf_dir), CFG)


@query("paged_timeline")
def q_paged_timeline(spark, sf_dir):
    """Home timelines with a different page request per user."""
    rows = _stored_rows(spark, sf_dir)
    home = tl.home_timeline(rows["inboxes"], rows["tweets"],
                            fixtures.usernames(spark, sf_dir), fixtures.paged_requests(spark, sf_dir), CFG)
    return home.withColumn("text", F.md5(F.col("text").cast("binary"))).withColumnRenamed("text", "text_md5")


@query("timeline_state")
def q_timeline_state(spark, sf_dir):
    """Per requested user, rows shown and whether the timeline is empty."""
    home = q_home_timeline(spark, sf_dir)
    return R.timeline_state(fixtures.requests(spark, sf_dir), home)


@query("inbox_topn")
def q_inbox_topn(spark, sf_dir):
    """Newest 20 inbox ids per user."""
    ib = _stored_rows(spark, sf_dir)["inboxes"]
    return R.newest_stored(ib, FEED_READ_SIZE, CFG, CFG.as_of).select("uid", "rn", "time", "tid")


@query("homepage_topn")
def q_homepage_topn(spark, sf_dir):
    """R2: newest 20 own tweets per author."""
    hp = _tables(spark, sf_dir)["homepages"].select("uid", "time", "tid")
    return R.newest_n(hp, FEED_READ_SIZE).select("uid", "rn", "time", "tid")


@query("feed_topn_denorm")
def q_feed_topn_denorm(spark, sf_dir):
    """Newest 20 payloads per user from the denormalized feed."""
    rows, versions = batch.denorm_parts(spark, sf_dir, CFG, facts=_digest())
    return tl.feed_topn_denorm(rows, as_of=CFG.as_of, versions=versions).select("uid", "rn", "time", "tid", "text_md5")


@query("feed_topn_norm")
def q_feed_topn_norm(spark, sf_dir):
    """Newest 20 ids per user, then tweets by id set."""
    rows = _stored_rows(spark, sf_dir)
    return tl.feed_topn_norm(rows["inboxes"], rows["tweets"], as_of=CFG.as_of, facts=_digest()).select(
        "uid", "rn", "time", "tid", "text_md5")


@query("followers_of")
def q_followers_of(spark, sf_dir):
    """Adjacency rows of the requested users."""
    e = G.follower_edges(fixtures.edges(spark, sf_dir))
    return R.followers_of(e, fixtures.requests(spark, sf_dir)).select("uid", "follower")


@query("timeline_resolve")
def q_timeline_resolve(spark, sf_dir):
    """Inbox ids resolved to stored tweets (inner: missing ones vanish)."""
    rows, t = _stored_and_resolved(spark, sf_dir)
    ids = t["inboxes"].select("uid", "time", "tid")
    return R.resolve_tweets(ids, rows["tweets"], as_of=CFG.as_of, facts=_digest(), counts=rows.received).select(
        "uid", "time", "tid", "text_md5")


@query("tweets_in_set")
def q_tweets_in_set(spark, sf_dir):
    """Stored tweets whose id is in the set of newest-20 inbox ids."""
    rows = _stored_rows(spark, sf_dir)
    ids = R.newest_stored(rows["inboxes"], FEED_READ_SIZE, CFG, CFG.as_of)
    stored = rows["tweets"]
    return R.tweets_in_set(stored, ids, as_of=CFG.as_of).select("tid", _text())


@query("username_default")
def q_username_default(spark, sf_dir):
    """Each user's name, the default when the user has none."""
    return R.with_username(fixtures.requests(spark, sf_dir).select("uid"),
                           fixtures.usernames(spark, sf_dir), CFG.default_name)


# ---------------------------------------------------------------------------
# 2.6 Render
# ---------------------------------------------------------------------------
@query("render_tweets")
def q_render_tweets(spark, sf_dir):
    """V1 + V5: stored tweets rendered (text, author, profile link)."""
    tw = _tables(spark, sf_dir)["tweets"]
    return render(tw, "tweet", CFG, keep=("tid",)).select(
        "tid", "text", "author_name", "author_screen_name", "profile_url")


@query("localized_time")
def q_localized_time(spark, sf_dir):
    """V2: UTC time shown in New York time (DST by the zone rules)."""
    t = _tweets(spark, sf_dir)
    return t.select("tid", "time", local_time(F.col("time"), CFG.local_tz).alias("local_time"))


@query("hashtags_joined")
def q_hashtags_joined(spark, sf_dir):
    """V3: hashtags joined by ', ', null when none."""
    tw = _tables(spark, sf_dir)["tweets"]
    return render(tw, "tweet", CFG, keep=("tid",)).select("tid", "hashtags")


# ---------------------------------------------------------------------------
# 2.7 Graph preparation and audit
# ---------------------------------------------------------------------------
@query("follower_counts")
def q_follower_counts(spark, sf_dir):
    """G3."""
    return G.follower_counts(fixtures.edges(spark, sf_dir))


@query("following_counts")
def q_following_counts(spark, sf_dir):
    """G4."""
    return G.following_counts(fixtures.edges(spark, sf_dir), fixtures.users(spark, sf_dir))


@query("graph_totals")
def q_graph_totals(spark, sf_dir):
    """G6."""
    return G.graph_totals(fixtures.edges(spark, sf_dir))


@query("audience_tiers")
def q_audience_tiers(spark, sf_dir):
    """G5 re-aimed: degree tiers by uid position vs observed follower counts."""
    users = fixtures.users(spark, sf_dir)
    n = users.count()
    per_user = G.audience_tiers(users, G.follower_counts(fixtures.edges(spark, sf_dir)), n)
    return G.tier_summary(per_user)


@query("layout_equivalence")
def q_layout_equivalence(spark, sf_dir):
    """B1 re-aimed: both layouts serve the same newest-20 feed for every user."""
    n = _stored_rows(spark, sf_dir)
    rows, versions = batch.denorm_parts(spark, sf_dir, CFG, facts={"h": PL.digest_of(F.col("tweet"))})
    return tl.layout_equivalence(n["inboxes"], n["tweets"], rows, as_of=CFG.as_of, versions=versions)


@query("layout_equivalence_sample")
def q_layout_equivalence_sample(spark, sf_dir):
    """B1 + B2: the same audit for a deterministic sample of 40 requested users."""
    n = _stored_rows(spark, sf_dir)
    rows, versions = batch.denorm_parts(spark, sf_dir, CFG, facts={"h": PL.digest_of(F.col("tweet"))})
    some = tl.sample_users(fixtures.requests(spark, sf_dir), 40)
    out = tl.layout_equivalence(n["inboxes"], n["tweets"], rows, users=some, as_of=CFG.as_of, versions=versions)
    return out.agg(F.count(F.lit(1)).alias("n_users"), *[
        F.sum(c).cast("bigint").alias(c) for c in ("n_only_norm", "n_only_denorm")])


# ---------------------------------------------------------------------------
# 2.8 Streaming
# ---------------------------------------------------------------------------
def _edges_table(spark, sf_dir, root, df=None, store="set"):
    """Publish the delivery table (sets + listener, or the list store's edges) under
    ``root``; the stream re-reads it each batch and runs with listener=None."""
    path = f"{root}/delivery"
    if df is not None:
        J.append_delivery(df, CFG, path)
    else:
        J.publish_delivery(fixtures.edges(spark, sf_dir, distinct=(store == "set")), CFG.with_(store=store), path)
    return lambda: J.read_delivery(spark, path)


STREAM_CFG = CFG.with_(listener=None)   # listener rows live in the delivery table


@query("stream_fanout")
def q_stream_fanout(spark, sf_dir):
    """ST1/ST2/ST4: the feed streamed in two deliveries (at most 8 files per
    trigger) through foreachBatch into all norm sinks; all three tables after it
    drained (the end state does not depend on how files fall into batches)."""
    root = scratch_path(spark, "stream-fanout")
    _publish_both_deliveries(spark, sf_dir, root)
    store = TimelineStore(spark, f"{root}/store")
    loader = _edges_table(spark, sf_dir, root)
    ST.run_available(_feed_source(spark, root, max_files=8), store, loader, f"{root}/ckpt", STREAM_CFG)
    out = None
    for name in ("tweets", "homepages", "inboxes"):
        t = store.read(name, CFG, CFG.as_of)
        own = [F.col(c) if c in t.columns else F.lit(None).cast(k).alias(c)
               for c, k in (("uid", "bigint"), ("time", "timestamp_ntz"))]
        md5 = _text_md5() if "tweet" in t.columns else F.lit(None).cast("string").alias("text_md5")
        part = t.select(F.lit(name).alias("table"), *own, "tid", md5, "expire_at")
        out = part if out is None else out.unionByName(part)
    return out


def _streamed_feed(spark, sf_dir, layout, store):
    """End state of the receiving table of a streamed variant."""
    root = scratch_path(spark, f"stream-{layout}-{store}")
    _publish_both_deliveries(spark, sf_dir, root)
    target = TimelineStore(spark, f"{root}/store")
    loader = _edges_table(spark, sf_dir, root, store=store)
    cfg = STREAM_CFG.with_(layout=layout, store=store)
    ST.run_available(_feed_source(spark, root, max_files=8), target, loader, f"{root}/ckpt", cfg)
    return target, cfg


@query("stream_denorm")
def q_stream_denorm(spark, sf_dir):
    """ST5: the denormalized layout streamed; own tweets of every author and the feed of
    every receiver."""
    s, cfg = _streamed_feed(spark, sf_dir, "denorm", "set")
    own, feed = (s.read(t, cfg, cfg.as_of, facts=_digest()).select(F.lit(t).alias("table"), "uid", "time", "tid", "text_md5", "expire_at")
                 for t in ("historytweets", "feedslists"))
    return own.unionByName(feed)


@query("stream_list_denorm")
def q_stream_list_denorm(spark, sf_dir):
    """ST5: the list store and the denormalized layout streamed together (no listener); the
    feed of every receiver."""
    s, cfg = _streamed_feed(spark, sf_dir, "denorm", "list")
    return s.read("feedslists", cfg, cfg.as_of, facts=_digest()).select("uid", "time", "tid", "text_md5", "expire_at")


@query("stream_static_join")
def q_stream_static_join(spark, sf_dir):
    """J1 as a stream-static left join inside the streaming plan."""
    root = scratch_path(spark, "stream-join")
    _publish_feed(spark, sf_dir, root)
    followers = _delivery(spark, sf_dir)
    return ST.joined_stream_to_parquet(spark, _feed_source(spark, root), followers, f"{root}/out", f"{root}/ckpt", CFG).select(
        "tid", "uid", "n_followers", "sum_followers")


@query("stream_topics")
def q_stream_topics(spark, sf_dir):
    """The feed published to three topics by user, streamed with two of them subscribed,
    then restarted from the checkpoint with the third as well, after more had come."""
    root = scratch_path(spark, "stream-topics")
    raw = fixtures.raw_tweets(spark, sf_dir, keep_ts=True)
    topic = F.concat(F.lit("t"), F.get_json_object("value", "$.id_str").cast("bigint") % 3)
    out = None
    for part, topics in enumerate(("t0,t1", "t0, t1, t2")):
        for k in range(3):
            rows = _halves(raw, "ts")[part].filter(topic == f"t{k}")
            ingest.publish_text(rows, f"{root}/feed/t{k}/d{part}")
        source = ingest.read_topic_files(spark, f"{root}/feed", topics)
        out = ST.parsed_stream_to_parquet(spark, source, f"{root}/out", f"{root}/ckpt", CFG)
    return out.select("tid", "uid", "time", "lang", "topic")


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """ST6 with a watermark: the feed delivered, then delivered again with an added field
    after a restart; redelivered tids write nothing."""
    root = scratch_path(spark, "stream-dedup")
    store = TimelineStore(spark, f"{root}/store")
    loader = _edges_table(spark, sf_dir, root)
    edited = F.regexp_replace("value", "}$", ',"edited":1}').alias("value")
    for part, value in (("first", F.col("value")), ("again", edited)):
        ingest.publish_text(fixtures.raw_tweets(spark, sf_dir).select(value), f"{root}/feed/{part}")
        # the span of the feed: no first delivery may count as late, whatever file order
        ST.run_available(_feed_source(spark, root, max_files=8), store, loader, f"{root}/ckpt", STREAM_CFG, dedup_delay="60 days")
    written = store.raw("tweets").groupBy("tid").agg(
        F.count(F.lit(1)).alias("n_written"), F.count(PL.field(F.col("tweet"), "edited", "int")).alias("n_edited"))
    inbox = store.raw("inboxes").groupBy("tid").agg(F.count(F.lit(1)).alias("n_receivers"))
    return written.join(inbox, "tid", "left").select("tid", "n_written", "n_edited",
                                                     F.coalesce("n_receivers", F.lit(0)).alias("n_receivers"))


@query("stream_inbox_topn")
def q_stream_inbox_topn(spark, sf_dir):
    """R1/T4 as streaming state: newest 20 inbox rows per user, held by the stream over two
    deliveries and a restart; expired rows leave at the read."""
    root = scratch_path(spark, "stream-topn")
    followers = _delivery(spark, sf_dir)
    out = None
    for part in ("early", "late"):
        _publish_feed(spark, sf_dir, root, part)
        tweets = P.ingest(_feed_source(spark, root), STREAM_CFG)
        inbox = tweets.join(followers, "uid").select(F.col("follower").alias("uid"), "time", "tid")
        out = newest.run_newest(spark, inbox, f"{root}/pages", f"{root}/ckpt", FEED_READ_SIZE)
    live = T.visible(T.with_expiry(out, CFG), CFG.as_of)
    return R.newest_n(live.select("uid", "time", "tid"), FEED_READ_SIZE).select("uid", "rn", "time", "tid")


@query("stream_list_store")
def q_stream_list_store(spark, sf_dir):
    """ST5: the list store streamed (duplicates, no listener); inbox rows by user."""
    s, cfg = _streamed_feed(spark, sf_dir, "norm", "list")
    rows = s.read("inboxes", cfg, cfg.as_of)
    return rows.groupBy("uid").agg(F.count(F.lit(1)).alias("n_rows"), F.max("tid").alias("max_tid"))


@query("stream_replay")
def q_stream_replay(spark, sf_dir):
    """ST6: the same input delivered twice, the second time with an added field,
    ends in the same inbox."""
    root = scratch_path(spark, "stream-replay")
    _publish_feed(spark, sf_dir, root, "all", "first")
    store = TimelineStore(spark, f"{root}/store")
    loader = _edges_table(spark, sf_dir, root)
    ST.run_available(_feed_source(spark, root, max_files=8), store, loader, f"{root}/ckpt", STREAM_CFG)
    again = fixtures.raw_tweets(spark, sf_dir)             # every record redelivered
    ingest.publish_text(again.select(F.regexp_replace("value", "}$", ',"edited":1}').alias("value")), f"{root}/feed/again")
    ST.run_available(_feed_source(spark, root, max_files=8), store, loader, f"{root}/ckpt", STREAM_CFG)
    # full history, expired rows included
    return store.read("inboxes", CFG, None).select("uid", "time", "tid", "expire_at")


@query("stream_dimension_refresh")
def q_stream_dimension_refresh(spark, sf_dir):
    """ST3 + K8: the early delivery is processed while only follows from
    orders before 1995 exist; the later follows are added (set insert), the
    stream restarts from its checkpoint, and the late delivery reaches the
    new followers too."""
    root = scratch_path(spark, "stream-dim")
    early = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz")
    first = J.delivery_edges(fixtures.dated_edges(spark, sf_dir, early), CFG)
    loader = _edges_table(spark, sf_dir, root, first)
    _publish_feed(spark, sf_dir, root, "early")
    store = TimelineStore(spark, f"{root}/store")
    ST.run_available(_feed_source(spark, root, max_files=8), store, loader, f"{root}/ckpt", STREAM_CFG)
    # set insert of the later follows: delivery rows not stored yet
    everything = J.delivery_edges(fixtures.edges(spark, sf_dir), CFG)
    added = everything.join(first, ["uid", "follower"], "left_anti")
    _edges_table(spark, sf_dir, root, added)
    _publish_feed(spark, sf_dir, root, "late")
    ST.run_available(_feed_source(spark, root, max_files=8), store, loader, f"{root}/ckpt", STREAM_CFG)
    # full history: the early rows show the dimension as it was then
    return store.read("inboxes", CFG, None).select("uid", "time", "tid", "expire_at")
