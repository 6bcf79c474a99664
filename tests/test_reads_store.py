import datetime as dt

from pyspark.sql import functions as F

from conftest import raw_df, tweet_json
from feedloom.config import FeedConfig
from feedloom.functions.parse import ingest
from feedloom.functions.payload import text
from feedloom.operators import reads as R
from feedloom.operators import store as T
from feedloom.operators.bloom import may_hold
from feedloom.plans import timelines as tl
from feedloom.plans.batch import timeline_rows
from feedloom.session import scratch_path
from feedloom.sources import store as store_module
from feedloom.sources.store import TimelineStore, columns, compact, read_compacted

T0 = dt.datetime(2024, 1, 30, 12, 0, 0)
CFG = FeedConfig(listener=None)


def test_page_sizes(spark):
    df = spark.createDataFrame([(n,) for n in (0, 45, 49, 50, 60)], "n int")
    assert [r[0] for r in df.select(R.page_size(F.col("n"))).collect()] == [5, 50, 54, 50, 60]


def _feed(spark, n_tweets, start=T0, author=10):
    vals = [tweet_json(i, author, (start + dt.timedelta(minutes=i)).strftime("%a %b %d %H:%M:%S +0000 %Y"),
                       text=f"t{i}") for i in range(1, n_tweets + 1)]
    return ingest(raw_df(spark, vals), CFG)


def test_paged_home_timeline_per_user(spark):
    tw = _feed(spark, 70)
    e = spark.createDataFrame([(10, u) for u in (1, 2, 3, 4, 5)], "uid bigint, follower bigint")
    rows = timeline_rows(tw, e, CFG)
    inbox = T.resolve("inboxes", rows["inboxes"], CFG, CFG.as_of)
    tweets = T.resolve("tweets", rows["tweets"], CFG, CFG.as_of)
    req = spark.createDataFrame([(1, 0), (2, 45), (3, 49), (4, 50), (5, 60), (6, 0)], "uid bigint, n int")
    names = spark.createDataFrame([(2, "bob")], "uid bigint, uname string")
    home = tl.home_timeline(inbox, tweets, names, req, CFG)
    counts = {r["uid"]: r["count"] for r in home.groupBy("uid").count().collect()}
    assert counts == {1: 5, 2: 50, 3: 54, 4: 50, 5: 60}
    top = home.filter("uid = 1").orderBy("rn").collect()
    assert [r["tid"] for r in top] == [70, 69, 68, 67, 66]          # newest first
    assert {r["uname"] for r in home.filter("uid = 2").collect()} == {"bob"}
    assert {r["uname"] for r in home.filter("uid = 1").collect()} == {CFG.default_name}
    state = {r["uid"]: (r["n_rows"], r["has_tweets"]) for r in R.timeline_state(req, home).collect()}
    assert state[6] == (0, False) and state[1] == (5, True)


def test_expired_tweet_leaves_short_page(spark):
    tw = _feed(spark, 6)
    e = spark.createDataFrame([(10, 1)], "uid bigint, follower bigint")
    rows = timeline_rows(tw, e, CFG)
    inbox = T.resolve("inboxes", rows["inboxes"], CFG, CFG.as_of)
    # tweet 6 is gone from the tweets table (expired there), its inbox id is not
    tweets = T.resolve("tweets", rows["tweets"], CFG, CFG.as_of).filter("tid <> 6")
    req = spark.createDataFrame([(1, 0)], "uid bigint, n int")
    home = tl.home_timeline(inbox, tweets, spark.createDataFrame([], "uid bigint, uname string"), req, CFG)
    assert sorted(r["rn"] for r in home.collect()) == [2, 3, 4, 5]     # slot 1 used, row absent


def test_ttl_visibility(spark):
    old = T0 - dt.timedelta(days=8)
    tw = _feed(spark, 2, start=old).unionByName(_feed(spark, 2, start=T0).withColumn("tid", F.col("tid") + 100))
    e = spark.createDataFrame([(10, 1)], "uid bigint, follower bigint")
    inbox = T.resolve("inboxes", timeline_rows(tw, e, CFG)["inboxes"], CFG, CFG.as_of)
    assert sorted(r["tid"] for r in inbox.collect()) == [101, 102]


def test_store_replay_and_compaction(spark):
    tw = _feed(spark, 20)
    e = spark.createDataFrame([(10, 1), (10, 2)], "uid bigint, follower bigint")
    store = TimelineStore(spark)
    rows = timeline_rows(tw, e, CFG)
    for bid in (0, 1):
        for t, df in rows.items():
            store.write_batch(t, df, bid)          # batch 1 is the same input again
    once = TimelineStore(spark)
    for t, df in rows.items():
        once.write_batch(t, df, 0)
    for t in rows:
        a, b = comparable(store.read(t, CFG, CFG.as_of)), comparable(once.read(t, CFG, CFG.as_of))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    store.write_batch("inboxes", rows["inboxes"], 0)                  # replay of batch 0: no-op
    assert store.raw("inboxes").count() == 2 * 40
    first, second = (scratch_path(spark, f"t-compact{k}") for k in range(2))
    compact(store.raw("inboxes"), "inboxes", first, CFG, CFG.as_of)
    assert read_compacted(spark, "inboxes", first).count() == 40
    store.write_batch("inboxes", rows["inboxes"], 2)
    assert store.raw("inboxes", after=1).count() == 40
    compact(read_compacted(spark, "inboxes", first).unionByName(store.raw("inboxes", after=1).drop("batch_id")),
            "inboxes", second, CFG, CFG.as_of)
    a, b = read_compacted(spark, "inboxes", second), once.read("inboxes", CFG, CFG.as_of).select(*columns("inboxes"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def comparable(df):
    """Set operations know no VARIANT."""
    return df.withColumn("tweet", F.to_json("tweet")) if "tweet" in df.columns else df


def test_layout_equivalence_and_feed_reads(spark):
    tw = _feed(spark, 30)
    e = spark.createDataFrame([(10, 1), (10, 2)], "uid bigint, follower bigint")
    norm = timeline_rows(tw, e, CFG)
    den = timeline_rows(tw, e, CFG.with_(layout="denorm"))
    ib = T.resolve("inboxes", norm["inboxes"], CFG, None)
    tws = T.resolve("tweets", norm["tweets"], CFG, None)
    fl = T.resolve("feedslists", den["feedslists"], CFG, None)
    eq = {r["uid"]: tuple(r)[1:] for r in tl.layout_equivalence(ib, tws, fl).collect()}
    assert eq == {1: (20, 20, 0, 0), 2: (20, 20, 0, 0)}
    # break one payload in the denormalized copy: the audit sees it
    bad = fl.withColumn("tweet", F.when(F.col("tid") == 30, F.parse_json(F.lit('"x"'))).otherwise(F.col("tweet")))
    eq = {r["uid"]: tuple(r)[1:] for r in tl.layout_equivalence(ib, tws, bad).collect()}
    assert eq[1] == (20, 20, 1, 1)


def test_sample_users_deterministic(spark):
    users = spark.createDataFrame([(u,) for u in range(1000)], "uid bigint")
    a = [r[0] for r in tl.sample_users(users, 25, seed=3).collect()]
    b = [r[0] for r in tl.sample_users(users, 25, seed=3).collect()]
    c = [r[0] for r in tl.sample_users(users, 25, seed=4).collect()]
    assert a == b and len(set(a)) == 25 and set(a) != set(c)


def test_user_page_pushes_uid_to_scan(spark):
    tw = _feed(spark, 12)
    e = spark.createDataFrame([(10, 1), (10, 2)], "uid bigint, follower bigint")
    store = TimelineStore(spark)
    store.write_batch("inboxes", timeline_rows(tw, e, CFG)["inboxes"], 0)
    page = R.user_page(store.read("inboxes", CFG, CFG.as_of), 2, 3)
    assert [r["tid"] for r in page.collect()] == [12, 11, 10]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(uid,2)" in plan and "TakeOrderedAndProject" in plan


def test_write_time_expiry_stamp(spark):
    df = spark.createDataFrame([(1,)], "tid bigint")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        r = T.with_expiry(df, CFG, None).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((r["ingest_ts"] - now).total_seconds()) < 120
    assert r["expire_at"] - r["ingest_ts"] == dt.timedelta(seconds=CFG.ttl_seconds)


STAMPED = "uid bigint, time timestamp_ntz, tid bigint, ingest_ts timestamp_ntz, expire_at timestamp_ntz"


def _day(d):
    return dt.datetime(2024, 1, d)


def test_expired_write_neither_hides_nor_outlives_another(spark):
    # write-time stamps: tid 9 expires on the 17th, tid 3 on the 25th
    rows = [(1, _day(10), 9, _day(10), _day(17)), (1, _day(10), 3, _day(18), _day(25))]
    direct, between = TimelineStore(spark), TimelineStore(spark)
    for s in (direct, between):
        for b, r in enumerate(rows):
            s.write_batch("inboxes", spark.createDataFrame([r], STAMPED), b)
    path = scratch_path(spark, "t-between")
    compact(between.raw("inboxes"), "inboxes", path, CFG, "2024-01-19 00:00:00")
    late = T.visible(read_compacted(spark, "inboxes", path), "2024-01-20 00:00:00")
    for df in (direct.read("inboxes", CFG, "2024-01-20 00:00:00"), late):
        assert [tuple(r) for r in df.select("tid", "expire_at").collect()] == [(3, _day(25))]
    early = direct.read("inboxes", CFG, "2024-01-16 00:00:00").select("tid", "ingest_ts", "expire_at").collect()
    assert [tuple(r) for r in early] == [(9, _day(10), _day(17))]       # all columns from the winning row


def test_one_tid_with_two_payloads(spark):
    rows = [(1, _day(10), 5, "old", _day(10), _day(17)), (1, _day(10), 5, "new", _day(11), _day(18))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "uid bigint, time timestamp_ntz, tid bigint, tweet string, "
                                          "ingest_ts timestamp_ntz, expire_at timestamp_ntz").coalesce(1)
        got = T.resolve("feedslists", df, CFG, None).first()
        assert (got["tweet"], got["ingest_ts"], got["expire_at"]) == ("new", _day(11), _day(18))


def test_payload_versions_by_hash(spark):
    rows = [(1, _day(10), 5, "old", 7, _day(10), _day(17)), (1, _day(10), 5, "new", 3, _day(11), _day(18)),
            (1, _day(10), 5, "newest", 9, _day(11), _day(18)), (1, _day(10), 5, "newest", 9, _day(11), _day(18)),
            (1, _day(10), 4, "other", 99, _day(12), _day(19)), (2, _day(10), 4, None, None, _day(12), _day(19))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "uid bigint, time timestamp_ntz, tid bigint, tweet string, tweet_hash bigint, "
                                          "ingest_ts timestamp_ntz, expire_at timestamp_ntz").coalesce(1)
        df = df.withColumn("tweet", F.parse_json(F.to_json(F.struct(F.col("tweet").alias("text")))))
        got = T.resolve("feedslists", df, CFG, None).orderBy("uid").select("uid", "tid", "tweet_hash", F.to_json("tweet")).collect()
        assert [tuple(r) for r in got] == [(1, 5, 9, '{"text":"newest"}'), (2, 4, None, "{}")]
        # the keys without their payload resolve to the same versions
        keys = T.resolve("inboxes", df.drop("tweet"), CFG, None).orderBy("uid").select("uid", "tid", "tweet_hash").collect()
        assert [tuple(r) for r in keys] == [tuple(r)[:3] for r in got]
        feed = tl.feed_topn_denorm(df, 3, None, CFG).orderBy("uid").select("uid", "rn", "tid", F.to_json("tweet")).collect()
        assert [tuple(r) for r in feed][0] == (1, 1, 5, '{"text":"newest"}')


def test_facts_stand_in_for_payloads(spark):
    tw = _feed(spark, 12)
    e = spark.createDataFrame([(10, 1), (10, 2)], "uid bigint, follower bigint")
    cfg = CFG.with_(layout="denorm")
    store = TimelineStore(spark)
    store.write_batch("feedslists", timeline_rows(tw, e, cfg)["feedslists"], 0)
    facts = store.read("feedslists", cfg, cfg.as_of, facts={"shown": F.upper(text(F.col("tweet")))})
    assert "tweet" not in facts.columns
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "variant" not in plan[:plan.rindex("Exchange")] and "tweet" in plan[plan.rindex("Exchange"):]
    assert sorted((r["uid"], r["tid"], r["shown"]) for r in facts.collect()) == [(u, i, f"T{i}") for u in (1, 2) for i in range(1, 13)]


def test_point_read_of_a_compacted_table_reads_few_row_groups(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq
    store = TimelineStore(spark)
    e = spark.createDataFrame([(10, u) for u in range(4000)], "uid bigint, follower bigint")
    store.write_batch("inboxes", timeline_rows(_feed(spark, 30), e, CFG)["inboxes"], 0)
    path = scratch_path(spark, "t-page")
    monkeypatch.setattr(store_module, "ROW_GROUP", 64 << 10)
    compact(store.raw("inboxes"), "inboxes", path, CFG, CFG.as_of)
    page = R.user_page(T.visible(read_compacted(spark, "inboxes", path), CFG.as_of), 1234, 3)
    assert [r["tid"] for r in page.collect()] == [30, 29, 28]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(uid,1234)" in plan and "GreaterThan(expire_at" in plan and "TakeOrderedAndProject" in plan
    groups = [(f, g) for f in glob.glob(f"{path}/*.parquet") for g in range(pq.ParquetFile(f).num_row_groups)]
    stats = [pq.ParquetFile(f).metadata.row_group(g).column(0).statistics for f, g in groups]
    assert len(groups) > 2 and sum(s.min <= 1234 <= s.max for s in stats) <= 2
    uid = pq.ParquetFile(groups[0][0]).metadata.row_group(0).column(0)
    assert uid.path_in_schema == "uid"


def test_bloom_filter_keeps_every_member(spark):
    ids = spark.range(0, 30_000, 3).withColumnRenamed("id", "tid").unionByName(spark.createDataFrame([(None,)], "tid bigint"))
    tweets = spark.range(60_000).select(F.col("id").alias("tid"), F.lit("x").alias("tweet"))
    kept = tweets.filter(may_hold(F.col("tid"), ids, "tid", 1 << 17))
    assert kept.join(ids, "tid", "left_semi").count() == 10_000        # none of the set is lost
    assert kept.count() < 10_000 + 0.03 * 50_000                       # few others pass
    small = CFG.with_(bloom_bits=1 << 17)
    assert R.tweets_in_set(tweets, ids, cfg=small).count() == 10_000   # the join removes them
    assert R.tweets_in_set(tweets, ids.limit(0), cfg=small).count() == 0
    assert R.tweets_in_set(tweets, ids, max_ids=10_001, cfg=small).count() == 10_000


def test_hot_tid_is_split(spark):
    ids = spark.range(5000).select(F.col("id").alias("uid"), F.lit(1).alias("rn"), F.lit(7).cast("long").alias("tid")) \
        .unionByName(spark.createDataFrame([(1, 2, 8), (2, 2, 9)], "uid bigint, rn int, tid bigint"))
    tweets = spark.createDataFrame([(7, "hot"), (8, "cold")], "tid bigint, tweet string")
    got = R.resolve_tweets(ids, tweets, cfg=CFG.with_(skew_split_rows=100, bloom_bits=1 << 12))
    assert got.columns[:1] == ["tid"] and got.groupBy("tid", "tweet").count().orderBy("tid").collect() == [(7, "hot", 5000), (8, "cold", 1)]
