import datetime as dt

from pyspark.sql import functions as F

from feedloom.config import FeedConfig
from feedloom.operators import fanout as J
from feedloom.operators import store as T
from feedloom.plans.batch import timeline_rows

T0 = dt.datetime(2024, 1, 30, 12, 0, 0)


def _tweets(spark, rows):
    return spark.createDataFrame([(tid, uid, t, f"p{tid}") for tid, uid, t in rows],
                                 "tid bigint, uid bigint, time timestamp_ntz, tweet string")


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "uid bigint, follower bigint")


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_same_second_upsert_and_keep_all(spark):
    tw = _tweets(spark, [(1, 10, T0), (2, 11, T0)])
    e = _edges(spark, [(10, 5), (11, 5)])
    rows = timeline_rows(tw, e, FeedConfig(listener=None))["inboxes"]
    assert _rows(T.upsert_uid_time(rows, "upsert"), "uid", "time", "tid") == [(5, T0, 2)]
    assert _rows(T.upsert_uid_time(rows, "keep_all"), "uid", "tid") == [(5, 1), (5, 2)]


def test_author_without_follower_row(spark):
    tw = _tweets(spark, [(1, 10, T0), (2, 12, T0)])
    e = _edges(spark, [(10, 5)])
    out = timeline_rows(tw, e, FeedConfig(listener=0))
    assert _rows(out["tweets"], "tid") == [(1,), (2,)]
    assert _rows(out["homepages"], "uid", "tid") == [(10, 1), (12, 2)]
    # author 12 has no row: nobody gets tweet 2, not even the listener
    assert _rows(out["inboxes"], "uid", "tid") == [(0, 1), (5, 1)]
    assert _rows(J.authors_without_followers(tw, e), "tid") == [(2,)]


def test_author_zero_once_in_own_inbox(spark):
    tw = _tweets(spark, [(1, 0, T0)])
    e = _edges(spark, [(0, 5), (0, 0)])
    out = timeline_rows(tw, e, FeedConfig(listener=0))["inboxes"]
    assert _rows(out, "uid", "tid") == [(0, 1), (5, 1)]


def test_list_store_duplicates(spark):
    tw = _tweets(spark, [(1, 10, T0)])
    e = _edges(spark, [(10, 5), (10, 5), (10, 6)])
    rows = timeline_rows(tw, e, FeedConfig(store="list"))["inboxes"]
    assert _rows(rows, "uid", "tid") == [(5, 1), (5, 1), (6, 1)]      # no listener either
    assert _rows(T.upsert_uid_time(rows), "uid", "tid") == [(5, 1), (6, 1)]


def test_list_store_text_follower_ids(spark):
    e = spark.createDataFrame([(10, "5"), (10, "x")], "uid bigint, follower string")
    assert _rows(J.list_store_edges(e), "uid", "follower") == [(10, 5)]


def test_listener_not_duplicated(spark):
    e = _edges(spark, [(10, 0), (10, 5), (11, 6)])
    assert _rows(J.with_listener(e, 0), "uid", "follower") == [(10, 0), (10, 5), (11, 0), (11, 6)]


def test_salted_fanout_equals_plain_join(spark):
    # author 10 is hot: 300 followers split over many salt values
    tw = _tweets(spark, [(i, 10 if i % 3 else 11, T0 + dt.timedelta(seconds=i)) for i in range(30)])
    e = _edges(spark, [(10, f) for f in range(300)] + [(11, f) for f in range(7)])
    cfg = FeedConfig(listener=None, skew_split_rows=16)
    salted = J.fanout(tw, e, cfg)
    plain = tw.join(e, "uid").select(F.col("follower").alias("uid"), "time", "tid")
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    assert salted.count() == 20 * 300 + 10 * 7


def test_join_followers_left(spark):
    tw = _tweets(spark, [(1, 10, T0), (2, 12, T0)])
    e = J.delivery_edges(_edges(spark, [(10, 5), (10, 6)]), FeedConfig(listener=0))
    got = {r["tid"]: r for r in J.join_followers_left(tw, e).collect()}
    assert got[1]["n_followers"] == 3 and got[1]["sum_followers"] == 11
    assert got[2]["n_followers"] is None


def test_list_store_round_trip(spark):
    from feedloom.session import scratch_path
    e = _edges(spark, [(10, 5), (10, 5), (11, 6)])
    path = scratch_path(spark, "t-list")
    J.publish_list_store(e, path)
    assert _rows(J.read_list_store(spark, path), "uid", "follower") == [(10, "5"), (10, "5"), (11, "6")]
    assert _rows(J.read_list_store(spark, path, "following"), "uid", "follower") == [(5, "10"), (5, "10"), (6, "11")]
    tw = _tweets(spark, [(1, 10, T0)])
    rows = timeline_rows(tw, J.read_list_store(spark, path), FeedConfig(store="list"))["inboxes"]
    assert _rows(rows, "uid", "tid") == [(5, 1), (5, 1)]


def test_author_with_many_tweets_is_split_too(spark):
    # 400 tweets x 5 receivers, 3 x 200, 100 x 90: hot by product on either side or both
    sizes = {10: (400, 5), 11: (3, 200), 12: (100, 90), 13: (2, 2)}
    tid, tweets, edges = 0, [], []
    for uid, (t, n) in sizes.items():
        tweets += [(tid + i, uid, T0 + dt.timedelta(seconds=tid + i)) for i in range(t)]
        tid += t
        edges += [(uid, 1000 + f) for f in range(n)]
    tw, e = _tweets(spark, tweets), _edges(spark, edges)
    got = J.fanout(tw, e, FeedConfig(listener=None, skew_split_rows=50))
    plain = tw.join(e, "uid").select(F.col("follower").alias("uid"), "time", "tid")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    from feedloom.operators.skew import hot_keys
    counts = e.groupBy("uid").agg(F.count(F.lit(1)).alias("_n"))
    hot = {r["uid"]: (r["_se"], r["_st"]) for r in hot_keys(tw, counts, "uid", 50).collect()}
    assert set(hot) == {10, 11, 12}
    for uid, (se, st) in hot.items():
        t, n = sizes[uid]
        assert (t / st) * (n / se) <= 2 * 50
