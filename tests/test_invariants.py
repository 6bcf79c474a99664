"""Invariants on the fixture data and properties on generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from feedloom.config import FeedConfig
from feedloom.functions.parse import ingest
from feedloom.operators import fanout as J
from feedloom.operators import graph as G
from feedloom.operators import reads as R
from feedloom.operators import store as T
from feedloom.plans import batch
from feedloom.plans import timelines as tl
from feedloom.sources import fixtures

CFG = FeedConfig()


def test_fanout_rows_equal_sum_of_delivery_sets(spark):
    tweets = ingest(fixtures.raw_tweets(spark, SF_SMALL), CFG)
    deliver = J.delivery_edges(fixtures.edges(spark, SF_SMALL), CFG)
    sizes = J.follower_stats(deliver)
    expected = tweets.join(sizes, "uid").agg(F.sum("n_followers")).first()[0]
    rows = batch.batch_tables(spark, SF_SMALL, CFG)["inboxes"].count()
    assert rows == expected == 58_074           # FIXTURES.md, sf0.001


def test_layouts_serve_same_feeds(spark):
    n = batch.resolved_tables(spark, SF_SMALL, CFG, None)
    d = batch.resolved_tables(spark, SF_SMALL, CFG.with_(layout="denorm"), None)
    eq = tl.layout_equivalence(n["inboxes"], n["tweets"], d["feedslists"])
    s = eq.agg(F.sum("n_only_norm"), F.sum("n_only_denorm"), F.sum("n_norm"), F.sum("n_denorm")).first()
    assert s[0] == 0 and s[1] == 0 and s[2] == s[3] > 0


def test_inverting_following_gives_followers(spark):
    e = fixtures.edges(spark, SF_SMALL)
    users = fixtures.users(spark, SF_SMALL)
    inv = G.following_lists(e, users).select("uid", F.explode("followinglist").alias("followee"))
    back = inv.select(F.col("followee").alias("uid"), F.col("uid").alias("follower"))
    a = G.followers_lists(back).select("uid", "chunk", "followerslist")
    b = G.followers_lists(e).select("uid", "chunk", "followerslist")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_upsert_keeps_one_row_per_key(spark):
    rows = batch.batch_tables(spark, SF_SMALL, CFG)["inboxes"]
    res = T.upsert_uid_time(rows)
    assert res.count() == rows.select("uid", "time").distinct().count() == 58_074


pairs = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40)), min_size=1, max_size=120)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=pairs, authors=st.lists(st.integers(0, 7), min_size=1, max_size=30),
       split=st.integers(1, 8))
def test_salted_fanout_property(spark, edges, authors, split):
    t0 = dt.datetime(2024, 1, 30)
    tw = spark.createDataFrame([(i, a, t0 + dt.timedelta(seconds=i)) for i, a in enumerate(authors)],
                               "tid bigint, uid bigint, time timestamp_ntz")
    e = spark.createDataFrame(edges, "uid bigint, follower bigint")
    got = sorted(tuple(r) for r in J.fanout(tw, e, FeedConfig(skew_split_rows=split)).collect())
    want = sorted((f, t0 + dt.timedelta(seconds=i), i) for i, a in enumerate(authors)
                  for (u, f) in edges if u == a)
    assert got == want


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 50)),
                     min_size=1, max_size=80),
       n=st.integers(1, 6))
def test_upsert_then_newest_n_property(spark, rows, n):
    t0 = dt.datetime(2024, 1, 30)
    df = spark.createDataFrame([(u, t0 + dt.timedelta(seconds=s), tid) for u, s, tid in rows],
                               "uid bigint, time timestamp_ntz, tid bigint")
    got = sorted(tuple(r) for r in R.newest_n(T.upsert_uid_time(df), n).select("uid", "rn", "tid").collect())
    best = {}
    for u, s, tid in rows:
        best[(u, s)] = max(best.get((u, s), -1), tid)
    want = []
    for u in {u for u, _ in best}:
        keys = sorted((s for (uu, s) in best if uu == u), reverse=True)[:n]
        want += [(u, i + 1, best[(u, s)]) for i, s in enumerate(keys)]
    assert got == sorted(want)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=st.sets(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=40))
def test_listener_property(spark, edges):
    e = spark.createDataFrame(sorted(edges), "uid bigint, follower bigint")
    got = sorted(tuple(r) for r in J.with_listener(e, 0).collect())
    want = sorted(set(edges) | {(u, 0) for u, _ in edges})
    assert got == want                     # set semantics, only existing sets


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=st.sets(st.tuples(st.integers(0, 3), st.integers(4, 400)), min_size=1, max_size=300),
       chunk=st.integers(1, 50))
def test_chunked_sets_property(spark, edges, chunk):
    e = spark.createDataFrame(sorted(edges), "uid bigint, follower bigint")
    rows = G.followers_lists(e, chunks=chunk).collect()
    got = {}
    for r in rows:
        assert r["followerslist"] == sorted(r["followerslist"])
        got.setdefault(r["uid"], []).extend(r["followerslist"])
    want = {}
    for u, f in edges:
        want.setdefault(u, []).append(f)
    assert {u: sorted(v) for u, v in got.items()} == {u: sorted(v) for u, v in want.items()}
    n_chunks = {}
    for r in rows:
        n_chunks[r["uid"]] = n_chunks.get(r["uid"], 0) + 1
    for u, fs in want.items():
        assert n_chunks[u] <= min(len(fs), chunk)
