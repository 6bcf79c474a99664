import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.config import FeedConfig
from feedloom.functions import parse as P
from feedloom.operators import fanout as J
from feedloom.plans import batch
from feedloom.plans.registry import STREAM_CFG, _edges_table, _feed_source, _publish_feed
from feedloom.session import scratch_path
from feedloom.sources.store import TimelineStore
from feedloom.sources import ingest
from feedloom.streaming import fanout_stream as ST
from feedloom.streaming import newest

from conftest import SF_SMALL, raw_df, tweet_json

CFG = FeedConfig()


def _same(a, b):
    a, b = (x.withColumn("tweet", F.to_json("tweet")) if "tweet" in x.columns else x for x in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_small_batch_opens_the_buckets_of_its_authors(spark, tmp_path):
    path, cfg = f"{tmp_path}/delivery", CFG.with_(author_buckets=16, listener=None)
    edges = spark.createDataFrame([(a, 1000 + a * f) for a in range(60) for f in range(1, 4)], "uid bigint, follower bigint")
    J.publish_delivery(edges, cfg, path)
    assert len(glob.glob(f"{path}/author_bucket=*")) > 8
    few = spark.createDataFrame([(3, "2024-01-30 10:00:00", 1, 5), (3, "2024-01-30 10:00:01", 2, 5), (8, "2024-01-30 10:00:02", 3, 5)],
                                "uid bigint, time string, tid bigint, n int").withColumn("time", F.col("time").cast("timestamp_ntz"))
    few = few.persist()
    buckets = [r[0] for r in few.select(J.author_bucket(F.col("uid"), 16)).distinct().collect()]
    delivery = J.of_buckets(J.read_delivery(spark, path), buckets)
    rows = J.fanout(few, delivery, cfg, tweets_bytes=200)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "author_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    want = sorted((1000 + a * f, t) for a, t in ((3, 1), (3, 2), (8, 3)) for f in range(1, 4))
    assert sorted((r["uid"], r["tid"]) for r in rows.collect()) == want
    # files of the other buckets are not read: they may hold anything
    need = set(buckets)
    for f in glob.glob(f"{path}/author_bucket=*/*.parquet"):
        if int(f.split("author_bucket=")[1].split("/")[0]) not in need:
            with open(f, "wb") as out:
                out.write(b"no parquet")
            crc = f.rsplit("/", 1)[0] + "/." + f.rsplit("/", 1)[1] + ".crc"
            if os.path.exists(crc):
                os.remove(crc)
    assert len(need) < 3
    for size in (200, None):             # broadcast, and shuffled
        rows = J.fanout(few, J.of_buckets(J.read_delivery(spark, path), buckets), cfg, tweets_bytes=size)
        assert sorted((r["uid"], r["tid"]) for r in rows.collect()) == want
    assert J.of_buckets(J.read_delivery(spark, path), []).count() == 0
    # a whole micro-batch through the job finds its buckets itself
    raw = raw_df(spark, [tweet_json(1, 3, "Tue Jan 30 10:00:00 +0000 2024"), tweet_json(2, 8, "Tue Jan 30 10:00:01 +0000 2024"), "no"])
    store = TimelineStore(spark, f"{tmp_path}/store")
    ST.process_batch(raw, 0, store, lambda: J.read_delivery(spark, path), cfg)
    assert store.read("inboxes", cfg, None).count() == 6 and store.dead_letter().count() == 1
    few.unpersist()


def test_appended_follows_are_seen(spark, tmp_path):
    path, cfg = f"{tmp_path}/delivery", CFG.with_(author_buckets=4, listener=None)
    J.append_delivery(spark.createDataFrame([(1, 5)], "uid bigint, follower bigint"), cfg, path)
    assert J.read_delivery(spark, path).count() == 1
    J.append_delivery(spark.createDataFrame([(1, 6), (2, 6)], "uid bigint, follower bigint"), cfg, path)
    assert J.read_delivery(spark, path).select("uid", "follower").orderBy("uid", "follower").collect() == [(1, 5), (1, 6), (2, 6)]


def test_stream_equals_batch_and_replay(spark):
    root = scratch_path(spark, "t-stream")
    _publish_feed(spark, SF_SMALL, root, "early")
    _publish_feed(spark, SF_SMALL, root, "late")
    store = TimelineStore(spark, f"{root}/store")
    loader = _edges_table(spark, SF_SMALL, root)
    ST.run_available(_feed_source(spark, root, max_files=2), store, loader, f"{root}/ckpt", STREAM_CFG)
    want = batch.resolved_tables(spark, SF_SMALL, CFG, as_of=None)
    for t in ("tweets", "homepages", "inboxes"):
        cols = [c for c in want[t].columns]
        assert _same(store.read(t, CFG, None).select(*cols), want[t].select(*cols)), t
    assert store.dead_letter().count() == 0
    # redelivery: the same records again as new files -> same tables
    _publish_feed(spark, SF_SMALL, root, "all", "again")
    ST.run_available(_feed_source(spark, root, max_files=2), store, loader, f"{root}/ckpt", STREAM_CFG)
    for t in ("tweets", "homepages", "inboxes"):
        cols = [c for c in want[t].columns]
        assert _same(store.read(t, CFG, None).select(*cols), want[t].select(*cols)), t


def test_stream_dead_letters(spark):
    root = scratch_path(spark, "t-stream-dl")
    spark.createDataFrame([("not json",), ('{"delete":{}}',)], "value string") \
        .write.text(f"{root}/feed/d0")
    store = TimelineStore(spark, f"{root}/store")
    loader = _edges_table(spark, SF_SMALL, root)
    ST.run_available(_feed_source(spark, root), store, loader, f"{root}/ckpt", STREAM_CFG)
    got = sorted(r["reason"] for r in store.dead_letter().select("reason").collect())
    assert got == ["malformed_json", "missing_id"]
    assert store.read("inboxes", CFG, None).count() == 0


def _at(minute, author=3):
    return f"Tue Jan 30 10:{minute:02d}:00 +0000 2024"


def test_redelivery_inside_the_watermark_writes_nothing(spark, tmp_path):
    path, cfg = f"{tmp_path}/delivery", CFG.with_(listener=None)
    J.append_delivery(spark.createDataFrame([(3, 30), (3, 31)], "uid bigint, follower bigint"), cfg, path)
    store = TimelineStore(spark, f"{tmp_path}/store")

    def deliver(name, values):
        ingest.publish_text(raw_df(spark, values).coalesce(1), f"{tmp_path}/feed/{name}")
        ST.run_available(_feed_source(spark, str(tmp_path)), store, lambda: J.read_delivery(spark, path), f"{tmp_path}/ckpt", cfg,
                         dedup_delay="30 minutes")

    deliver("a", [tweet_json(1, 3, _at(1)), tweet_json(2, 3, _at(2)), tweet_json(2, 3, _at(2)), "no json", "no json"])
    assert store.raw("tweets").count() == 2 and store.raw("inboxes").count() == 4
    assert store.dead_letter().count() == 2                         # no id: nothing to tell them apart by
    # a restart from the checkpoint knows them still; a new tweet goes through
    deliver("b", [tweet_json(1, 3, _at(1), text="again"), tweet_json(3, 3, _at(20))])
    assert sorted(r["tid"] for r in store.raw("tweets").collect()) == [1, 2, 3]
    assert store.raw("inboxes").count() == 6
    # beyond the watermark the state lets go of old ids, and late records are dropped
    deliver("c", [tweet_json(4, 3, _at(59))])
    deliver("d", [tweet_json(1, 3, _at(1)), tweet_json(5, 3, _at(58))])
    assert sorted(r["tid"] for r in store.raw("tweets").collect()) == [1, 2, 3, 4, 5]
    late = store.read("inboxes", cfg, None).groupBy("tid").count().collect()
    assert {r["tid"]: r["count"] for r in late} == {t: 2 for t in range(1, 6)}


def test_topics_taken_up_after_a_restart(spark, tmp_path):
    def publish(topic, part, ids):
        ingest.publish_text(raw_df(spark, [tweet_json(i, 3, _at(i)) for i in ids]).coalesce(1), f"{tmp_path}/feed/{topic}/{part}")

    def run(topics):
        source = ingest.read_topic_files(spark, f"{tmp_path}/feed", topics, max_files_per_trigger=1)
        out = ST.parsed_stream_to_parquet(spark, source, f"{tmp_path}/out", f"{tmp_path}/ckpt", CFG)
        return sorted((r["tid"], r["topic"]) for r in out.collect())

    publish("x", "d0", [1, 2])
    publish("y", "d0", [3])
    publish("z", "d0", [4])
    assert run("x, y") == [(1, "x"), (2, "x"), (3, "y")]
    publish("x", "d1", [5])
    assert run("x,y,z") == [(1, "x"), (2, "x"), (3, "y"), (4, "z"), (5, "x")]
    for bad in ("", " ,", "a/b", "{a}"):
        with pytest.raises(ValueError):
            ingest.read_topic_files(spark, f"{tmp_path}/feed", bad)


def test_newest_rows_are_bounded_and_keep_the_largest_tid():
    t = pd.to_datetime(["2024-01-01 00:00:01", "2024-01-01 00:00:01", "2024-01-01 00:00:03", "2024-01-01 00:00:02", "2024-01-01 00:00:09"])
    rows = pd.DataFrame({"uid": [1, 1, 1, 1, 2], "time": t, "tid": [5, 6, 1, 9, 4]})
    assert newest.newest_rows(rows, 2)[["uid", "tid"]].values.tolist() == [[1, 1], [1, 9], [2, 4]]
    assert newest.newest_rows(rows, 9)[["uid", "tid"]].values.tolist() == [[1, 1], [1, 9], [1, 6], [2, 4]]


def test_pages_held_by_the_stream(spark, tmp_path):
    followers = spark.createDataFrame([(3, 30), (3, 31), (8, 30)], "uid bigint, follower bigint")

    def run(name, values):
        ingest.publish_text(raw_df(spark, values).coalesce(1), f"{tmp_path}/feed/{name}")
        inbox = P.ingest(_feed_source(spark, str(tmp_path)), CFG).join(followers, "uid").select(F.col("follower").alias("uid"), "time", "tid")
        out = newest.run_newest(spark, inbox, f"{tmp_path}/pages", f"{tmp_path}/ckpt", 3)
        return sorted((r["uid"], r["time"].minute, r["tid"]) for r in out.collect())

    assert run("a", [tweet_json(k, 3, _at(k)) for k in range(1, 6)]) == [(u, k, k) for u in (30, 31) for k in (3, 4, 5)]
    # an old row changes no page, the same second keeps the larger tid, a new row pushes the oldest out
    got = run("b", [tweet_json(9, 3, _at(2)), tweet_json(7, 8, _at(5)), tweet_json(8, 8, _at(30))])
    assert got == [(30, 4, 4), (30, 5, 7), (30, 30, 8), (31, 3, 3), (31, 4, 4), (31, 5, 5)]
