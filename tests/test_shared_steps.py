"""The steps that the timeline queries share: what is read once, what moves, how many tasks make it."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL, raw_df, tweet_json
from feedloom.config import FeedConfig
from feedloom.functions.parse import ingest, parse_raw
from feedloom.operators import reads as R
from feedloom.operators import store as T
from feedloom.plans import batch, registry
from feedloom.session import scratch_path
from feedloom.sources.store import TimelineStore, compact, read_compacted
from feedloom.streaming import fanout_stream as ST
from feedloom.streaming import newest

CFG = FeedConfig()
T0 = dt.datetime(2024, 1, 30, 12, 0, 0)
STORED = "uid bigint, time timestamp_ntz, tid bigint, ingest_ts timestamp_ntz, expire_at timestamp_ntz"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") \
        + df._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning")


def _stored(spark, n=4000, users=7):
    rnd = random.Random(3)
    at = lambda: T0 + dt.timedelta(seconds=rnd.randrange(60))
    rows = [(rnd.randrange(users), at(), rnd.randrange(50), T0 + dt.timedelta(hours=rnd.randrange(2)),
             T0 + dt.timedelta(hours=rnd.choice([1, 30, 31]))) for _ in range(n)]
    return spark.createDataFrame(rows, STORED)


def test_records_are_parsed_once_for_the_fanout(spark):
    rows = batch.batch_tables(spark, SF_SMALL, CFG)["inboxes"]
    assert "from_json" not in _plan(rows) and "o_custkey" not in _plan(rows)
    assert rows.count() == registry.QUERIES["fanout_norm"](spark, SF_SMALL).count() > 0


def test_fanout_has_a_task_for_so_many_rows(spark):
    cfg = FeedConfig(listener=None, skew_split_rows=50)
    at = T0.strftime("%a %b %d %H:%M:%S +0000 %Y")
    tweets = ingest(raw_df(spark, [tweet_json(i, i % 5, at) for i in range(40)]), cfg)
    edges = spark.range(5).withColumnRenamed("id", "uid").join(spark.range(100, 150).withColumnRenamed("id", "follower"))
    tables = batch.timeline_rows(tweets, edges, cfg, once=True)
    assert tables["inboxes"].rdd.getNumPartitions() >= 40 * 50 // 50
    assert tables["inboxes"].select("uid", "tid").distinct().count() == tables["inboxes"].count() == 40 * 50
    resolved = batch.resolved_view(tables, cfg, None)["inboxes"]
    assert resolved.rdd.getNumPartitions() >= 40 and resolved.count() == 5 * 50 // 5      # one second: one row a receiver


def test_newest_of_stored_rows_moves_them_once(spark):
    rows = _stored(spark)
    for policy in ("upsert", "keep_all"):
        cfg = FeedConfig(policy=policy)
        for as_of in (None, str(T0 + dt.timedelta(hours=2))):
            got = R.newest_stored(rows, 5, cfg, as_of)
            want = R.newest_n(T.resolve("inboxes", rows, cfg, as_of), 5)
            cols = ["uid", "rn", "time", "tid", "ingest_ts", "expire_at"]
            assert got.select(cols).exceptAll(want.select(cols)).count() == 0
            assert got.count() == want.count() == 7 * 5
    assert _exchanges(R.newest_stored(rows, 5, CFG)) == 1


def test_shown_facts_go_along_with_the_fanout(spark):
    rows = registry._receiver_rows(spark, SF_SMALL)
    first = next(line for line in _plan(rows).splitlines() if "Join " in line)
    assert "uid" in first and "tweet_hash" not in first       # nothing joins the rows of receivers


def test_inbox_ids_meet_tweets_without_being_written(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(R, "cut", lambda spark, df, label: seen.append(label) or df)
    out = registry.QUERIES["timeline_resolve"](spark, SF_SMALL)
    assert not seen and out.filter("text_md5 is null").count() == 0 < out.count()


def test_compaction_moves_rows_once(spark):
    rows = _stored(spark)
    ranged = rows.repartitionByRange(6, "uid", F.desc("time"))
    assert _exchanges(T.resolve("inboxes", ranged, CFG, None, placed=True)) == 1
    for as_of in (None, str(T0 + dt.timedelta(hours=2))):
        path = scratch_path(spark, "t-compact")
        compact(rows, "inboxes", path, CFG, as_of)
        got, want = read_compacted(spark, "inboxes", path), T.resolve("inboxes", rows, CFG, as_of)
        assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_a_micro_batch_holds_each_text_once(spark, monkeypatch):
    frame, seen = type(spark.range(1)), []
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: seen.append(self.columns) or real(self, *a))
    at = T0.strftime("%a %b %d %H:%M:%S +0000 %Y")
    store = TimelineStore(spark)
    edges = spark.createDataFrame([(1, 5), (1, 6)], "uid bigint, follower bigint")
    records = parse_raw(raw_df(spark, [tweet_json(1, 1, at), "not json"]), CFG)
    ST.process_parsed(records, 0, store, lambda: edges, FeedConfig(listener=None))
    assert seen == [["value", "tid", "uid", "time", "lang", "reason"]]
    assert store.raw("inboxes").count() == 2 and store.dead_letter().count() == 1


def test_rows_of_a_task_are_sorted_few_times(monkeypatch):
    rnd, real, sorted_rows = random.Random(1), newest.newest_rows, []
    parts = [pd.DataFrame({"uid": range(k * 50, k * 50 + 50), "time": [pd.Timestamp(2024, 1, 1 + rnd.randrange(20)) for _ in range(50)],
                           "tid": range(50)}) for k in range(100)] * 2
    monkeypatch.setattr(newest, "newest_rows", lambda rows, n: sorted_rows.append(len(rows)) or real(rows, n))
    (got,) = newest.newest_of_task(iter(parts), 3, least=100)
    want = real(pd.concat(parts, ignore_index=True), 3)
    assert got.reset_index(drop=True).equals(want.reset_index(drop=True))
    assert sum(sorted_rows) < 6 * sum(map(len, parts))
