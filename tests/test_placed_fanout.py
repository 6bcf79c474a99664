"""Inboxes resolved where their rows are made: edges go to their receivers, tweets come packed by author."""

import re

import pytest

from conftest import SF_SMALL, raw_df, tweet_json
from feedloom.config import FeedConfig
from feedloom.functions.parse import ingest
from feedloom.operators import fanout as J
from feedloom.operators import store as T
from feedloom.plans import batch
from feedloom.plans.registry import QUERIES

MOVED = re.compile(r"hashpartitioning\(uid#\d+L, (part#\d+, )?time#")


def _tables(spark, cfg):
    at = "Wed Jan 03 10:00:{:02} +0000 2024"
    values = [tweet_json(t, t % 4, at.format(t % 7)) for t in range(1, 60)]
    values += values[:5] + [tweet_json(9, 2, at.format(1))]                        # delivered again, and one id twice
    edges = [(u, f) for u in (0, 1, 2) for f in (*range(10, 30), 11)] + [(1, None), (None, 7)]      # 3 has no followers
    df = spark.createDataFrame(edges, "uid bigint, follower bigint")
    return batch.timeline_rows(ingest(raw_df(spark, values), cfg), df.distinct() if cfg.store == "set" else df, cfg, once=True)


def _rows(df, *columns):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


@pytest.mark.parametrize("way", [{"store": "list"}, {"broadcast_bytes": 400}, {"skew_split_rows": 20}, {"broadcast_bytes": 1}],
                         ids=["whole", "sliced", "split", "shuffled"])
def test_inboxes_are_the_same_however_they_are_made(spark, way):
    cfg, as_of = FeedConfig(**way), "2024-01-10 10:00:03"
    tables = _tables(spark, cfg)
    placed = tables.placed().select("uid", "time", "tid", J.PART).collect()
    assert sorted(str(tuple(r)[:3]) for r in placed) == sorted(str(tuple(r)) for r in tables["inboxes"].select("uid", "time", "tid").collect())
    parts = {}
    for r in placed:                                       # split by time only
        assert parts.setdefault((r["uid"], r["time"]), r[J.PART]) == r[J.PART]
    assert len({v for (uid, _), v in parts.items() if uid == 10}) > 1 or "skew_split_rows" not in way
    got, want = batch.resolved_view(tables, cfg, as_of)["inboxes"], T.resolve("inboxes", tables["inboxes"], cfg, as_of)
    assert got.columns == want.columns and _rows(got) == _rows(want) and got.count() > 0


def test_no_row_of_a_receiver_moves(spark):
    for rows in (batch.resolved_tables(spark, SF_SMALL, FeedConfig(), None)["inboxes"],
                 QUERIES["upsert_uid_time"](spark, SF_SMALL), QUERIES["ttl_visible"](spark, SF_SMALL)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not MOVED.search(plan) and re.search(r"hashpartitioning\(follower#\d+L, part#", plan)
