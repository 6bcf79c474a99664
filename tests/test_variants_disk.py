"""The four variants: a payload moves with its tweet only, and a variant leaves the disks when it is counted."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, raw_df, tweet_json
from feedloom.config import FeedConfig
from feedloom.functions.parse import ingest
from feedloom.plans import batch
from feedloom.plans.registry import QUERIES
from feedloom.sources import tables

DENORM = FeedConfig(layout="denorm")


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def test_receivers_rows_do_not_move_to_payloads(spark):
    rows = batch.batch_tables(spark, SF_SMALL, DENORM)["feedslists"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [uid") == 2       # tweets and edges, by author
    assert "RepartitionByExpression [tid" not in plan


@pytest.mark.parametrize("split", [20, 2_000_000], ids=["split", "whole"])
@pytest.mark.parametrize("store", ["set", "list"])
def test_rows_are_those_that_are_stored(spark, split, store):
    cfg = DENORM.with_(store=store, skew_split_rows=split)
    at = "Wed Jan 03 10:00:0{} +0000 2024"
    values = [tweet_json(t, t % 3, at.format(t % 2), text=f"text {t}") for t in range(1, 10)]
    values += values[:2] + [tweet_json(1, 1, at.format(1), text="another version")]
    edges = spark.createDataFrame([(u, f) for u in (0, 1) for f in (*range(1, 30), 5)], "uid bigint, follower bigint")
    edges = edges.distinct() if store == "set" else edges
    feeds = [batch.timeline_rows(ingest(raw_df(spark, values), cfg), edges, cfg, once=True, stored=stored)["feedslists"]
             for stored in (True, False)]
    want, got = (sorted(map(tuple, f.withColumn("tweet", F.to_json("tweet")).collect())) for f in feeds)
    assert got == want and len(got) == 8 * 30


def test_a_counted_variant_leaves_the_disks(spark, monkeypatch):
    real, left = batch.batch_tables, []
    had = _shuffle_files(spark)

    def seen(*args):
        left.append(len(_shuffle_files(spark) - had))
        return real(*args)

    monkeypatch.setattr(batch, "batch_tables", seen)
    was = spark.conf.get(tables.DROP_SHUFFLES)
    out = QUERIES["fanout_variants"](spark, SF_SMALL)
    assert left == [0] * 4 and not _shuffle_files(spark) - had
    assert spark.conf.get(tables.DROP_SHUFFLES) == was
    assert out.count() == 4
