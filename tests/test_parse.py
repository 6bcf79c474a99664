import datetime as dt

from pyspark.sql import functions as F

from conftest import raw_df, tweet_json
from feedloom.config import FeedConfig
from feedloom.functions import parse as P
from feedloom.functions.render import render

CFG = FeedConfig(n_users=100_000)


def _parse(spark, values):
    return {r["value"]: r for r in P.parse_raw(raw_df(spark, values), CFG).collect()}


def test_dead_letter_reasons(spark):
    good = tweet_json(1, 7, "Mon Jan 01 00:00:07 +0000 2024")
    cases = {
        "not json": "malformed_json",
        '{"delete":{"status":{"id_str":"5"}}}': "missing_id",
        '{"id_str":"x1","created_at":"Mon Jan 01 00:00:07 +0000 2024","user":{"id_str":"1"}}': "bad_id",
        '{"id_str":"2","user":{"id_str":"1"}}': "missing_created_at",
        '{"id_str":"3","created_at":"yesterday","user":{"id_str":"1"}}': "bad_created_at",
        '{"id_str":"4","created_at":"Mon Jan 01 00:00:07 +0000 2024"}': "missing_user",
        '{"id_str":"5","created_at":"Mon Jan 01 00:00:07 +0000 2024","user":{}}': "missing_user_id",
        '{"id_str":"6","created_at":"Mon Jan 01 00:00:07 +0000 2024","user":{"id_str":"bob"}}': "bad_user_id",
        "[1,2]": "malformed_json",
    }
    got = _parse(spark, [good, *cases])
    assert got[good]["reason"] is None
    for v, reason in cases.items():
        assert got[v]["reason"] == reason, v
    dl = P.dead_letters(P.parse_raw(raw_df(spark, [good, *cases]), CFG)).collect()
    assert sorted(r["reason"] for r in dl) == sorted(cases.values())
    assert P.valid_tweets(P.parse_raw(raw_df(spark, [good, *cases]), CFG)).count() == 1


def test_offset_and_fold(spark):
    a = tweet_json(10, 100_007, "Sun Jul 07 10:00:00 -0500 2024")
    b = tweet_json(11, 7, "Sun Jul 07 15:00:00 +0000 2024")
    got = _parse(spark, [a, b])
    assert got[a]["time"] == got[b]["time"] == dt.datetime(2024, 7, 7, 15, 0, 0)
    assert got[a]["uid"] == got[b]["uid"] == 7
    assert got[a]["uid_raw"] == 100_007


def test_timestamp_independent_of_session_zone(spark):
    a = tweet_json(12, 1, "Mon Jan 01 00:00:07 +0000 2024")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        t = P.parse_raw(raw_df(spark, [a]), CFG).select("time").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert t == dt.datetime(2024, 1, 1, 0, 0, 7)


def test_render_local_time_dst_and_tags(spark):
    rows = {
        # winter (EST, UTC-5) and summer (EDT, UTC-4)
        tweet_json(1, 1, "Mon Jan 15 12:00:00 +0000 2024", tags=("a", "b")): "Mon Jan 15 07:00:00",
        tweet_json(2, 1, "Mon Jul 15 12:00:00 +0000 2024"): "Mon Jul 15 08:00:00",
        # both sides of the spring change (2024-03-10 07:00 UTC)
        tweet_json(3, 1, "Sun Mar 10 06:59:59 +0000 2024"): "Sun Mar 10 01:59:59",
        tweet_json(4, 1, "Sun Mar 10 07:00:00 +0000 2024"): "Sun Mar 10 03:00:00",
        # and the autumn one (2024-11-03 06:00 UTC)
        tweet_json(5, 1, "Sun Nov 03 05:59:59 +0000 2024"): "Sun Nov 03 01:59:59",
        tweet_json(6, 1, "Sun Nov 03 06:00:00 +0000 2024"): "Sun Nov 03 01:00:00",
    }
    df = raw_df(spark, list(rows)).withColumnRenamed("value", "tweet")
    out = {r["tid"]: r for r in render(df.withColumn("tid", F.get_json_object("tweet", "$.id_str")),
                                       "tweet", CFG, keep=("tid",)).collect()}
    for v, local in rows.items():
        tid = __import__("json").loads(v)["id_str"]
        assert out[tid]["local_time"] == local
    assert out["1"]["hashtags"] == "a, b"
    assert out["2"]["hashtags"] is None          # empty list -> null, not ''
    assert out["1"]["profile_url"] == "https://twitter.com/a"


def test_language_filter(spark):
    vals = [tweet_json(1, 1, "Mon Jan 01 00:00:07 +0000 2024", lang="en"),
            tweet_json(2, 1, "Mon Jan 01 00:00:07 +0000 2024", lang="fr")]
    assert [r["tid"] for r in P.ingest(raw_df(spark, vals), CFG).collect()] == [1]
    assert P.ingest(raw_df(spark, vals), CFG.with_(language=None)).count() == 2


def test_odd_optional_fields_do_not_reject(spark):
    head = '{"id_str":"%d","created_at":"Mon Jan 01 00:00:07 +0000 2024","user":{"id_str":"1"},"entities":'
    odd = [head % i + x + "}" for i, x in enumerate(
        ['"none"', "[1,2]", '{"hashtags":"x"}', '{"hashtags":["x","y"]}', "null", "7"])]
    got = _parse(spark, odd)
    for v in odd:
        assert got[v]["reason"] is None and not [t for t in got[v]["hashtags"] or [] if t], v
    bad = [(head % 9).replace('{"id_str":"1"}', u) + "{}}" for u in ('"bob"', "[1]", "5")]
    assert {r["reason"] for r in _parse(spark, bad).values()} == {"missing_user"}


def test_overlap_hour_in_a_session_zone_with_summer_time(spark):
    a = tweet_json(13, 1, "Sun Nov 03 06:30:00 +0000 2024")
    b = tweet_json(14, 1, "Sun Nov 03 01:30:00 -0400 2024")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r["tid"]: r["time"] for r in P.parse_raw(raw_df(spark, [a, b]), CFG).select("tid", "time").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {13: dt.datetime(2024, 11, 3, 6, 30), 14: dt.datetime(2024, 11, 3, 5, 30)}


def test_weekday_is_checked(spark):
    times = {"XYZ Jan 16 10:00:00 +0000 2024": "bad_created_at", "0000Jan 16 10:00:00 +0000 2024": "bad_created_at",
             "Jan 16 10:00:00 +0000 2024": "bad_created_at", "Tue Jan 16 10:00:00 +0000 2024": None,
             "Tuesday Jan 16 10:00:00 +0000 2024": None}
    got = _parse(spark, [tweet_json(i, 1, t) for i, t in enumerate(times)])
    assert {r["created_at"]: r["reason"] for r in got.values()} == times


def test_unread_fields_survive_publishing(spark):
    from feedloom.session import scratch_path
    from feedloom.sources import ingest
    value = tweet_json(15, 1, "Mon Jan 01 00:00:07 +0000 2024")[:-1] + ', "retweet_count": 7}'
    path = scratch_path(spark, "t-raw")
    ingest.publish_text(raw_df(spark, [value]), path)
    assert [r[0] for r in ingest.read_text(spark, path).collect()] == [value]


def test_topic_options():
    from feedloom.sources.ingest import topic_options
    assert topic_options("h:1", "a,b", max_offsets_per_trigger=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5"}
