"""Parse raw tweet JSON into typed columns and classify malformed records.

All work is built-in column expressions (whole-stage codegen); untrusted
input goes through ``try_*`` casts so a bad record never fails a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.config import STORE_TIME_FORMAT, TWITTER_TIME_FORMAT, FeedConfig
from feedloom.schemas import CORRUPT_COL, ENTITIES, TWEET, TWEET_TEXTS, USER

# Spark >= 3 rejects the day-of-week field when parsing, so the weekday is
# checked by this expression and the rest parsed with this pattern.
_WEEKDAY = r"(?i)^(mon(day)?|tue(sday)?|wed(nesday)?|thu(rsday)?|fri(day)?|sat(urday)?|sun(day)?) "
_PARSE_PATTERN = TWITTER_TIME_FORMAT.split(" ", 1)[1]

# Fixed dead-letter reasons, in the order they are tested.
REASONS = ("malformed_json", "missing_id", "bad_id", "missing_created_at",
           "bad_created_at", "missing_user", "missing_user_id", "bad_user_id")


def parse_texts(value: Column) -> Column:
    """P1. The record's top-level fields as text; the raw text of a record that
    is not a JSON object lands in ``_corrupt``."""
    return F.from_json(value, TWEET_TEXTS, {"columnNameOfCorruptRecord": CORRUPT_COL})


def parse_json(value: Column) -> Column:
    """Struct of the tweet fields of a valid record.  Without options Catalyst
    prunes the parsed schema to the fields actually used."""
    return F.from_json(value, TWEET)


def to_long(s: Column) -> Column:
    """P2/P3/J7. Decimal string -> BIGINT, null when not a number."""
    return s.try_cast("bigint")


def parse_created_at(s: Column) -> Column:
    """P4. 'EEE MMM dd HH:mm:ss Z yyyy' (any offset) -> TIMESTAMP_NTZ in UTC.

    The weekday must be one, in short or full form.  The parsed instant is taken
    as seconds since the epoch, so the session time zone has no part in it."""
    rest = F.when(s.rlike(_WEEKDAY), F.regexp_replace(s, _WEEKDAY, ""))
    return utc_time(F.unix_seconds(F.try_to_timestamp(rest, F.lit(_PARSE_PATTERN))))


def utc_time(seconds: Column) -> Column:
    """Seconds since the epoch -> TIMESTAMP_NTZ in UTC, whatever the session zone."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def format_store_time(ts_utc: Column) -> Column:
    """P4 (second half). UTC TIMESTAMP_NTZ -> 'yyyy-MM-dd HH:mm:ss+0000'."""
    return F.date_format(ts_utc, STORE_TIME_FORMAT.replace("Z", "'+0000'"))


def fold_user(uid_raw: Column, n_users: int) -> Column:
    """P5. Map real user ids onto n simulated users (non-negative modulus)."""
    return F.pmod(uid_raw, F.lit(n_users).cast("bigint"))


def parse_raw(raw: DataFrame, cfg: FeedConfig = FeedConfig(), keep: list[str] | None = None) -> DataFrame:
    """P1-P6 in one projection over ``value``: typed fields plus ``reason``
    (null for a valid record).  Parse happens once; callers split on reason.
    ``keep``: columns of the source that go along."""
    keep = keep or []
    # Parse through a one-row Generate: filters on parsed fields (reason,
    # lang) then stay above it, instead of being pushed below the projection
    # with from_json inlined once per referenced field.
    p = raw.select("value", *keep, F.explode(F.array(parse_texts(F.col("value")))).alias("j"))
    p = p.select("value", *keep, "j", F.explode(F.array(F.struct(
        F.from_json("j.user", USER).alias("user"), F.from_json("j.entities", ENTITIES).alias("entities")))).alias("k"))
    tid = to_long(F.col("j.id_str"))
    time = parse_created_at(F.col("j.created_at"))
    uid_raw = to_long(F.col("k.user.id_str"))
    reason = (F.when(F.col("j").isNull() | F.col(f"j.{CORRUPT_COL}").isNotNull(), F.lit(REASONS[0]))
               .when(F.col("j.id_str").isNull(), F.lit(REASONS[1]))
               .when(tid.isNull(), F.lit(REASONS[2]))
               .when(F.col("j.created_at").isNull(), F.lit(REASONS[3]))
               .when(time.isNull(), F.lit(REASONS[4]))
               .when(F.col("j.user").isNull() | ~F.col("j.user").startswith("{"), F.lit(REASONS[5]))
               .when(F.col("k.user.id_str").isNull(), F.lit(REASONS[6]))
               .when(uid_raw.isNull(), F.lit(REASONS[7])))
    return p.select(
        F.col("value"),
        tid.alias("tid"),
        uid_raw.alias("uid_raw"),
        fold_user(uid_raw, cfg.n_users).alias("uid"),
        time.alias("time"),
        F.col("j.created_at").alias("created_at"),
        F.col("j.lang").alias("lang"),
        F.col("j.text").alias("text"),
        F.col("k.user.name").alias("author_name"),
        F.col("k.user.screen_name").alias("author_screen_name"),
        F.col("k.entities.hashtags.text").alias("hashtags"),
        reason.alias("reason"),
        *keep,
    )


def valid_tweets(parsed: DataFrame) -> DataFrame:
    """Valid records as the tweet frame the fan-out works on."""
    return parsed.filter(F.col("reason").isNull()).drop("reason").withColumnRenamed("value", "tweet")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """P6. Records the reference would have crashed on, with why."""
    return parsed.filter(F.col("reason").isNotNull()).select("value", "reason")


def filter_language(tweets: DataFrame, lang: str | None) -> DataFrame:
    """S5. Keep one language (the capture side's language filter)."""
    return tweets if lang is None else tweets.filter(F.col("lang") == lang)


def ingest(raw: DataFrame, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Raw JSON -> valid tweets in the configured language."""
    return filter_language(valid_tweets(parse_raw(raw, cfg)), cfg.language)
