"""Render stored tweets for a timeline (V1-V5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.config import LOCAL_TIME_FORMAT, FeedConfig
from feedloom.functions.parse import parse_created_at
from feedloom.functions.payload import TAGS, as_payload, field


def local_time(ts_utc: Column, tz: str) -> Column:
    """V2. UTC wall-clock -> local wall-clock (DST by zone rules), formatted."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts_utc), LOCAL_TIME_FORMAT)


def join_hashtags(tags: Column) -> Column:
    """V3. Tag texts joined by ', '; null (not '') when there are none."""
    return F.nullif(F.array_join(tags, ", "), F.lit(""))


def profile_url(screen_name: Column, prefix: str) -> Column:
    """V5."""
    return F.concat(F.lit(prefix), screen_name)


def render(df: DataFrame, payload_col: str = "tweet", cfg: FeedConfig = FeedConfig(),
           keep: tuple[str, ...] = ()) -> DataFrame:
    """V1-V3, V5 over a column of stored payloads (or raw records): fields taken from the VARIANT."""
    p = df.select(*keep, as_payload(df, payload_col).alias("p"))
    get = lambda path, kind="string": field(F.col("p"), path, kind)
    return p.select(
        *keep,
        local_time(parse_created_at(get("created_at")), cfg.local_tz).alias("local_time"),
        get("text").alias("text"),
        get("user.name").alias("author_name"),
        get("user.screen_name").alias("author_screen_name"),
        join_hashtags(get("entities.hashtags", TAGS)["text"]).alias("hashtags"),
        profile_url(get("user.screen_name"), cfg.profile_prefix).alias("profile_url"),
    )
