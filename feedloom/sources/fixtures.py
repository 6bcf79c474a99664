"""Inputs of the timeline system derived from the given test tables.

The rules are fixed so an independent SQL oracle can recompute every result
from the base columns:

* raw tweet  - one JSON string per event: id_str = event_id; created_at = ts
  (UTC, to the second) rendered "EEE MMM dd HH:mm:ss +0000 yyyy"; lang and
  whole text from documents where doc_id = event_id mod (number of documents);
  retweet_count = event_id mod 100 (no operator reads it); user.id_str = user_id + 100000 * (event_id mod 7), so folding by
  n = 100000 gives user_id back; user.name = c_name of c_custkey = user_id
  (absent when none); user.screen_name = 'u' || user_id; hashtags by
  event_id mod 3: 0 none, 1 [event_type], 2 [event_type, 'k' || props.k].
* edges      - (uid = l_suppkey, follower = o_custkey) of every line item and its
  order; distinct for the set store, as joined (duplicates kept) for the list
  store.
* users      - every c_custkey.
* usernames  - (s_suppkey, s_name): suppliers have names, other users do not.
* requests   - the users who caused an event, with n = 0 (home timeline), or with
  a mix of page requests for the paged read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.config import TWITTER_TIME_FORMAT
from feedloom.sources.tables import read_table

# Fixed values of the fixture rules.
USER_ID_SPREAD = 100_000      # user.id_str = user_id + USER_ID_SPREAD * (event_id mod 7)
USER_ID_COPIES = 7
RETWEET_COUNTS = 100
ODD_ENTITIES = ('"none"', '[1,2]', '{"hashtags":"x"}', '{"hashtags":["x","y"]}')
PAGE_REQUESTS = (0, 45, 49, 50, 60)   # n by uid mod 5 for the paged read


def _created_at(ts: Column) -> Column:
    # ts is TIMESTAMP_NTZ holding UTC wall-clock time; render with a +0000 offset.
    return F.date_format(ts, TWITTER_TIME_FORMAT.replace("Z", "'+0000'"))


def _hashtags(event_id: Column, event_type: Column, props: Column) -> Column:
    tag = lambda c: F.struct(c.alias("text"))
    k = F.concat(F.lit("k"), F.get_json_object(props, "$.k"))
    return (F.when(event_id % 3 == 1, F.array(tag(event_type)))
             .when(event_id % 3 == 2, F.array(tag(event_type), tag(k)))
             .otherwise(F.array().cast("array<struct<text:string>>")))


def tweet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events joined to their author name and document (one row per event).

    The name comes first: what is shuffled by user is the narrow event, not its text."""
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    docs_scan = read_table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    n_docs = docs_scan.select(F.count(F.lit(1))).scalar()   # scalar subquery, no cross join
    names = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    ev = events.withColumn("doc_key", F.col("event_id") % n_docs)
    # a record is made and parsed where event and text meet: as many tasks as there are shuffle
    # partitions, not as few as the narrow events would fill
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (ev.join(names, ev.user_id == names.c_custkey, "left").repartition(n, "doc_key")
              .join(docs_scan, F.col("doc_key") == docs_scan.doc_id, "inner")
              .select("event_id", "ts", "user_id", "event_type", "props", "lang", "text", "c_name"))


def raw_tweets(spark: SparkSession, sf_dir: str, keep_ts: bool = False) -> DataFrame:
    """value STRING: the raw JSON feed, one record per event (``keep_ts``
    also returns the event time, to cut the feed into deliveries)."""
    t = tweet_rows(spark, sf_dir)
    author = F.col("user_id") + F.lit(USER_ID_SPREAD) * (F.col("event_id") % USER_ID_COPIES)
    tweet = F.struct(
        F.col("event_id").cast("string").alias("id_str"),
        _created_at(F.col("ts")).alias("created_at"),
        F.col("lang"),
        F.col("text"),
        F.struct(author.cast("string").alias("id_str"),
                 F.col("c_name").alias("name"),
                 F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("screen_name")).alias("user"),
        F.struct(_hashtags(F.col("event_id"), F.col("event_type"), F.col("props")).alias("hashtags"))
         .alias("entities"),
        (F.col("event_id") % RETWEET_COUNTS).alias("retweet_count"),
    )
    return t.select(F.to_json(tweet).alias("value"), *(["ts"] if keep_ts else []))


def dirty_raw_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed, one damaged copy of every record, and one with odd optional
    fields (entities as text, a list, tags as text or plain strings), which is valid.

    The damage kind is chosen by event_id mod 6: 0 cut JSON, 1 delete notice,
    2 no user, 3 non-numeric id_str, 4 unparsable created_at, 5 non-numeric
    user.id_str.  Every original record is kept as is.
    """
    raw = raw_tweets(spark, sf_dir)
    eid = F.get_json_object("value", "$.id_str")
    kind = F.pmod(eid.cast("bigint"), F.lit(6))
    j = F.from_json("value", "id_str string, created_at string, lang string, text string, "
                             "user struct<id_str:string,name:string,screen_name:string>, "
                             "entities struct<hashtags:array<struct<text:string>>>")
    damaged = (raw.select(kind.alias("kind"), eid.alias("eid"), F.col("value"), j.alias("j"))
               .select(F.when(F.col("kind") == 0, F.substring("value", 1, 25))
                        .when(F.col("kind") == 1, F.to_json(F.struct(F.struct(F.struct(
                              F.col("eid").alias("id_str")).alias("status")).alias("delete"))))
                        .when(F.col("kind") == 2, F.to_json(F.col("j").dropFields("user")))
                        .when(F.col("kind") == 3, F.to_json(F.col("j").withField(
                              "id_str", F.concat(F.lit("x"), F.col("eid")))))
                        .when(F.col("kind") == 4, F.to_json(F.col("j").withField(
                              "created_at", F.lit("yesterday"))))
                        .otherwise(F.to_json(F.col("j").withField(
                              "user.id_str", F.lit("anonymous"))))
                        .alias("value")))
    odd = raw.select(F.concat(F.regexp_extract("value", r'(?s)^(.*),"entities":', 1), F.lit(',"entities":'),
                              F.element_at(F.array(*[F.lit(x) for x in ODD_ENTITIES]),
                                           (F.pmod(eid.cast("bigint"), F.lit(len(ODD_ENTITIES))) + 1).cast("int")),
                              F.lit("}")).alias("value"))
    return raw.unionByName(damaged).unionByName(odd)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    od = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner")


def edges(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    """Follower edges (uid follows-by follower): distinct pairs, or as joined."""
    e = _order_lines(spark, sf_dir).select(F.col("l_suppkey").alias("uid"), F.col("o_custkey").alias("follower"))
    return e.distinct() if distinct else e


def dated_edges(spark: SparkSession, sf_dir: str, order_cond) -> DataFrame:
    """Distinct edges of the orders matching ``order_cond`` (follows made in a period)."""
    return (_order_lines(spark, sf_dir).filter(order_cond)
            .select(F.col("l_suppkey").alias("uid"), F.col("o_custkey").alias("follower")).distinct())


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("uid"))


def usernames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, uname) of the users who have a name: the suppliers."""
    return read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(
        F.col("s_suppkey").alias("uid"), F.col("s_name").alias("uname"))


def requests(spark: SparkSession, sf_dir: str, n: int = 0) -> DataFrame:
    """(uid, n): every user who caused an event asks for the default page (n rows requested)."""
    seen = read_table(spark, sf_dir, "events", "user_id").select(F.col("user_id").alias("uid")).distinct()
    return seen.select("uid", F.lit(n).cast("int").alias("n"))


def paged_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, n) with n taken from PAGE_REQUESTS by uid mod 5 (different per user)."""
    pick = F.element_at(F.array(*[F.lit(v) for v in PAGE_REQUESTS]),
                        (F.pmod(F.col("uid"), F.lit(len(PAGE_REQUESTS))) + 1).cast("int"))
    return requests(spark, sf_dir).select("uid", pick.cast("int").alias("n"))
