"""Fixed schemas of the raw record and of the stores."""

from pyspark.sql import types as T

CORRUPT_COL = "_corrupt"

HASHTAG = T.StructType([T.StructField("text", T.StringType())])

USER = T.StructType([
    T.StructField("id_str", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("screen_name", T.StringType()),
])

# Every field any part of the system reads from a raw tweet.
TWEET = T.StructType([
    T.StructField("id_str", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("user", USER),
    T.StructField("entities", T.StructType([
        T.StructField("hashtags", T.ArrayType(HASHTAG)),
    ])),
])

# Ingest parse: top-level fields as text, so that one odd optional field cannot
# spoil the record; user and entities are parsed from their own text.
TWEET_TEXTS = T.StructType([T.StructField(f.name, T.StringType()) for f in TWEET.fields]
                           + [T.StructField(CORRUPT_COL, T.StringType())])
ENTITIES = TWEET["entities"].dataType

# Stored table layouts (key columns first); every stored row also carries
# ingest_ts, expire_at and batch_id.  tweet is the payload (VARIANT), tweet_hash
# a hash of the raw record: it names a version of the payload and orders them.
STORE_TABLES = {
    "tweets": ("tid", "tweet", "tweet_hash"),
    "homepages": ("uid", "time", "tid"),
    "inboxes": ("uid", "time", "tid"),
    "historytweets": ("uid", "time", "tid", "tweet", "tweet_hash"),
    "feedslists": ("uid", "time", "tid", "tweet", "tweet_hash"),
}
