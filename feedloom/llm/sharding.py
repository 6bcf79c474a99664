"""Sharding by extendible hashing.

A document's bucket is a prefix of the bits of a hash of its doc_id.  The
directory starts with one bucket (no bits).  A bucket that holds more bytes than
``max_bytes`` splits on the next bit, and only such buckets split, until every
shard fits; so shards of crowded prefixes are deep and the others shallow.

The directory is worked out on sizes, not on rows: one pass sums bytes per
prefix of ``step`` bits, the sums of all shorter prefixes follow from these, and
a prefix of the full depth that still is too large takes part in a next round
with ``step`` more bits.  A row belongs to its shortest prefix that fits.

One document larger than ``max_bytes``, or rows whose whole hash is equal, cannot
be split; they form a shard of the full depth, marked ``oversized``.

Defined cases: null doc_id hashes as the empty text; null text has 0 bytes; rows
with equal doc_id share a shard; an empty table gives no rows.  Other columns
are not read; ``write_shards`` writes them all."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import cut

HASH_BITS = 60
MAX_BYTES = 1 << 20


def hash_bits(doc_id: Column) -> Column:
    """HASH_BITS bits as a string of 0 and 1: the first hex digits of the MD5 of doc_id as text."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), HASH_BITS, "0")


def directory(spark: SparkSession, sized: DataFrame, max_bytes: int, step: int | None = None) -> DataFrame:
    """(shard, bytes, docs, oversized) of the buckets that hold rows; shard is the bit prefix.

    sized: (bits, bytes), one row per document."""
    if step is None:
        total = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        step = max(1, math.ceil(math.log2(max(1, total / max_bytes))) + 3)
    open_, depth, done = sized, 0, []
    while True:
        deeper = min(HASH_BITS, depth + step)
        fine = open_.groupBy(F.substring("bits", 1, deeper).alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
        fine = cut(spark, fine, "shard-sizes")
        level = F.explode(F.sequence(F.lit(depth), F.lit(deeper)))
        sizes = (fine.withColumn("d", level)
                 .groupBy(F.expr("substring(prefix, 1, d)").alias("shard"), "d")
                 .agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")))
        last = deeper == HASH_BITS
        fits = (F.col("bytes") <= max_bytes) | (F.lit(last) & (F.col("d") == deeper))
        sizes = sizes.withColumn("fits", fits)
        # a bucket is final when it fits and the one above it does not
        above = sizes.filter(~F.col("fits")).select(F.col("shard").alias("up"), F.col("d").alias("up_d"))
        ok = sizes.filter("fits")
        top = ok.filter(F.col("d") == depth) if depth == 0 else ok.limit(0)
        below = ok.join(above, (F.expr("substring(shard, 1, d - 1)") == F.col("up")) & (F.col("d") - 1 == F.col("up_d")))
        final = top.select("shard", "bytes", "docs").unionByName(below.select("shard", "bytes", "docs"))
        done.append(cut(spark, final.withColumn("oversized", F.col("bytes") > max_bytes), "shard-directory"))
        left = sizes.filter((F.col("d") == deeper) & ~F.col("fits")).select(F.col("shard").alias("prefix"))
        if last or left.isEmpty():
            break
        open_ = (sized.withColumn("prefix", F.substring("bits", 1, deeper))
                 .join(cut(spark, left, "shard-open"), "prefix", "left_semi").select("bits", "bytes"))
        depth = deeper
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def shard_of(rows: DataFrame, buckets: DataFrame, bits: Column) -> DataFrame:
    """``rows`` with the columns of their bucket: one equi-join per depth in use, as one."""
    depths = [r[0] for r in buckets.select(F.length("shard")).distinct().collect()]     # at most HASH_BITS + 1
    if not depths:
        return rows.withColumn("shard", F.lit("")).join(buckets, "shard")
    named = rows.withColumn("_bits", bits)
    # buckets are disjoint, so exactly one prefix of a row is in the directory
    low = min(depths)
    key = F.substring("_bits", 1, low) if low else F.lit("")
    if len(depths) == 1:
        return named.withColumn("shard", key).drop("_bits").join(buckets, "shard")
    # the directory by its shortest depth: a short list of the buckets below each prefix
    fan = buckets.groupBy(F.substring("shard", 1, low).alias("_low")).agg(
        F.collect_list(F.struct("shard", "bytes", "docs", "oversized")).alias("_below"))
    pick = F.element_at(F.filter("_below", lambda b: F.col("_bits").startswith(b["shard"])), 1)
    return (named.withColumn("_low", key).join(fan, "_low").withColumn("_b", pick)
            .select(*rows.columns, "_b.*"))


def extendible_shards(spark: SparkSession, docs: DataFrame, max_bytes: int = MAX_BYTES,
                      step: int | None = None) -> DataFrame:
    """doc_id, n_bytes, shard, shard_bytes, shard_docs, oversized of every row."""
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    rows = cut(spark, rows.withColumn("bits", hash_bits(F.col("doc_id"))), "shard-rows")
    buckets = directory(spark, rows.select("bits", F.col("n_bytes").alias("bytes")), max_bytes, step)
    found = shard_of(rows, buckets, F.col("bits"))
    return found.select("doc_id", "n_bytes", "shard", F.col("bytes").alias("shard_bytes"),
                        F.col("docs").alias("shard_docs"), "oversized")


def write_shards(spark: SparkSession, docs: DataFrame, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Write ``docs`` as one Parquet folder per shard; returns the directory.

    The folders are named by ``shard_bits`` (with underscores behind it where ``docs`` has a
    column of that name)."""
    name = "shard_bits"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    sized = docs.select(hash_bits(F.col("doc_id")).alias("bits"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    buckets = cut(spark, directory(spark, sized, max_bytes), "shard-all")
    placed = shard_of(docs.select(F.struct(*docs.columns).alias("_doc")), buckets, hash_bits(F.col("_doc.doc_id")))
    (placed.select(F.concat(F.lit("p"), "shard").alias(name), *[F.col("_doc")[c].alias(c) for c in docs.columns])
     .repartition(name).write.partitionBy(name).parquet(path))
    return buckets
