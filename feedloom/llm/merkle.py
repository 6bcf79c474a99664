"""Merkle manifest of a dataset: a digest a row, a tree a group, a tree over groups.

A leaf is the digest of a row's columns.  Per group, leaves stand in the order
of a key; while several nodes remain, each run of ``FAN`` consecutive ones (the
last run may be shorter, even a single node) becomes the digest of its digests.
What remains is the group's root, and the groups' roots, in the order of the
group, are folded the same way into the root of the dataset.

Method: rows get their place in the group and are dealt into blocks of
FAN ** LEVELS consecutive places.  Inside a block the node of level l stands on
the row of its first leaf, so its neighbours stand a fixed number of rows away:
lag and lead by d * FAN ** l, masked by the node's slot in its run and by the
run's length, give its siblings, and the first child of a run hashes the parent.
All levels of a block share one partitioning and one sort; a last window hands
every leaf the siblings of its ancestors.  The blocks' roots are the leaves of
the next round, so a group of any size takes log(n) / LEVELS rounds, and no task
ever holds more than FAN ** LEVELS rows of a group.

Places come from a range partitioning over (group, key, leaf), numbered by the
rows of each range; a group, or a key that many rows share, may span any number
of ranges (equal rows are told apart by where they were read, which changes no
digest).

Defined cases: a null column is ``-``, a null group is a group of its own before
all others, rows with a null key come first in their group; rows with equal keys
stand in the order of their leaves, repeated rows are leaves of their own; an
empty table gives no rows; a lone leaf is its group's root and has no siblings;
columns beyond those named are not read, and those carried keep their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import cut

FAN, LEVELS = 2, 10
PATH = "array<struct<before:string,after:string>>"


def leaf(*columns: Column) -> Column:
    """Digest of a row: each value as ``-`` if null, else its UTF-8 byte count, ``:``, the value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(part, columns)).cast("binary"), 256)


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def numbered(spark: SparkSession, rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with _pos (from 0, in ``order`` within _g) and _n (rows of _g)."""
    there = (rows.withColumn("_at", F.monotonically_increasing_id())
             .repartitionByRange("_g", *order, "_at").withColumn("_range", F.spark_partition_id()))
    there = cut(spark, there, f"{label}-ranges")       # the ranges are settled here
    sizes = there.groupBy("_g", "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy("_g").orderBy("_range")     # one row a range
    starts = sizes.select(
        "_g", "_range", (F.sum("_rows").over(before) - F.col("_rows")).alias("_start"),
        F.sum("_rows").over(W.partitionBy("_g")).alias("_n"))
    local = F.row_number().over(W.partitionBy("_g", "_range").orderBy(*order, "_at"))
    return (there.withColumn("_local", local).join(starts, ["_g", "_range"])
            .withColumn("_pos", F.col("_start") + F.col("_local") - 1)
            .drop("_at", "_range", "_local", "_start"))


def block_levels(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """Nodes (_g, _pos, _n, _h, ...) with _block, _i (place in it), _path (siblings inside the
    block, from the bottom) and, on the row with _i = 0, _up (root of the block)."""
    size = fan ** levels
    w = W.partitionBy("_g", "_block").orderBy("_i")
    df = (nodes.withColumn("_block", F.floor(F.col("_pos") / size).cast("long"))
          .withColumn("_i", (F.col("_pos") % size).cast("int"))
          .repartition("_g", "_block"))
    h, found = "_h", []
    for level in range(levels):
        step = fan ** level
        node, slot = F.col("_i") % step == 0, F.floor(F.col("_i") / step) % fan
        several = F.col("_n") > step                   # more than one node remains on this level
        near = [f"_{side}{d}" for d in range(1, fan) for side in ("lag", "lead")]
        for d in range(1, fan):
            df = df.withColumns({f"_lag{d}": F.lag(h, d * step).over(w), f"_lead{d}": F.lead(h, d * step).over(w)})
        before = F.concat(F.lit(""), *[F.when(slot >= d, F.col(f"_lag{d}")).otherwise("") for d in range(fan - 1, 0, -1)])
        after = F.concat(F.lit(""), *[F.when(slot + d < fan, F.coalesce(f"_lead{d}", F.lit(""))).otherwise("")
                                      for d in range(1, fan)])
        up, kin = f"_h{level + 1}", f"_kin{level}"
        df = df.withColumns({
            kin: F.when(node & several, F.struct(before.alias("before"), after.alias("after"))),
            up: F.when(node & (slot == 0), F.when(several, _digest(F.concat(F.col(h), after))).otherwise(F.col(h))),
        }).drop(*near, *([h] if level else []))
        h = up
        found.append(kin)
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    df = df.withColumns({k: F.last(k, ignorenulls=True).over(so_far) for k in found})
    return (df.withColumn("_path", F.filter(F.array(*found), lambda x: x.isNotNull()).cast(PATH))
            .withColumnRenamed(h, "_up").drop(*found))


def _forest(spark: SparkSession, nodes: DataFrame, fan: int, levels: int, label: str) -> list[DataFrame]:
    """Rounds of ``block_levels``, written tables, until every group has one block."""
    rounds = []
    while True:
        table = cut(spark, block_levels(nodes, fan, levels), f"{label}-round{len(rounds)}")
        rounds.append(table)
        top = table.agg(F.max("_block")).first()[0]
        if not top:
            return rounds
        size = fan ** levels
        nodes = table.filter("_i = 0").select("_g", F.col("_block").alias("_pos"),
                                              F.ceil(F.col("_n") / size).cast("long").alias("_n"), F.col("_up").alias("_h"))


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """(_g, _top): the root of each group."""
    return rounds[-1].filter("_i = 0").select("_g", F.col("_up").alias("_top"))


def _down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows of the first round with the columns of ``above`` (one row a _g) and the whole _path,
    which ends with that of ``above``."""
    more = [c for c in above.columns if c not in ("_g", "_path")]
    up = rounds[-1].join(above.withColumnRenamed("_path", "_rest"), "_g")
    for table in [*rounds[-2::-1], None]:
        up = up.withColumn("_path", F.concat("_path", "_rest")).drop("_rest")
        if table is None:
            return up
        heads = up.select("_g", F.col("_pos").alias("_block"), F.col("_path").alias("_rest"), *more)
        up = table.join(heads, ["_g", "_block"])


def merkle_manifest(spark: SparkSession, docs: DataFrame, columns: list[str], group: str = "lang",
                    key: str = "doc_id", carry: dict[str, Column] | None = None, fan: int = FAN,
                    levels: int = LEVELS) -> DataFrame:
    """Per row: ``key``, ``group``, the carried columns, leaf, subroot, root, path.

    ``columns`` are hashed into the leaf in this order.  path lists, from the leaf up to the
    root, the digests of the run's other nodes before and after the row's own ancestor."""
    carry = carry or {}
    rows = docs.select(
        F.when(F.col(group).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(group).cast("string"))).alias("_g"),
        F.struct(F.col(key).alias("key"), F.col(group).alias("group"),
                 F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in carry.items()]).alias("more")).alias("_row"),
        F.col(key).alias("_key"), leaf(*[F.col(c) for c in columns]).alias("_h"))
    rounds = _forest(spark, numbered(spark, rows, ["_key", "_h"], "merkle"), fan, levels, "merkle")
    tops = cut(spark, _tops(rounds), "merkle-tops")
    roots = tops.select(F.lit("all").alias("_g"), F.col("_g").alias("_of"), F.col("_top").alias("_h"))
    over = _forest(spark, numbered(spark, roots, ["_of"], "merkle-groups"), fan, levels, "merkle-groups")
    root = _tops(over).withColumn("_path", F.expr(f"cast(array() as {PATH})"))
    above = _down(over, root).select(F.col("_of").alias("_g"), F.col("_h").alias("_sub"), F.col("_top").alias("_root"), "_path")
    out = _down(rounds, cut(spark, above, "merkle-above"))
    return out.select(F.col("_row.key").alias(key), F.col("_row.group").alias(group),
                      *[F.col("_row.more")[n].alias(n) for n in carry],
                      F.col("_h").alias("leaf"), F.col("_sub").alias("subroot"), F.col("_root").alias("root"),
                      F.col("_path").alias("path"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings fold to."""
    return F.aggregate(path, start, lambda acc, s: _digest(F.concat(s["before"], acc, s["after"])))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf up, left to right."""
    return _digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))
