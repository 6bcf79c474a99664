"""Approximate nearest neighbours by multi-index hashing.

Vectors are given ``BITS``-bit codes by learned rotations (iterative
quantisation: the rotation is fitted so that a sample's rotated vectors lie
close to the corners of the cube).  Largest inner product becomes smallest angle
by one more component, sqrt(max norm^2 - norm^2), before the rotation.

A code is cut into 16-bit substrings, each with a directory of its own from
value to vectors.  Codes within Hamming distance r of a query agree with it up
to r // m bits in one of the m substrings (the first r % m + 1; up to one bit
less suffices in the others), so probing every directory within these distances
finds every code within r.  What is found is checked for r over the whole code
and reranked by the inner product of the original vectors in double precision.

The radius is learned: for a bounded set of calibration queries the exact
neighbours are searched in all vectors, and r is the distance within which the
share ``RECALL`` of them lies.  Queries that find fewer than k are searched again
with the radius that covers every code, so every query gets its k.

Scale: vectors and queries are dealt into blocks of bounded size, and a task
gets one block of each, so the whole work is the grid of blocks; codes are
probed and sifted inside, and only k rows per query and block leave it.

Fitted on a sample: the rotations (LEARN_ROWS rows) and the radius (CALIBRATE
queries, but against all vectors).  Every row is indexed.

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, nor do rows without id; rows with
the query's own id are no candidates; other rows with equal ids or vectors all
count; ties go to the smaller id; with fewer than k candidates all are returned;
an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import cut

BITS, SUB = 256, 16
LEARN_ROWS, CALIBRATE, RECALL = 4096, 64, 0.985
BLOCK_VECTORS, BLOCK_QUERIES = 16_384, 4096
BATCH = 64                    # queries probed at a time


def usable(vectors: DataFrame) -> DataFrame:
    """(id, x array<double>) of the rows that take part."""
    v = vectors.select(F.col("id").cast("long").alias("id"), F.col("x").cast("array<double>").alias("x")).filter(
        F.col("id").isNotNull() & F.col("x").isNotNull())
    v = v.filter("not exists(x, c -> c is null or isnan(c) or abs(c) = double('Infinity')) and exists(x, c -> c <> 0)")
    size = v.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return v.filter(F.size("x") == (size[0]["d"] if size else 0))


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 1)


def dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows of x with q, component by component: equal rows, equal sums."""
    out = np.zeros(np.broadcast_shapes(x.shape[:-1], q.shape[:-1]))
    for c in range(x.shape[-1]):
        out += x[..., c] * q[..., c]
    return out


class Codes:
    """Learned rotations; ``of`` gives the codes as (n, BITS / SUB) 16-bit substrings."""

    def __init__(self, sample: np.ndarray, largest: float, rounds: int = 20, seed: int = 7):
        self.largest = largest
        x = self.lift(sample, True)
        self.mean = x.mean(0)
        v, rng, turns = x - self.mean, np.random.default_rng(seed), []
        while sum(t.shape[1] for t in turns) < BITS:
            r = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))[0]
            for _ in range(rounds):
                left, _, right = np.linalg.svd(v.T @ np.where(v @ r >= 0, 1.0, -1.0))
                r = left @ right
            turns.append(r)
        self.turn = np.concatenate(turns, 1)[:, :BITS]

    def lift(self, x: np.ndarray, stored: bool) -> np.ndarray:
        more = np.sqrt(np.maximum(0, self.largest ** 2 - (x * x).sum(1))) if stored else np.zeros(len(x))
        return np.column_stack([x, more])

    def of(self, x: np.ndarray, stored: bool) -> np.ndarray:
        if not stored:                       # a query's length does not matter to its order
            x = x * (self.largest / np.sqrt((x * x).sum(1, keepdims=True)))
        bits = (self.lift(x, stored) - self.mean) @ self.turn >= 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)


class Index:
    """The directories of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.words = np.ascontiguousarray(codes).view(np.uint64)
        self.m = codes.shape[1]
        self.dirs = [np.unique(codes[:, t], return_inverse=True) for t in range(self.m)]

    def within(self, q: np.ndarray, radius: int) -> np.ndarray:
        """(queries, codes) mask of the codes within ``radius`` bits."""
        found = np.zeros((len(q), len(self.words)), bool)
        each, more = divmod(radius, self.m)
        for t, (value, member) in enumerate(self.dirs):
            reach = each if t <= more else each - 1
            if reach >= 0:
                near = np.bitwise_count(value[None, :] ^ q[:, t, None]) <= reach
                found |= near[:, member]
        words = np.ascontiguousarray(q).view(np.uint64)
        for i in range(len(q)):
            at = np.flatnonzero(found[i])
            far = np.bitwise_count(self.words[at] ^ words[i]).sum(1, dtype=np.int64) > radius
            found[i, at[far]] = False
        return found


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(score) > k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= floor)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


FOUND = "query_id long, vec_id long, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def calibrated(vectors: DataFrame, queries: DataFrame, codes: Codes, k: int) -> int:
    """Radius that holds RECALL of the exact neighbours of the calibration queries."""
    some = queries.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(CALIBRATE).collect()
    q_ids, q = np.array([r["id"] for r in some]), np.array([r["x"] for r in some])
    q_codes = codes.of(q, False).view(np.uint64)

    def run(batches):
        for batch in batches:
            ids, x = batch.column("id").to_numpy(), matrix(batch.column("x"))
            if not len(ids):
                continue
            far = codes.of(x, True).view(np.uint64)
            rows = []
            for i in range(len(q)):
                score = dots(x, q[i])
                score[ids == q_ids[i]] = -np.inf
                for p in best(score, ids, k):
                    if score[p] > -np.inf:
                        rows.append((int(q_ids[i]), int(ids[p]), float(score[p]),
                                     int(np.bitwise_count(far[p] ^ q_codes[i]).sum())))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)] if rows else
                                             [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.int64())],
                                             names=["query_id", "vec_id", "score", "bits"])

    near = _ranked(vectors.mapInArrow(run, FOUND + ", bits long"), k)
    got = near.agg(F.percentile("bits", F.lit(RECALL))).first()[0]     # of at most CALIBRATE * k rows
    return int(np.ceil(got)) if got is not None else BITS


def search_within(vectors: DataFrame, queries: DataFrame, codes: Codes, radius: int, k: int,
                  n_v: int, n_q: int) -> DataFrame:
    """FOUND: the k best of each query in each block of vectors, among codes within ``radius``."""
    v = (vectors.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(n_v)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))))
    q = (queries.withColumn("qb", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_q)).cast("int"))
         .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(n_v - 1)))))

    def run(left, right):
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        ids, x = left.column("id").to_numpy(), matrix(left.column("x").combine_chunks())
        q_ids, q = right.column("id").to_numpy(), matrix(right.column("x").combine_chunks())
        index, q_codes = Index(codes.of(x, True)), codes.of(q, False)
        out = []
        for a in range(0, len(q), BATCH):
            near = index.within(q_codes[a:a + BATCH], radius)
            for i in range(len(near)):
                at = np.flatnonzero(near[i] & (ids != q_ids[a + i]))
                score = dots(x[at], q[a + i])
                p = best(score, ids[at], k)
                out.append((np.full(len(p), q_ids[a + i]), ids[at][p], score[p]))
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    return v.groupBy("vb", "qb").cogroup(q.groupBy("vb", "qb")).applyInArrow(run, FOUND)


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every query.

    vectors and queries have the columns (id, x)."""
    v = cut(spark, usable(vectors), "ann-vectors")
    size = v.agg(F.count(F.lit(1)), F.max(F.expr("sqrt(aggregate(x, 0D, (a, c) -> a + c * c))"))).first()
    q = cut(spark, queries.select(F.col("id").cast("long").alias("id")).filter("id is not null").distinct()
            .join(v, "id"), "ann-queries")
    n_queries = q.count()
    if not size[0] or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = v.orderBy(F.xxhash64("id"), "id").limit(LEARN_ROWS).collect()
    codes = Codes(np.array([r["x"] for r in sample]), size[1])
    n_v, n_q = -(-size[0] // BLOCK_VECTORS), -(-n_queries // BLOCK_QUERIES)
    radius = calibrated(v, q, codes, k)
    found = cut(spark, _ranked(search_within(v, q, codes, radius, k, n_v, n_q), k), "ann-found")
    # queries that found fewer than k: all codes are within BITS
    full = found.groupBy("query_id").count().filter(F.col("count") >= k).select(F.col("query_id").alias("id"))
    short = q.join(full, "id", "left_anti")
    out = found
    if not short.isEmpty():
        short = cut(spark, short, "ann-short")
        again = search_within(v, short, codes, BITS, k, n_v, -(-short.count() // BLOCK_QUERIES))
        out = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(_ranked(again, k))
    return out.select("query_id", "rank", "vec_id", "score")
