"""Helpers shared by the text operators: tables in the shared folder, byte
views of Arrow text columns, and a lookup join that survives hot keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import scratch_path

#: bytes of text that one vectorised step holds at a time inside a task
SLICE_BYTES = 4 << 20
#: a key is hot when it holds at least this share of the rows; so there are at
#: most HOT_SHARE hot keys at any input size, which bounds what is broadcast
HOT_SHARE = 1000


def cut(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: the
    lineage ends there, so a lost executor costs no earlier stage again."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_bucketed(spark: SparkSession, df: DataFrame, key: str, ways: int, label: str) -> tuple[DataFrame, int]:
    """Like ``cut``, as a table bucketed by ``key``, and its number of buckets: later joins
    on the key move the other side only.

    No fewer buckets than shuffle partitions, or joins would rather shuffle the table."""
    ways = max(ways, *(int(spark.conf.get(k, None) or 1) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")))
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.bucketBy(ways, key).option("path", scratch_path(spark, label)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")          # of the catalog; the files stay
    return table, ways


def pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def binary(col: pa.Array) -> pa.LargeBinaryArray:
    """A text or binary column as bytes; null becomes empty."""
    return pc.fill_null(col.cast(pa.large_binary()), b"")


def view(arr: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets): the bytes of all rows back to back, and len + 1 offsets."""
    off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, arr: pa.LargeBinaryArray,
           max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.LargeBinaryArray]]:
    """Row ranges of a batch with at most ``max_bytes`` of text (one row at least)."""
    _, off = view(arr)
    a, n = 0, len(arr)
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, side="right")) - 1)
        yield batch.slice(a, b - a), arr.slice(a, b - a)
        a = b


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one per byte or item) within each [off[i], off[i+1])."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def dictionary(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(codes, distinct values) of the byte strings data[off[i]:off[i+1]]."""
    arr = pa.Array.from_buffers(pa.large_binary(), len(off) - 1,
                                [None, pa.py_buffer(np.ascontiguousarray(off, np.int64)),
                                 pa.py_buffer(np.ascontiguousarray(data))])
    d = arr.dictionary_encode()
    return d.indices.to_numpy(), d.dictionary


def lookup(big: DataFrame, small: DataFrame, key: str, count: str, spread: str) -> DataFrame:
    """Left join of ``small`` (one row a key) to ``big`` on ``key`` when single
    keys may hold a third of the rows of ``big``.

    ``small`` has the number of rows of ``big`` per key in ``count``.  Keys with
    at least 1 / HOT_SHARE of all rows - so at most HOT_SHARE of them - are
    broadcast; their rows then travel under a key of their own taken from
    ``spread``, so no task gets a hot key."""
    total = small.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    rest = [c for c in small.columns if c not in (key, count)]
    floor = max(2, -(-total // HOT_SHARE))
    packed = small.select(key, count, F.struct(*rest).alias("_v"))
    hot = packed.filter(F.col(count) >= floor).select(F.col(key).alias("_hk"), F.col("_v").alias("_hv"))
    cold = packed.filter(F.col(count) < floor).select(
        F.col(key).alias("_ck"), F.lit(0).alias("_cs"), F.col("_v").alias("_cv"))
    b = big.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    is_hot = F.col("_hk").isNotNull()
    b = b.withColumn("_s", F.when(is_hot, 1 + F.pmod(F.xxhash64(spread), F.lit(1 << 20))).otherwise(0).cast("int"))
    out = b.join(cold.hint("shuffle_hash"), (F.col(key) == F.col("_ck")) & (F.col("_s") == F.col("_cs")), "left")
    v = F.coalesce("_hv", "_cv")
    return out.select(*big.columns, *[v[c].alias(c) for c in rest])
