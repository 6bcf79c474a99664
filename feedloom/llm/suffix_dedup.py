"""Exact-substring dedup, bucket by bucket, with a difference cover as the filter.

Removed is every byte that a ``length``-byte string covers which also starts
anywhere else, in the same document or another.  Strings are judged on the
input.

Difference cover.  D is a set of residues mod v such that for any two positions
i, j some d < v puts both i + d and j + d into the sample (positions with a
residue in D).  So two positions with equal ``length``-byte strings have a pair of
sample positions with equal strings of ``length - v + 1`` bytes, at the same distance.

1. Candidates: the sample positions (|D| / v of all) are named by their first
   length - v + 1 bytes, and names are grouped one bucket at a time.  A sample
   position whose name is unique cannot take part in a tie of ``length`` bytes.
2. Ties: only positions within v before a repeated sample position are left; they
   are named by their first ``length`` bytes and grouped one bucket at a time.
   Positions with equal names are removed.

What this is not: the sample is not ranked and no suffix is put in its lexicographic
order; a tie is decided by the name of its whole ``length`` bytes, not by ranks, and
without a comparison of the bytes (see Names for the chance of confusion).

Memory is bounded by the block (about ``BLOCK_BYTES`` of text) and the bucket;
neither the text nor the suffix array is ever whole in one place.  Names are
64-bit polynomial fingerprints of two bases: two different strings among n are
confused with a chance of about n ** 2 / 2 ** 65.  Only ties matter for the result,
and shipping text for a lexicographic order would cost about ``v`` bytes a position.

Hot groups: a block sends a name once, however often it has it, so the most
frequent passage adds one row a block to its bucket.  Texts that occur as a
whole more than once are found by their digest, on rows without text: all their
bytes repeat, one of them goes through the sort as evidence for other documents,
and the others are left out of it.

The blocks are a table bucketed by block, so what is found about a block meets
its text without another shuffle of text.

Defined cases: null text counts as empty; texts shorter than ``length`` lose
nothing; rows with equal text are copies of each other, also with equal or null
doc_id; a very long text is a block of its own and is hashed in pieces; an empty
table gives no rows; other columns pass through unread."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from feedloom.llm.common import binary, cut, cut_bucketed, lookup, pack, per_row, slices, unpack, view

# fixed values: perfect difference sets, {period: residues}
COVERS = {7: (0, 1, 3), 21: (0, 1, 6, 8, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52),
          183: (0, 12, 19, 20, 22, 43, 60, 71, 76, 85, 89, 115, 121, 168)}
BLOCK_BYTES = 4 << 20
PIECE = 1 << 20                       # positions hashed at a time
SAMPLE_BUCKET, TIE_BUCKET = 16 << 20, 10 << 20  # bytes of text behind one bucket
BUCKETED = 16 << 20                             # bytes of text in one bucket of the block table
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """(period v, boolean table of the residues in D) for strings of ``length`` bytes."""
    v = max((p for p in COVERS if 2 * p <= length), default=1)
    table = np.zeros(v, bool)
    table[list(COVERS.get(v, (0,)))] = True
    return v, table


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], k = 1, 1
    while k < n:
        e = min(k, n - k)
        out[k:k + e] = out[:e] * np.uint64(pow(base, k, 1 << 64))
        k += e
    return out


class Names:
    """Fingerprints of fixed-length strings of a byte array."""

    def __init__(self, length: int, bases: int):
        self.length = length
        self.tables = [np.random.default_rng(b).integers(0, 1 << 63, 256, dtype=np.uint64) for b in range(bases)]
        n = PIECE + length
        self.pw = [_powers(_BASES[b], n) for b in range(bases)]
        self.back = [_powers(pow(_BASES[b], -1, 1 << 64), n) for b in range(bases)]

    def at(self, data: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Names of data[p:p + length] for the sorted positions ``where``."""
        out = np.empty(len(where), np.uint64)
        for a in range(0, len(data), PIECE):
            lo, hi = np.searchsorted(where, (a, a + PIECE))
            if lo == hi:
                continue
            seg, p = data[a:a + PIECE + self.length - 1], where[lo:hi] - a
            h = np.zeros(hi - lo, np.uint64)
            for table, pw, back in zip(self.tables, self.pw, self.back):
                total = np.zeros(len(seg) + 1, np.uint64)
                np.cumsum(table[seg] * pw[:len(seg)], out=total[1:])
                x = (total[p + self.length] - total[p]) * back[p]
                x ^= x >> np.uint64(32)
                h = (h ^ x) * np.uint64(_BASES[1])
                h ^= h >> np.uint64(29)
            out[lo:hi] = h
        return out


def blocks(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The texts in blocks: (block, rows array<struct of the other columns>, size
    array<long>, digest array<binary>, data binary), bucketed by block."""
    others = [c for c in docs.columns if c != "text"]
    src = docs.select(F.struct(*others).alias("row"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    schema = (StructType().add("block", StringType()).add("rows", ArrayType(src.schema["row"].dataType))
              .add("size", ArrayType(LongType())).add("digest", ArrayType(BinaryType())).add("data", BinaryType()))

    def run(batches):
        held, held_bytes = [], 0

        def flush():
            rows = pa.concat_arrays([x[0] for x in held])
            text = pa.concat_arrays([x[1] for x in held])
            data, off = view(text)
            digest = pa.array([xxhash.xxh3_128_digest(x) for x in text.to_pylist()], pa.binary())
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), one(rows), one(pa.array(np.diff(off))), one(digest),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(data.tobytes())], pa.binary())], names=schema.names)

        for batch in batches:
            for part, text in slices(batch, binary(batch.column("text")), BLOCK_BYTES // 4):
                held.append((part.column("row"), text))
                held_bytes += len(view(text)[0])
                if held_bytes >= BLOCK_BYTES:
                    yield flush()
                    held, held_bytes = [], 0
        if held:
            yield flush()

    return cut_bucketed(spark, src.mapInArrow(run, schema), "block", math.ceil(total / BUCKETED), "suffix-blocks")[0]


def copies(spark: SparkSession, table: DataFrame, length: int) -> DataFrame:
    """(block, copies array<struct<place, first>>): documents whose whole text, of ``length``
    bytes or more, occurs more than once; ``first`` marks one of each."""
    one = (table.select("block", F.posexplode(F.arrays_zip("size", "digest")).alias("place", "d"))
           .filter(F.col("d.size") >= length).select("block", "place", F.col("d.digest").alias("digest")))
    groups = (one.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("block", "place")).alias("least"))
              .filter("n > 1"))
    groups = cut(spark, groups, "suffix-copies")
    found = lookup(one, groups, "digest", "n", "place").filter(F.col("least").isNotNull())
    return found.groupBy("block").agg(F.collect_list(F.struct(
        "place", (F.struct("block", "place") == F.col("least")).alias("first"))).alias("copies"))


SORTED, EVIDENCE, LEFT_OUT = range(3)


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, document offsets, role of each document) of a block."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), np.uint8)
    role = np.full(len(row["size"]), SORTED)
    for c in row["copies"] or ():
        role[c["place"]] = EVIDENCE if c["first"] else LEFT_OUT
    return data, np.concatenate([[0], np.cumsum(np.array(row["size"], np.int64))]), role


def _starts(off: np.ndarray, role: np.ndarray, length: int, least: int, n: int) -> np.ndarray:
    """True where a string of ``length`` bytes starts and ends in one document of ``least`` bytes or more."""
    edge = np.zeros(n + 1, np.int32)
    long = (np.diff(off) >= max(length, least)) & (role != LEFT_OUT)
    edge[off[:-1][long]] += 1
    edge[off[1:][long] - length + 1] -= 1
    return np.cumsum(edge[:n]) > 0


def _gaps(p: np.ndarray) -> bytes:
    return pack(np.diff(p, prepend=0).astype(np.uint32))


def _places(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint32).astype(np.int64))


ENTRY = "bucket int, block string, names binary, places binary, more binary"


def entries(block: str, names: np.ndarray, where: np.ndarray, evidence: np.ndarray, n_buckets: int, keep_bytes: int):
    """Rows (ENTRY) that a block sends to the buckets: each name once.

    ``more`` has names without a place that waits for an answer: those that stand in
    ``evidence`` documents, and those that the block holds several times; the places
    of the latter repeat and go past the buckets in a row of their own (bucket -1 - x)."""
    order = np.argsort(names, kind="stable")
    s = names[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    twice = same[:-1] | same[1:]
    single = np.sort(order[~twice])
    more = np.concatenate([s[~same[:-1] & same[1:]], names[single[evidence[single]]]])
    single = single[~evidence[single]]
    kind = {4: np.uint32, 8: np.uint64}[keep_bytes]
    def bucket(x):
        return ((x >> np.uint64(40)) * np.uint64(n_buckets) >> np.uint64(24)).astype(np.int64)
    def low(x):
        return x.astype(kind)
    name, place = names[single], where[single]
    b1, b2 = bucket(name), bucket(more)
    o1, o2 = np.argsort(b1, kind="stable"), np.argsort(b2, kind="stable")
    e1, e2 = np.searchsorted(b1[o1], np.arange(n_buckets + 1)), np.searchsorted(b2[o2], np.arange(n_buckets + 1))
    for b in np.flatnonzero((np.diff(e1) > 0) | (np.diff(e2) > 0)).tolist():
        i, j = o1[e1[b]:e1[b + 1]], o2[e2[b]:e2[b + 1]]
        yield b, block, pack(low(name[i])), _gaps(place[i]), pack(low(more[j]))
    known = order[twice]
    known = np.sort(where[known[~evidence[known]]])
    if len(known):
        yield -1 - (int(block[:8], 16) % n_buckets), block, None, _gaps(known), None


def ties(rows: DataFrame, keep_bytes: int) -> DataFrame:
    """(block, places): the places whose name occurs elsewhere, one bucket sorted at a time."""
    kind = {4: np.uint32, 8: np.uint64}[keep_bytes]

    def settle(key, table):
        block, places = table.column("block").to_pylist(), table.column("places").to_pylist()
        if key[0].as_py() < 0:
            return pa.table({"block": pa.array(block, pa.string()), "places": pa.array(places, pa.binary())})
        names = [unpack(x, kind) for x in table.column("names").to_pylist()]
        more = [unpack(x, kind) for x in table.column("more").to_pylist()]
        n = sum(map(len, names))
        s = np.concatenate(names + more)
        order = np.argsort(s, kind="stable")
        s = s[order]
        same = np.zeros(len(s) + 1, bool)
        same[1:-1] = s[1:] == s[:-1]
        hit = np.zeros(len(s), bool)
        hit[order[same[:-1] | same[1:]]] = True
        out_block, out_places, at = [], [], 0
        for x, b, p in zip(names, block, places):
            mine = hit[at:at + len(x)]
            at += len(x)
            if mine.any():
                out_block.append(b)
                out_places.append(_gaps(_places(p)[mine]))
        assert at == n
        return pa.table({"block": pa.array(out_block, pa.string()), "places": pa.array(out_places, pa.binary())})

    return rows.groupBy("bucket").applyInArrow(settle, "block string, places binary")


def _batches(rows) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["bucket", "block", "names", "places", "more"])


def repeated_samples(table: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """(block, places): sample positions whose length - v + 1 bytes occur at another sample position."""
    v, residues = cover_for(length)

    def run(batches):
        names = Names(length - v + 1, 1)
        for batch in batches:
            for row in batch.to_pylist():
                data, off, role = _open(row)
                inside = np.arange(len(data), dtype=np.int32) - np.repeat(off[:-1].astype(np.int32), np.diff(off))
                where = np.flatnonzero(_starts(off, role, length - v + 1, length, len(data)) & residues[inside % v])
                shown = np.repeat(role == EVIDENCE, np.diff(off))[where]
                out = list(entries(row["block"], names.at(data, where), where, shown, n_buckets, 4))
                if out:
                    yield _batches(out)

    return ties(table.select("block", "size", "copies", "data").mapInArrow(run, ENTRY), 4)


def long_ties(with_sample: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """(block, places): positions whose ``length`` bytes occur elsewhere."""
    v, _ = cover_for(length)

    def run(batches):
        names = Names(length, 2)
        for batch in batches:
            for row in batch.to_pylist():
                data, off, role = _open(row)
                shown = np.repeat(role == EVIDENCE, np.diff(off))
                edge = np.zeros(len(data) + 1, np.int32)
                for p in map(_places, row["hits"] or ()):
                    np.add.at(edge, np.maximum(p - v + 1, 0), 1)
                    edge[p + 1] -= 1
                where = np.flatnonzero(((np.cumsum(edge[:-1]) > 0) | shown) & _starts(off, role, length, 0, len(data)))
                out = list(entries(row["block"], names.at(data, where), where, shown[where], n_buckets, 8))
                if out:
                    yield _batches(out)

    return ties(with_sample.select("block", "size", "copies", "data", "hits").mapInArrow(run, ENTRY), 8)


def suffix_dedup(spark: SparkSession, docs: DataFrame, length: int = 400, as_text: bool = False) -> DataFrame:
    """(row struct of the other columns, n_bytes, spans array<struct<start, end>>, kept binary) per row.

    spans are the maximal removed byte ranges; kept is what is left, back to back.
    With ``as_text`` kept is a string, without the parts of characters that were cut."""
    table = blocks(spark, docs)
    n_bytes = table.agg(F.coalesce(F.sum(F.expr("aggregate(size, 0L, (a, x) -> a + x)")), F.lit(0))).first()[0]
    table = table.drop("digest").join(cut(spark, copies(spark, table, length), "suffix-whole").hint("merge"), "block", "left")
    by_block = lambda hits: hits.groupBy("block").agg(F.collect_list("places").alias("hits")).hint("merge")
    sample = by_block(repeated_samples(table, length, max(1, math.ceil(n_bytes / SAMPLE_BUCKET))))
    tied = by_block(long_ties(table.join(sample, "block", "left"), length, max(1, math.ceil(n_bytes / TIE_BUCKET))))
    joined = table.join(tied, "block", "left")
    row_type = table.schema["rows"].dataType.elementType
    spans_type = ArrayType(StructType().add("start", LongType()).add("end", LongType()))
    schema = StructType().add("row", row_type).add("n_bytes", LongType()).add("spans", spans_type).add(
        "kept", StringType() if as_text else BinaryType())

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                rows = batch.column("rows").slice(k, 1).flatten()
                row = {c: batch.column(c)[k].as_py() for c in ("size", "copies", "data", "hits")}
                data, off, role = _open(row)
                edge = np.zeros(len(data) + 1, np.int32)
                for p in map(_places, row["hits"] or ()):
                    edge[p] += 1
                    edge[p + length] -= 1
                gone = (np.cumsum(edge[:-1]) > 0) | np.repeat(role != SORTED, np.diff(off))
                kept, spans = [], []
                lost = per_row(gone, off)
                for d, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    if not lost[d]:
                        kept.append(data[a:b].tobytes())
                        spans.append([])
                        continue
                    g = gone[a:b]
                    kept.append(data[a:b][~g].tobytes())
                    t = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
                    spans.append(list(zip(t[::2].tolist(), t[1::2].tolist())))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(row["size"], pa.int64()),
                     pa.array([[{"start": x, "end": y} for x, y in s] for s in spans],
                              pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text
                     else pa.array(kept, pa.binary())], names=["row", "n_bytes", "spans", "kept"])

    return joined.select("rows", "size", "copies", "data", "hits").mapInArrow(run, schema)
