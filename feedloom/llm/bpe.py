"""Byte-level BPE encoding and decoding by one shuffle of distinct words.

Encoding: texts are split into pre-tokens, and a block of documents keeps the
sequence of its pre-tokens as positions into the block's own list of distinct
words.  Only the distinct words travel: they are dealt out by hash, the bucket
encodes every word of the corpus once, and the ids come back to the blocks,
where documents are put together by position.  So a word that every text has is
sent once a block, not once an occurrence, and encoded once in all.

Decoding joins ids with the token-byte table.  The table is the vocabulary, so
its size is fixed; it goes along with the task and the join is an array lookup.

Defined cases: null text is an empty one (no ids); a text without pre-tokens
cannot occur other than empty; very long texts form a block of their own;
repeated rows and null doc_id are separate rows; an empty table gives no rows;
other columns pass through unread.  Ids outside the table fail to decode."""

from __future__ import annotations

import base64
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from feedloom.llm.common import binary, cut_bucketed, pack, slices, unpack
from feedloom.llm.packing import encoder
from feedloom.llm.pieces import code_point_classes, split

BLOCK_BYTES = 16 << 20        # text behind one list of distinct words
BUCKET_WORDS = 120_000        # words (counted once a block) of one bucket
CHUNK = 1 << 18               # pre-tokens put together at a time


def rank_file(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _words(blob: bytes, size: bytes) -> list[bytes]:
    raw, end = unpack(blob, np.uint8).tobytes(), np.cumsum(unpack(size, np.uint32).astype(np.int64)).tolist()
    return [raw[a:b] for a, b in zip([0, *end], end)]


def _join(words: list[bytes]) -> tuple[bytes, bytes]:
    return pack(np.frombuffer(b"".join(words), np.uint8)), pack(np.fromiter(map(len, words), np.uint32, len(words)))


def blocks(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, int]:
    """(block, rows, pieces, low, high, words, word_size, n_words): a block's documents as
    positions into its distinct words, the most frequent word first; a table bucketed by block, and
    its number of buckets."""
    others = [c for c in docs.columns if c != "text"]
    src = docs.select(F.struct(*others).alias("row"), "text")
    schema = (StructType().add("block", StringType()).add("rows", ArrayType(src.schema["row"].dataType))
              .add("pieces", ArrayType(LongType())).add("low", BinaryType()).add("high", BinaryType())
              .add("words", BinaryType()).add("word_size", BinaryType()).add("n_words", LongType()))
    table = pack(code_point_classes())

    def run(batches):
        classes = unpack(table, np.uint8)
        rows, pieces, parts, held = [], [], [], 0

        def flush():
            chunked = pa.chunked_array(parts).unify_dictionaries()
            words = chunked.chunk(0).dictionary if chunked.num_chunks else pa.array([], pa.large_binary())
            code = np.concatenate([c.indices.to_numpy() for c in chunked.chunks]).astype(np.int64)
            often = np.argsort(-np.bincount(code, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[often] = np.arange(len(words))
            code = rank[code]
            blob, size = _join(words.take(pa.array(often)).to_pylist())
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), one(pa.concat_arrays(rows)), one(pa.array(np.concatenate(pieces))),
                 pa.array([pack(code.astype(np.uint16))], pa.binary()),
                 pa.array([pack((code >> 16).astype(np.uint16))], pa.binary()),
                 pa.array([blob], pa.binary()), pa.array([size], pa.binary()), pa.array([len(words)], pa.int64())],
                names=schema.names)

        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("text"))):
                data, off, before = split(arr, classes)
                d = pa.Array.from_buffers(pa.large_binary(), len(off) - 1,
                                          [None, pa.py_buffer(np.ascontiguousarray(off, np.int64)),
                                           pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
                rows.append(part.column("row"))
                pieces.append(np.diff(before))
                parts.append(d)
                held += len(data)
                if held >= BLOCK_BYTES:
                    yield flush()
                    rows, pieces, parts, held = [], [], [], 0
        if rows:
            yield flush()

    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return cut_bucketed(spark, src.mapInArrow(run, schema), "block", -(-total // BLOCK_BYTES), "bpe-blocks")


def word_ids(table: DataFrame, ranks: dict[bytes, int], n_buckets: int) -> DataFrame:
    """(block, code, n_ids, ids): for every block the ids of its distinct words, bucket by bucket."""
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = _words(row["words"], row["word_size"])
                bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)).astype(np.int64) * n_buckets >> 32
                order = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                out = []
                for b in np.flatnonzero(np.diff(edge)).tolist():
                    code = order[edge[b]:edge[b + 1]]
                    out.append((b, row["block"], pack(code.astype(np.uint32)), *_join([words[c] for c in code.tolist()])))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.string(), *[pa.binary()] * 3))],
                        names=["bucket", "block", "code", "words", "word_size"])

    def encode(batch):
        enc, known = encoder(ranks), {}
        n_ids, ids = [], []
        for blob, size in zip(batch.column("words").to_pylist(), batch.column("word_size").to_pylist()):
            found = []
            for w in _words(blob, size):
                x = known.get(w)
                if x is None:
                    x = known[w] = enc.encode_ordinary(w.decode("utf-8", "replace"))
                found.append(x)
            size = np.fromiter(map(len, found), np.uint32, len(found))
            n_ids.append(pack(size))
            ids.append(pack(np.fromiter((i for x in found for i in x), np.uint32, int(size.sum()))))
        return pa.table({"block": batch.column("block"), "code": batch.column("code"),
                         "n_ids": pa.array(n_ids, pa.binary()), "ids": pa.array(ids, pa.binary())})

    sent = table.select("block", "words", "word_size").mapInArrow(
        send, "bucket int, block string, code binary, words binary, word_size binary")
    return sent.groupBy("bucket").applyInArrow(encode, "block string, code binary, n_ids binary, ids binary")


def spread(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start[i]:start[i] + size[i]] for all i, back to back."""
    end = np.cumsum(size)
    return values[np.repeat(start - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)]


def token_table(ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The token-byte table, packed: all tokens' bytes by id, and their sizes."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return _join(tokens)


class Decoder:
    """Joins ids with the token-byte table."""

    def __init__(self, blob: bytes, sizes: bytes):
        self.data, self.size = unpack(blob, np.uint8), unpack(sizes, np.uint32).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size

    def texts(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """Bytes of ids[cuts[i]:cuts[i + 1]] for all i."""
        size = self.size[ids]
        raw = spread(self.data, self.start[ids], size).tobytes()
        at = np.concatenate([[0], np.cumsum(size)])[cuts].tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]


def encode(spark: SparkSession, docs: DataFrame, ranks: dict[bytes, int], decoded: bool = False) -> DataFrame:
    """(row struct of the other columns, n_tokens, ids binary: little-endian unsigned 32-bit) per row.

    With ``decoded`` there is one more column, the bytes that the ids decode to; they
    are decoded where they were put together, which saves moving them to another task."""
    table, ways = blocks(spark, docs)
    n_words = table.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    found = word_ids(table, ranks, max(1, -(-n_words // BUCKET_WORDS)))
    # dealt out as the table is, so that neither moves again for the join
    back = found.repartition(ways, "block").groupBy("block").agg(
        F.collect_list(F.struct("code", "n_ids", "ids")).alias("found"))
    joined = table.join(back.hint("merge"), "block", "left").select("rows", "pieces", "low", "high", "n_words", "found")
    schema = (StructType().add("row", table.schema["rows"].dataType.elementType)
              .add("n_tokens", LongType()).add("ids", BinaryType()))
    if decoded:
        schema = schema.add("decoded", BinaryType())
    vocabulary = token_table(ranks) if decoded else None

    def run(batches):
        decoder = Decoder(*vocabulary) if vocabulary else None
        for batch in batches:
            for k in range(len(batch)):
                get = lambda c: batch.column(c)[k].as_py()  # noqa: B023, E731
                size, start = (np.zeros(get("n_words"), np.int64) for _ in range(2))
                ids, at = [], 0
                for f in get("found") or ():
                    code, n = unpack(f["code"], np.uint32), unpack(f["n_ids"], np.uint32).astype(np.int64)
                    size[code], start[code] = n, at + np.cumsum(n) - n
                    ids.append(unpack(f["ids"], np.uint32))
                    at += int(n.sum())
                ids = np.concatenate(ids) if ids else np.empty(0, np.uint32)
                code = unpack(get("low"), np.uint16).astype(np.uint32) | unpack(get("high"), np.uint16).astype(np.uint32) << 16
                rows = batch.column("rows").slice(k, 1).flatten()
                end = np.cumsum(np.array(get("pieces"), np.int64))
                a = 0
                while a < len(rows):
                    before = int(end[a - 1]) if a else 0
                    b = max(a + 1, int(np.searchsorted(end, before + CHUNK, side="right")))
                    own = code[before:int(end[b - 1])]
                    n = size[own]
                    tokens = spread(ids, start[own], n)
                    raw = tokens.astype("<u4").tobytes()
                    cuts = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[before], end[a:b]]) - before]
                    out = [rows.slice(a, b - a), pa.array(np.diff(cuts)),
                           pa.array([raw[4 * x:4 * y] for x, y in zip(cuts, cuts[1:])], pa.binary())]
                    if decoder:
                        out.append(pa.array(decoder.texts(tokens, cuts), pa.binary()))
                    yield pa.RecordBatch.from_arrays(out, names=schema.names)
                    a = b

    return joined.mapInArrow(run, schema)


def decode(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``rows`` with the binary column ids replaced by decoded, the bytes of its tokens."""
    keep = [c for c in rows.columns if c != "ids"]
    schema = StructType([rows.schema[c] for c in keep]).add("decoded", BinaryType())
    vocabulary = token_table(ranks)

    def run(batches):
        decoder = Decoder(*vocabulary)
        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("ids"))):
                out = []
                for x in arr.to_pylist():
                    ids = np.frombuffer(x, "<u4").astype(np.int64)
                    out += decoder.texts(ids, np.array([0, len(ids)]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(out, pa.binary())],
                                                 names=[*keep, "decoded"])

    return rows.select(*keep, "ids").mapInArrow(run, schema)
