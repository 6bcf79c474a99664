"""Alignment of two tokenizers: byte-level BPE (A) against piece BPE (B).

Both read a blank and the text.  Offsets where tokens of A and of B both end cut
the tokens into groups; tokens whose bytes overlap are linked; a pair of ids
counts in how many documents of the corpus it is linked.

Method: an associative monoid of fragments.  A fragment covers a byte range of a
document and holds an open prefix (tokens up to the first common end), closed
groups, and an open suffix (tokens after the last common end).  Two neighbours
compose by settling the suffix of the one with the prefix of the other; what is
closed is only joined.  Documents above ``CHUNK_BYTES`` are cut into byte ranges
that Spark deals to tasks; each range takes the tokens of A from its first place
that is safe for A, those of B from its first place that is safe for B - so the
two may begin apart - and rounds of ``FAN`` neighbours reduce the fragments to
one a document.  Shorter documents are one range each; a slice of them is worked
out at once by the same code.

Counts: documents stand in blocks, which keep each document's pairs as positions
into the block's own distinct pairs.  Only those travel, dealt out by their A id;
a bucket sums a pair's documents over all blocks and finds the largest count of
each A id, and the answers go back to the blocks.  So nothing is broadcast, and a
pair that every document has is sent once a block.

Where the texts are cut: a blank between printable ASCII characters begins a
pre-token of A whatever stands around it.  B starts anew at a blank after
something else, as long as no piece of its vocabulary holds a blank after
another character (checked; otherwise whole texts are encoded).

Defined cases: texts that are null or empty, or of which the bytes of A's or B's
tokens differ from blank and text (U+2581 in the text, for one), have no tokens:
all numbers are zero and groups is null; repeated rows and null doc_id are
documents of their own; an empty table gives no rows; other columns pass through
in ``row`` and may have any name."""

from __future__ import annotations

import hashlib
import itertools
import pickle
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from feedloom.llm.bpe import spread, token_table
from feedloom.llm.common import binary, cut, cut_bucketed, dictionary, pack, slices, unpack, view
from feedloom.llm.packing import byte_ranks, encoder
from feedloom.llm.pieces import code_point_classes, split

CHUNK_BYTES = 32 << 10        # byte range of one fragment
FAN = 8                       # fragments composed in one group
SLICE = 512 << 10             # text worked out at a time
KNOWN = 60_000                # encoded words of a side that a task remembers
BLOCK_BYTES = 4 << 20         # text behind one list of distinct pairs
BUCKET_PAIRS = 1 << 20        # pairs (counted once a block) of one bucket
BLANK = "▁"              # fixed value: the blank of the pieces


class Side(NamedTuple):
    """Tokens in order: ids, and where each ends."""
    ids: np.ndarray
    ends: np.ndarray

    def of(self, keep) -> Side:
        return Side(self.ids[keep], self.ends[keep])


NONE = Side(np.empty(0, np.int64), np.empty(0, np.int64))


def among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of x, both ascending, are in y?"""
    at = np.searchsorted(y, x)
    return (y[np.minimum(at, len(y) - 1)] == x) if len(y) else np.zeros(len(x), bool)


def chained(x: Side, y: Side) -> Side:
    return Side(np.concatenate([x.ids, y.ids]), np.concatenate([x.ends, y.ends]))


class Vocabularies:
    """Both tokenizers inside a task; every distinct piece of text is encoded once."""

    def __init__(self, ranks: dict[bytes, int], model: bytes, classes: bytes):
        self.classes, self.enc, self.known_a, self.known_b = unpack(classes, np.uint8), encoder(ranks), {}, {}
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.blank = self.sp.piece_to_id(BLANK)
        self.parts = not any(p.lstrip(BLANK).count(BLANK) for p in pieces)
        token = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(BLANK, " ").encode()
                 for i, p in enumerate(pieces)]
        raw, size = token_table(ranks)
        self.bytes_a = unpack(raw, np.uint8), unpack(size, np.uint32).astype(np.int64)
        self.bytes_b = np.frombuffer(b"".join(token), np.uint8), np.fromiter(map(len, token), np.int64, len(token))
        self.n_a, self.n_b = len(self.bytes_a[1]), len(self.bytes_b[1])
        # every id in decimal, followed by one of the three separators
        shown = [b"%d" % i for i in range(max(self.n_a, self.n_b))]
        self.n_ids = len(shown)
        shown = [x + s for s in (b",", b"|", b";") for x in shown]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_size = np.fromiter(map(len, shown), np.int64, len(shown))
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size

    def looked_up(self, data: np.ndarray, off: np.ndarray, known: dict, encode_all) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids before each word) of the words data[off[i]:off[i + 1]], every distinct one encoded once."""
        code, words = dictionary(data, off)
        words = words.to_pylist()
        new = [w for w in words if w not in known]
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = words
        known.update(zip(new, encode_all(new)))
        found = [known[w] for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(size.sum()))
        n = size[code]
        return spread(flat, (np.cumsum(size) - size)[code], n), np.concatenate([[0], np.cumsum(n)])

    def side_a(self, arr: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text)."""
        data, off, before = split(arr, self.classes)
        ids, at = self.looked_up(data, off, self.known_a,
                                 lambda new: [tuple(self.enc.encode_ordinary(w.decode("utf-8", "replace"))) for w in new])
        return ids, at[before]

    def side_b(self, arr: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text) of texts that begin with a blank."""
        data, off = view(arr)
        first = np.zeros(len(data) + 1, bool)
        first[off] = True
        begins = first[:-1].copy()
        if self.parts and len(data):
            blank = data == 32
            begins[1:] |= blank[1:] & ~blank[:-1]
        at = np.flatnonzero(begins)

        def encode_all(new):
            texts = [w[1:].decode("utf-8", "replace") for w in new]       # the model puts a blank before each
            return [tuple(ids) if t else (self.blank,) for t, ids in zip(texts, self.sp.encode(texts, num_threads=1))] if texts else []
        ids, before = self.looked_up(data, np.append(at, len(data)), self.known_b, encode_all)
        return ids, before[np.searchsorted(at, off)]

    def same(self, ids: np.ndarray, off: np.ndarray, bytes_: tuple, arr: pa.LargeBinaryArray) -> np.ndarray:
        """Per text: are the tokens' bytes those of the text?"""
        data, at = view(arr)
        table, size = bytes_
        n = size[ids]
        ends = np.concatenate([[0], np.cumsum(n)])[off]
        joined = spread(table, (np.cumsum(size) - size)[ids], n)
        if np.array_equal(ends, at) and np.array_equal(joined, data):
            return np.ones(len(arr), bool)
        return np.array([np.array_equal(joined[ends[i]:ends[i + 1]], data[at[i]:at[i + 1]]) for i in range(len(arr))], bool)

    def sides(self, arr: pa.LargeBinaryArray) -> tuple[Side, np.ndarray, Side, np.ndarray, np.ndarray]:
        """A's and B's tokens with offsets per text, of the texts that both give back (the mask)."""
        (a, a_off), (b, b_off) = self.side_a(arr), self.side_b(arr)
        ok = self.same(a, a_off, self.bytes_a, arr) & self.same(b, b_off, self.bytes_b, arr)
        if not ok.all():
            a, b = a[np.repeat(ok, np.diff(a_off))], b[np.repeat(ok, np.diff(b_off))]
            a_off, b_off = (np.concatenate([[0], np.cumsum(np.where(ok, np.diff(x), 0))]) for x in (a_off, b_off))
        return (Side(a, np.cumsum(self.bytes_a[1][a])), a_off, Side(b, np.cumsum(self.bytes_b[1][b])), b_off, ok)

    def groups(self, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text of the groups, each with ``;`` behind it; where each token's part of it ends, in the
        text's order; are A's tokens the last of a group) of tokens that end at a common place."""
        last_a, last_b = among(a.ends, b.ends), among(b.ends, a.ends)
        n = int(last_a.sum())
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_a = np.concatenate([[0], np.cumsum(np.bincount(of_a, minlength=n))])
        before_b = np.concatenate([[0], np.cumsum(np.bincount(of_b, minlength=n))])
        order = np.empty(len(of_a) + len(of_b), np.int64)
        order[np.arange(len(of_a)) + before_b[of_a]] = a.ids + self.n_ids * last_a
        order[np.arange(len(of_b)) + before_a[of_b + 1]] = b.ids + 2 * self.n_ids * last_b
        size = self.shown_size[order]
        return spread(self.shown, self.shown_start[order], size), np.cumsum(size), last_a

    def pairs(self, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
        """(pair, end of the bytes in common) of every two tokens that overlap: one for each stretch
        between neighbouring ends."""
        ends = np.concatenate([a.ends, b.ends[~among(b.ends, a.ends)]])
        ends.sort(kind="stable")
        key = a.ids[np.searchsorted(a.ends, ends)] * self.n_b + b.ids[np.searchsorted(b.ends, ends)]
        return key, ends


class Fragment(NamedTuple):
    """closed: the range holds a common end; else all its tokens are in the prefix."""
    ok: bool
    closed: bool
    prefix: tuple[Side, Side]
    text: bytes
    n_groups: int
    keys: np.ndarray
    counts: np.ndarray
    suffix: tuple[Side, Side]
    n_a: int
    n_b: int


#: the place where a document begins: a common end before any token
START = Fragment(True, True, (NONE, NONE), b"", 0, NONE.ids, NONE.ids, (NONE, NONE), 0, 0)
#: a range whose bytes the tokens do not give back: its document has no tokens
REFUSED = START._replace(ok=False)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    own, at = np.unique(keys, return_inverse=True)
    return own, np.bincount(at, weights=counts).astype(np.int64)


def settled(v: Vocabularies, a: Side, b: Side, after_end: bool) -> Fragment:
    """The fragment of neighbouring tokens; ``after_end``: they begin at a common end."""
    common = a.ends[among(a.ends, b.ends)]
    n_a, n_b = len(a.ids), len(b.ids)
    if not len(common):
        rest = (NONE, NONE), (a, b)
        prefix, suffix = rest if after_end else rest[::-1]
        return Fragment(True, after_end, prefix, b"", 0, NONE.ids, NONE.ids, suffix, n_a, n_b)
    first = -1 if after_end else common[0]
    prefix = a.of(a.ends <= first), b.of(b.ends <= first)
    suffix = a.of(a.ends > common[-1]), b.of(b.ends > common[-1])
    a, b = (x.of((x.ends > first) & (x.ends <= common[-1])) for x in (a, b))
    text, keys = b"", NONE.ids
    if len(a.ids):
        text = v.groups(a, b)[0].tobytes()
        keys = v.pairs(a, b)[0]
    return Fragment(True, True, prefix, text, len(common) - (not after_end), *summed(keys, np.ones(len(keys), np.int64)),
                    suffix, n_a, n_b)


def composed(v: Vocabularies, f: Fragment, g: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, START is its left unit."""
    if not (f.ok and g.ok):
        return REFUSED
    left = f.suffix if f.closed else f.prefix
    mid = settled(v, chained(left[0], g.prefix[0]), chained(left[1], g.prefix[1]), f.closed)
    keys, counts = summed(np.concatenate([f.keys, mid.keys, g.keys]), np.concatenate([f.counts, mid.counts, g.counts]))
    return Fragment(True, mid.closed, f.prefix if f.closed else mid.prefix, f.text + mid.text + g.text,
                    f.n_groups + mid.n_groups + g.n_groups, keys, counts, g.suffix if g.closed else mid.suffix,
                    f.n_a + g.n_a, f.n_b + g.n_b)


def dumped(f: Fragment) -> bytes:
    plain = [tuple(map(tuple, x)) if isinstance(x, tuple) else x for x in f]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(plain, protocol=5))


def loaded(b: bytes) -> Fragment:
    plain = pickle.loads(zstandard.ZstdDecompressor().decompress(b))
    return Fragment(*[tuple(Side(*s) for s in x) if isinstance(x, tuple) else x for x in plain])


def ranges(data: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """(A's begin and end, B's begin and end) of the byte ranges of a document, empty ones left out."""
    d = np.frombuffer(data, np.uint8)
    blank, shown = d == 32, (d > 32) & (d < 127)
    safe_b = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    safe_a = np.flatnonzero(blank[1:-1] & shown[:-2] & shown[2:]) + 1
    mark = np.arange(0, len(d), size)
    cuts = []
    for safe in (safe_a, safe_b):
        x = np.append(safe, len(d))[np.searchsorted(safe, mark)]
        x[0] = 0
        cuts.append(np.append(x, len(d)))
    a, b = (c.tolist() for c in cuts)
    return [(a[k], a[k + 1], b[k], b[k + 1]) for k in range(len(mark)) if a[k] < a[k + 1] or b[k] < b[k + 1]]


CHUNK = "a0 long, a1 long, b0 long, b1 long, low long, bytes binary"


def chunks(docs: DataFrame, size: int, parts: bool) -> DataFrame:
    """(doc, k, row, CHUNK): the byte ranges of each document of ``docs`` (row, text); row with k = 0 only."""
    schema = StructType().add("doc", StringType()).add("k", LongType()).add("row", docs.schema["row"].dataType)
    for c in ("a0", "a1", "b0", "b1", "low"):
        schema = schema.add(c, LongType())
    schema = schema.add("bytes", BinaryType())

    def run(batches):
        for batch in batches:
            for i, text in enumerate(binary(batch.column("text")).to_pylist()):
                data, doc = b" " + text, uuid.uuid4().hex
                at = ranges(data, size) if parts else [(0, len(data), 0, len(data))]
                row = batch.column("row").slice(i, 1)
                low = [min(a0, b0) for a0, _, b0, _ in at]
                raw = [data[x:max(a1, b1)] for x, (_, a1, _, b1) in zip(low, at)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(at)), pa.array(range(len(at)), pa.int64()),
                     pa.concat_arrays([row, pa.nulls(len(at) - 1, row.type)]),
                     *[pa.array(c, pa.int64()) for c in zip(*at)], pa.array(low, pa.int64()), pa.array(raw, pa.binary())],
                    names=schema.names)

    return docs.mapInArrow(run, schema)


def fragments(table: DataFrame, make) -> DataFrame:
    """(doc, k, fragment) of every byte range."""
    def run(batches):
        v = make()
        for batch in batches:
            out = []
            for a0, a1, b0, b1, low, raw in zip(*(batch.column(c).to_pylist() for c in ("a0", "a1", "b0", "b1", "low", "bytes"))):
                sides, ok = [], True
                for x, y, side, bytes_ in ((a0, a1, v.side_a, v.bytes_a), (b0, b1, v.side_b, v.bytes_b)):
                    arr = pa.array([raw[x - low:y - low]], pa.large_binary())
                    ids, off = side(arr) if x < y else (NONE.ids, np.zeros(2, np.int64))
                    ok &= bool(v.same(ids, off, bytes_, arr)[0])
                    sides.append(Side(ids, x + np.cumsum(bytes_[1][ids])))
                out.append(dumped(settled(v, *sides, False) if ok else REFUSED))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("k"), pa.array(out, pa.binary())],
                                             names=["doc", "k", "fragment"])

    return (table.select("doc", "k", "a0", "a1", "b0", "b1", "low", "bytes").repartition("doc", "k")
            .mapInArrow(run, "doc string, k long, fragment binary"))


def reduced(found: DataFrame, make, largest: int) -> DataFrame:
    """(doc, k = 0, fragment): a tree of groups of FAN neighbours over the ranges 0..largest."""
    def compose(group):
        v = make()
        rows = sorted(zip(group.column("k").to_pylist(), group.column("fragment").to_pylist()))
        f = loaded(rows[0][1])
        for _, other in rows[1:]:
            f = composed(v, f, loaded(other))
        return pa.table({"doc": group.column("doc").slice(0, 1), "k": pa.array([rows[0][0] // FAN], pa.int64()),
                         "fragment": pa.array([dumped(f)], pa.binary())})

    while largest > 0:
        found = found.groupBy("doc", F.expr(f"k div {FAN}").alias("up")).applyInArrow(compose, "doc string, k long, fragment binary")
        largest //= FAN
    return found


class Blocks:
    """Gathers documents and their pairs; ``flush`` gives the row of a block."""

    def __init__(self, schema):
        self.names = schema.names
        self.clear()

    def clear(self):
        self.rows, self.numbers, self.digests, self.keys, self.counts, self.held = [], [], [], [], [], 0

    def add(self, rows, numbers: np.ndarray, digests: list, keys: np.ndarray, counts: np.ndarray, size: int):
        """numbers: (documents, 5): n_a, n_b, n_groups, n_links, number of pairs."""
        for own, x in ((self.rows, rows), (self.numbers, numbers), (self.keys, keys), (self.counts, counts)):
            own.append(x)
        self.digests += digests
        self.held += size

    def flush(self) -> pa.RecordBatch:
        keys, code, docs = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        often = np.argsort(-docs, kind="stable")
        rank = np.empty(len(keys), np.uint32)
        rank[often] = np.arange(len(keys))
        code = rank[code]
        rows = pa.concat_arrays(self.rows)
        out = pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
             pa.array([pack(np.concatenate(self.numbers))], pa.binary()), pa.array([self.digests], pa.list_(pa.string())),
             pa.array([pack(code.astype(np.uint16))], pa.binary()), pa.array([pack((code >> 16).astype(np.uint16))], pa.binary()),
             pa.array([pack(np.concatenate(self.counts).astype(np.uint32))], pa.binary()),
             pa.array([pack(keys[often])], pa.binary()), pa.array([pack(docs[often].astype(np.uint32))], pa.binary()),
             pa.array([len(keys)], pa.int64())], names=self.names)
        self.clear()
        return out


def blocks(short: DataFrame, whole: DataFrame, make) -> DataFrame:
    """(block, rows, numbers, digests, low, high, counts, pairs, docs, n_pairs) of the documents in
    ``short`` (row, text) and of the finished fragments ``whole`` (row, fragment)."""
    schema = StructType().add("block", StringType()).add("rows", ArrayType(short.schema["row"].dataType))
    schema = schema.add("numbers", BinaryType()).add("digests", ArrayType(StringType()))
    for c in ("low", "high", "counts", "pairs", "docs"):
        schema = schema.add(c, BinaryType())
    schema = schema.add("n_pairs", LongType())

    def of_texts(batches):
        v, held = make(), Blocks(schema)
        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("text")), SLICE):
                some = pc.greater(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False)
                texts = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), arr, pa.scalar(b"", pa.large_binary()))
                a, a_off, b, b_off, ok = v.sides(texts.filter(pa.array(some)))
                numbers = np.zeros((len(arr), 5), np.int64)
                digests = [""] * len(arr)
                place = np.flatnonzero(some)[ok]
                keys = counts = NONE.ids
                if len(place):
                    a_at, b_at = (x[1:][ok] for x in (a_off, b_off))
                    text, ends, last = v.groups(a, b)
                    ends = np.concatenate([[0], ends])[a_at + b_at]
                    text = memoryview(text)
                    for i, x, y in zip(place.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                        digests[i] = hashlib.sha256(text[x:y - 1]).hexdigest()
                    key, at = v.pairs(a, b)
                    doc = np.searchsorted(a.ends[a_at - 1], at)
                    numbers[place, 0], numbers[place, 1] = np.diff(a_at, prepend=0), np.diff(b_at, prepend=0)
                    numbers[place, 2] = np.diff(np.cumsum(last)[a_at - 1], prepend=0)
                    numbers[place, 3] = np.bincount(doc, minlength=len(place))
                    width = v.n_a * v.n_b
                    both, counts = np.unique(doc * width + key, return_counts=True)
                    keys = both % width
                    numbers[place, 4] = np.bincount(both // width, minlength=len(place))
                held.add(part.column("row"), numbers, digests, keys, counts, len(view(arr)[0]))
                if held.held >= BLOCK_BYTES:
                    yield held.flush()
        if held.rows:
            yield held.flush()

    def of_fragments(batches):
        v, held = make(), Blocks(schema)
        for batch in batches:
            for i, raw in enumerate(batch.column("fragment").to_pylist()):
                f = composed(v, START, loaded(raw))
                ok = f.ok and not len(f.suffix[0].ids) and not len(f.suffix[1].ids)
                keys, counts = (f.keys, f.counts) if ok else (NONE.ids, NONE.ids)
                numbers = [f.n_a, f.n_b, f.n_groups, int(counts.sum()), len(keys)] if ok else [0] * 5
                held.add(batch.column("row").slice(i, 1), np.array([numbers], np.int64),
                         [hashlib.sha256(f.text[:-1]).hexdigest() if ok else ""], keys, counts, len(f.text))
                if held.held >= BLOCK_BYTES:
                    yield held.flush()
        if held.rows:
            yield held.flush()

    return short.mapInArrow(of_texts, schema).unionByName(whole.select("row", "fragment").mapInArrow(of_fragments, schema))


def corpus_counts(table: DataFrame, n_b: int, n_buckets: int) -> DataFrame:
    """(block, code, docs, best): for every block its pairs' numbers of documents in the corpus, and
    whether that is the largest of the pair's A id."""
    def send(batches):
        for batch in batches:
            for block, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "docs"))):
                pairs, docs = unpack(pairs, np.int64), unpack(docs, np.uint32)
                bucket = ((pairs // n_b * 0x9E3779B1 & 0xFFFFFFFF) * n_buckets) >> 32
                order = np.argsort(bucket, kind="stable")
                edge = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                out = []
                for b in np.flatnonzero(np.diff(edge)).tolist():
                    code = order[edge[b]:edge[b + 1]]
                    out.append((b, block, pack(code.astype(np.uint32)), pack(pairs[code]), pack(docs[code])))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.string(), *[pa.binary()] * 3))],
                        names=["bucket", "block", "code", "pairs", "docs"])

    def count(batch):
        pairs = [unpack(x, np.int64) for x in batch.column("pairs").to_pylist()]
        docs = np.concatenate([unpack(x, np.uint32) for x in batch.column("docs").to_pylist()])
        own, at = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.bincount(at, weights=docs).astype(np.int64)
        head = np.flatnonzero(np.diff(own // n_b, prepend=-1))
        most = np.maximum.reduceat(total, head)
        best = total == np.repeat(most, np.diff(np.append(head, len(own))))
        cuts = np.cumsum([len(p) for p in pairs])[:-1]
        return pa.table({"block": batch.column("block"), "code": batch.column("code"),
                         "docs": pa.array([pack(total[x]) for x in np.split(at, cuts)], pa.binary()),
                         "best": pa.array([pack(best[x]) for x in np.split(at, cuts)], pa.binary())})

    sent = table.select("block", "pairs", "docs").mapInArrow(send, "bucket int, block string, code binary, pairs binary, docs binary")
    return sent.groupBy("bucket").applyInArrow(count, "block string, code binary, docs binary, best binary")


def align(spark: SparkSession, docs: DataFrame, vocabulary_a: str, model_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: row (struct of the columns other than text), n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 (of the groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens).

    vocabulary_a: a byte-level BPE file of the tokenizers library; model_b: a piece model."""
    ranks, classes = byte_ranks(vocabulary_a), pack(code_point_classes())
    with open(model_b, "rb") as f:
        model = f.read()
    own = Vocabularies(ranks, model, classes)

    def make(kept=[]):                      # one a Python worker and query
        if not kept:
            kept.append(Vocabularies(ranks, model, classes))
        return kept[0]

    others = [c for c in docs.columns if c != "text"]
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text")
    long_ = F.coalesce(F.octet_length("text") > chunk_bytes, F.lit(False))
    cuts = cut(spark, chunks(src.filter(long_), chunk_bytes, own.parts), "align-chunks")
    largest = cuts.agg(F.coalesce(F.max("k"), F.lit(0))).first()[0]
    whole = reduced(fragments(cuts, make), make, largest)
    whole = whole.select("doc", "fragment").join(cuts.filter("k = 0").select("doc", "row"), "doc")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    table, ways = cut_bucketed(spark, blocks(src.filter(~long_), whole, make), "block", -(-total // BLOCK_BYTES), "align-blocks")
    n_pairs = table.agg(F.coalesce(F.sum("n_pairs"), F.lit(0))).first()[0]
    found = corpus_counts(table, own.n_b, max(1, -(-n_pairs // BUCKET_PAIRS)))
    back = found.repartition(ways, "block").groupBy("block").agg(
        F.collect_list(F.struct("code", "docs", "best")).alias("found"))
    joined = table.select("block", "rows", "numbers", "digests", "low", "high", "counts", "n_pairs").join(
        back.hint("merge"), "block", "left")
    schema = StructType().add("row", table.schema["rows"].dataType.elementType)
    for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(c, LongType())
    schema = schema.add("groups_sha256", StringType())

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                get = lambda c: batch.column(c)[k].as_py()  # noqa: B023, E731
                docs, best = np.zeros(get("n_pairs"), np.int64), np.zeros(get("n_pairs"), np.int64)
                for f in get("found") or ():
                    code = unpack(f["code"], np.uint32)
                    docs[code], best[code] = unpack(f["docs"], np.int64), unpack(f["best"], np.bool_)
                code = unpack(get("low"), np.uint16).astype(np.uint32) | unpack(get("high"), np.uint16).astype(np.uint32) << 16
                counts = unpack(get("counts"), np.uint32).astype(np.int64)
                numbers = unpack(get("numbers"), np.int64).reshape(-1, 5)
                at = np.concatenate([[0], np.cumsum(numbers[:, 4])])
                sums = [np.diff(np.concatenate([[0], np.cumsum(x[code] * counts)])[at]) for x in (best, docs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rows").slice(k, 1).flatten(), *[pa.array(np.ascontiguousarray(numbers[:, i])) for i in range(4)],
                     *map(pa.array, sums), pa.array(get("digests"), pa.string())], names=schema.names)

    return joined.select("rows", "numbers", "digests", "low", "high", "counts", "n_pairs", "found").mapInArrow(run, schema)
