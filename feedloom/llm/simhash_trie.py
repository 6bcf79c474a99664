"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints: words of the lower-cased (A-Z) text, shingles of ``shingle``
words, XXH64 with seed 42 of each; a bit of the fingerprint is set when it is
set in more than half of the shingle hashes.

Join: distinct fingerprints are read as paths of a binary trie.  Pairs of nodes
are walked down together, beginning with (root, root): a pair has the number of
bits in which its two paths differ so far, and is dropped as soon as that
exceeds ``max_bits``.  Pairs that reach the leaves are the links.

To spread the walk, ``max_bits + 1`` tries are built over rotations of the
fingerprint.  Two fingerprints within the budget agree on all bits of at least
one block, so in the trie whose paths start with that block their walk spends
nothing there: every trie hands out its subtrees below the first block, and no
link is lost.  A subtree with more than ``leaf_rows`` fingerprints is walked on
by Spark itself, ``STRIDE`` bits at a time, as a table of node pairs, until the
pairs are small; so no task meets an unbounded group.

Links become components by alternating large-star and small-star rounds over
tables in the shared folder.  Rows with equal fingerprints are counted before
anything is joined, and hot fingerprints take the broadcast way of ``lookup``.

Defined cases: null or empty text and text without words have fingerprint zero
and link like any other; null doc_id rows get the component of their
fingerprint and never name one (component_id is null if nobody can); repeated
rows each get a row; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from feedloom.llm.common import binary, cut, lookup, slices, view

SEED = 42
STRIDE = 8
#: a subtree of so many fingerprints is walked inside one task
LEAF_ROWS = 50_000

# fixed values: the primes of XXH64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161,
    9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_many(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH64 (seed 42) of data[start:start + length] for many short strings at once.

    Strings of 32 bytes and more have another first loop; they go to the library."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lane8 = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    lane4 = np.ndarray((len(padded) - 7,), "<u4", padded, strides=(1,))
    h = np.uint64(SEED) + _P5 + length.astype(np.uint64)
    short = np.flatnonzero(length < 32)
    at, left = start.copy(), length.copy()
    for _ in range(3):
        i = short[left[short] >= 8]
        if not len(i):
            break
        k = _rotl(lane8[at[i]] * _P2, 31) * _P1
        h[i] = _rotl(h[i] ^ k, 27) * _P1 + _P4
        at[i] += 8
        left[i] -= 8
    i = short[left[short] >= 4]
    h[i] = _rotl(h[i] ^ (lane4[at[i]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[i] += 4
    left[i] -= 4
    for _ in range(3):
        i = short[left[short] >= 1]
        if not len(i):
            break
        h[i] = _rotl(h[i] ^ (padded[at[i]].astype(np.uint64) * _P5), 11) * _P1
        at[i] += 1
        left[i] -= 1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    raw = data.tobytes()
    for i in np.flatnonzero(length >= 32).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[start[i]:start[i] + length[i]], SEED)
    return h


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def fingerprints(arr: pa.LargeBinaryArray, shingle: int) -> np.ndarray:
    """Fingerprint (uint64) of each text of a slice."""
    data, off = view(arr)
    n = len(off) - 1
    upper = (data >= 65) & (data <= 90)
    data = data | (upper.astype(np.uint8) << 5)
    space = _SPACE[data]
    begins, ends = np.ones(len(data), bool), np.ones(len(data), bool)
    begins[1:] = space[:-1]
    ends[:-1] = space[1:]
    edge = off[(off > 0) & (off < len(data))]
    begins[edge] = True
    ends[edge - 1] = True
    first, last = np.flatnonzero(begins & ~space), np.flatnonzero(ends & ~space)
    words_at = np.searchsorted(first, off)
    # the words again with one space after each
    size = last - first + 1
    place = np.cumsum(size + 1) - (size + 1)
    solid = np.flatnonzero(~space)
    joined = np.full(int((size + 1).sum()), 32, np.uint8)
    joined[np.arange(len(solid)) + np.repeat(np.arange(len(size)), size)] = data[solid]
    # a document's shingles; fewer words than that: one of all of them
    n_words = np.diff(words_at)
    n_sh = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    doc = np.repeat(np.arange(n), n_sh)
    sh_at = np.cumsum(n_sh) - n_sh
    a = words_at[:-1][doc] + (np.arange(len(doc)) - sh_at[doc])
    b = a + np.minimum(n_words[doc], shingle) - 1
    h = xxh64_many(joined, place[a], place[b] + size[b] - place[a])
    out = np.zeros(n, np.uint64)
    some = np.flatnonzero(n_sh)
    step = 1 << 17                                  # shingles unpacked to bits at a time
    counts = np.zeros((n, 64), np.int64)
    for x in range(0, len(h), step):
        bits = np.unpackbits(h[x:x + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        d = doc[x:x + step]
        head = np.flatnonzero(np.diff(d, prepend=-1))
        counts[d[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int32)
    majority = (2 * counts[some] > n_sh[some, None]).astype(np.uint8)
    out[some] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprints(docs: DataFrame, shingle: int = 3, name: str = "doc_id") -> DataFrame:
    """(the column ``name``, fp): the 64 bits as a signed long; no shuffle."""
    src = docs.select(name, "text")

    def run(batches):
        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("text"))):
                yield pa.RecordBatch.from_arrays(
                    [part.column(name), pa.array(fingerprints(arr, shingle).view(np.int64))], names=[name, "fp"])

    schema = StructType([src.schema[name]]).add("fp", LongType())
    return src.mapInArrow(run, schema if name != "doc_id" else "doc_id long, fp long")


def walk(v: np.ndarray, lo1, hi1, lo2, hi2, diff, depth: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Walk node pairs down to the leaves; returns index pairs (i, j) of links.

    v: sorted uint64 paths.  A node is a range of v that agrees on the first
    ``depth`` bits; a pair with equal ranges is a node with itself."""
    found = []
    while len(lo1):
        single = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        apart = single & (lo1 != lo2)
        i, j = lo1[apart], lo2[apart]
        near = np.bitwise_count(v[i] ^ v[j]) <= max_bits
        found.append((i[near], j[near]))
        lo1, hi1, lo2, hi2, diff = (x[~single] for x in (lo1, hi1, lo2, hi2, diff))
        if depth == 64 or not len(lo1):
            break
        bit = np.uint64(1 << (63 - depth))
        high = ~np.uint64((1 << (64 - depth)) - 1) if depth else np.uint64(0)
        mid = lambda lo, hi: np.clip(np.searchsorted(v, (v[lo] & high) | bit), lo, hi)
        m1, m2 = mid(lo1, hi1), mid(lo2, hi2)
        same = (lo1 == lo2) & (hi1 == hi2)
        parts = [(lo1, m1, lo2, m2, diff), (m1, hi1, m2, hi2, diff), (lo1, m1, m2, hi2, diff + 1)]
        parts.append(tuple(x[~same] for x in (m1, hi1, lo2, m2, diff + 1)))
        lo1, hi1, lo2, hi2, diff = (np.concatenate(x) for x in zip(*parts))
        live = (diff <= max_bits) & (hi1 > lo1) & (hi2 > lo2)
        lo1, hi1, lo2, hi2, diff = (x[live] for x in (lo1, hi1, lo2, hi2, diff))
        depth += 1
    i = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
    j = np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64)
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each of n nodes' component under the links (i, j)."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            break
        i, j = i[open_], j[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _unsigned(c: pa.Array) -> np.ndarray:
    return c.to_numpy().astype(np.int64).view(np.uint64)


def subtree_links(pairs: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """(u, w) of the links inside each node pair (rot, a, b), as stars.

    pairs: (rot, a, b, v) with a and b the nodes' paths (first ``depth`` bits)
    and v a rotated fingerprint below either; only pairs of bounded size."""
    n_rot = max_bits + 1
    block = 64 // n_rot

    def solve(rot, a, b, v):
        head = np.flatnonzero((np.diff(rot, prepend=-1) != 0) | (np.diff(a, prepend=~a[:1]) != 0)
                              | (np.diff(b, prepend=~b[:1]) != 0))
        end = np.append(head[1:], len(v))
        lone = a[head] == b[head]
        group = np.repeat(np.arange(len(head)), end - head)
        links_i, links_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        # nodes with themselves: disjoint and in path order within a rotation, so one walk for all
        for r in np.unique(rot):
            rows = np.flatnonzero((rot == r) & lone[group])
            lo = np.flatnonzero(np.diff(group[rows], prepend=-1))
            hi = np.append(lo[1:], len(rows))
            some = hi - lo > 1
            lo, hi = lo[some], hi[some]
            i, j = walk(v[rows], lo, hi, lo, hi, np.zeros(len(lo), np.int64), depth, max_bits)
            links_i.append(rows[i])
            links_j.append(rows[j])
        # two nodes: the rows of the first come first
        for g in np.flatnonzero(~lone):
            s, e = head[g], end[g]
            mid = int(np.searchsorted(v[s:e] >> np.uint64(64 - depth), b[s]))
            spent = int(np.bitwise_count(a[s] ^ b[s]))
            i, j = walk(v[s:e], np.array([0]), np.array([mid]), np.array([mid]), np.array([e - s]),
                        np.array([spent]), depth, max_bits)
            links_i.append(s + i)
            links_j.append(s + j)
        links_i, links_j = np.concatenate(links_i), np.concatenate(links_j)
        label = forest(len(v), links_i, links_j)
        moved = np.flatnonzero(label != np.arange(len(v)))
        back = (np.uint64(64) - (rot[moved].astype(np.uint64) * np.uint64(block))) % np.uint64(64)
        turn = lambda x: (x << back) | (x >> ((np.uint64(64) - back) % np.uint64(64)))
        u, w = turn(v[moved]), turn(v[label[moved]])
        return u, w

    def run(batches):
        carry = None
        for batch in batches:
            cols = [batch.column(0).to_numpy().astype(np.int64), *(_unsigned(batch.column(k)) for k in (1, 2, 3))]
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            if not len(cols[0]):
                continue
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]))
            stop = last[-1] + 1 if len(last) else 0
            carry = [x[stop:] for x in cols]
            if stop:
                u, w = solve(*(x[:stop] for x in cols))
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(w.view(np.int64))], names=["u", "w"])
        if carry is not None and len(carry[0]):
            u, w = solve(*carry)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(w.view(np.int64))], names=["u", "w"])

    return (pairs.select("rot", "a", "b", "v").repartition("rot", "a", "b")
            .sortWithinPartitions("rot", "a", "b", F.expr("shiftrightunsigned(v, 1)"), F.expr("v & 1"))
            .mapInArrow(run, "u long, w long"))


def links(spark: SparkSession, fps: DataFrame, max_bits: int = 2, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(u, w): links between distinct fingerprints ``fps.fp``, enough of them to
    join every pair within ``max_bits`` differing bits (a star per component found)."""
    n_rot = max_bits + 1
    block = 64 // n_rot
    turned = [(f"shiftleft(fp, {r * block}) | shiftrightunsigned(fp, {64 - r * block})" if r else "fp") for r in range(n_rot)]
    depth = block
    pairs = (fps.select(F.posexplode(F.array(*[F.expr(t) for t in turned])).alias("rot", "v"))
             .withColumn("a", F.expr(f"shiftrightunsigned(v, {64 - depth})")).withColumn("b", F.col("a")))
    found = []
    while True:
        sizes = pairs.groupBy("rot", "a", "b").count()
        big = sizes.filter(F.col("count") > leaf_rows).drop("count")
        if depth >= 63 or big.isEmpty():
            found.append(subtree_links(pairs, depth, max_bits))
            break
        big = cut(spark, big, "simhash-hot")
        found.append(subtree_links(pairs.join(big, ["rot", "a", "b"], "left_anti"), depth, max_bits))
        # the hot pairs go down by STRIDE bits: their nodes, then the node pairs within the budget
        deeper = min(63, depth + STRIDE)
        rows = (pairs.join(big, ["rot", "a", "b"], "left_semi")
                .withColumn("c", F.expr(f"shiftrightunsigned(v, {64 - deeper})")))
        side = F.expr(f"shiftrightunsigned(c, {deeper - depth})")
        nodes = rows.groupBy("rot", "a", "b", "c").count().drop("count").withColumn("of", side)
        x = nodes.select("rot", "a", "b", F.col("c").alias("c1"), F.col("of").alias("of1"))
        y = nodes.select("rot", "a", "b", F.col("c").alias("c2"), F.col("of").alias("of2"))
        met = (x.join(y, ["rot", "a", "b"])
               .filter("(a = b and c1 <= c2) or (a <> b and of1 = a and of2 = b)")
               .filter(f"bit_count(c1 ^ c2) <= {max_bits}")
               .select("rot", "a", "b", "c1", "c2"))
        member = met.withColumn("c", F.explode(F.array_distinct(F.array("c1", "c2"))))
        down = (rows.join(member, ["rot", "a", "b", "c"])
                .select("rot", F.col("c1").alias("a"), F.col("c2").alias("b"), "v"))
        pairs, depth = cut(spark, down, "simhash-down"), deeper
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (u, w) with the smallest node that it reaches."""
    e = cut(spark, edges.filter("u <> w").select(F.greatest("u", "w").alias("u"), F.least("u", "w").alias("w"))
            .distinct(), "simhash-edges")
    before = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return e.select(F.col("u").alias("node"), F.col("w").alias("root"))
        before = mark
        # large star: every larger neighbour of u to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("w").alias("u"), F.col("u").alias("w")))
        least = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("m"))
        large = (lookup(both, least, "u", "n", "w").filter("w > u")
                 .select(F.col("w").alias("u"), F.least("m", F.col("u")).alias("w")).distinct())
        large = cut(spark, large, "simhash-large")
        # small star: u and its smaller neighbours to the smallest of them
        least = large.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("m"))
        small = lookup(large, least, "u", "n", "w")
        e = cut(spark, small.select(F.col("w").alias("u"), F.col("m").alias("w"))
                .unionByName(least.select("u", F.col("m").alias("w"))).filter("u <> w").distinct(), "simhash-small")


def simhash_groups(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    rows = cut(spark, with_fingerprints(docs, shingle), "simhash-fp")
    fps = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"))
    fps = cut(spark, fps, "simhash-distinct")
    roots = cut(spark, components(spark, links(spark, fps, max_bits, leaf_rows)), "simhash-roots")
    linked = (fps.join(roots, fps.fp == roots.node, "left")
              .select("fp", "n", "least", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("tied")))
    heads = roots.select(F.col("root").alias("head")).distinct()
    linked = linked.join(heads, linked.fp == heads["head"], "left").filter("n > 1 or tied or head is not null")
    linked = cut(spark, linked.select("fp", "n", "least", "root"), "simhash-linked")
    # the smallest doc_id of a component; a component may be hot, so combine before the join back
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    named = lookup(linked.select("fp", "n", "root"), least, "root", "m", "fp")
    named = cut(spark, named, "simhash-named")
    out = lookup(rows, named.select("fp", "n", "component_id", F.lit(True).alias("grouped")), "fp", "n", "doc_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component.

    Of rows that share a doc_id and a fingerprint one stays; rows that share a doc_id only
    are judged each by its own text.  Rows without doc_id cannot be named by a component
    and stay."""
    groups = cut(spark, simhash_groups(spark, docs, shingle, max_bits), "simhash-groups")
    again = groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = not again.isEmpty()
    gone = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    if repeated:
        again = cut(spark, again, "simhash-again")
        gone = gone.unionByName(again).distinct()
    kept = docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti")      # the same plan at every size
    if not repeated:
        return kept
    each = docs.join(again, "doc_id", "left_semi")
    each = with_fingerprints(each.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), shingle, "row")
    ours = (groups.filter("doc_id = component_id").join(again, "doc_id", "left_semi")
            .select(F.col("doc_id").alias("_id"), "fingerprint").distinct())
    each = each.withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0"))).withColumn("_id", F.col("row.doc_id"))
    each = each.join(ours, ["_id", "fingerprint"], "left_semi").dropDuplicates(["_id", "fingerprint"])
    return kept.unionByName(each.select(*[F.col("row")[c].alias(c) for c in docs.columns]))
