import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import merkle, queries
from feedloom.session import scratch_path

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + fan])) for k in range(0, len(out[-1]), fan)])
    return out


def siblings(tree, place, fan):
    """(before, after) on each level, from the leaf up."""
    found = []
    for level in tree[:-1]:
        run = place // fan * fan
        found.append(("".join(level[run:place]), "".join(level[place + 1:run + fan])))
        place //= fan
    return found


def plain(rows, fan=2):
    """(doc_id, leaf, subroot, root, siblings) of each row."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]], fan)
    top = levels([trees[g][-1][0] for g in names], fan)
    return [(r[0], leaf(r), trees[g][-1][0], top[-1][0], siblings(trees[g], k, fan) + siblings(top, names.index(g), fan))
            for g in names for k, r in enumerate(groups[g])]


def rows_of(n, langs):
    return [(i * 3 % 101, f"s{i % 3}", langs[i * i % len(langs)], i, f"text {i}é" * (i % 4)) for i in range(n)]


ODD = [(None, None, None, None, None), (None, None, None, None, None), (7, "", "", 0, ""), (7, "", "", 0, ""), (7, "", "", 1, ""),
       (-5, "x", "é", -1, "-"), (5, "x", "zz", 3, "a" * 200_000), (1 << 60, "日本", "zz", None, "\n"), (9, "n", "n", 1, "v"), (9, None, "v", 1, None)]


@pytest.mark.parametrize("rows,fan,depth", [
    (rows_of(203, ["en", "de", None]), 2, 3), (rows_of(130, ["en"]), 3, 2), (rows_of(70, ["b", "a", "c", "d", "e"]), 2, 10),
    (rows_of(65, ["en"]), 4, 1), (ODD, 2, 2), (ODD, 5, 3), (ODD[:1], 2, 3), (rows_of(9, [f"l{k}" for k in range(40)]), 2, 1)])
def test_equals_plain_trees(spark, rows, fan, depth):
    df = spark.createDataFrame(rows, SCHEMA)
    got = merkle.merkle_manifest(spark, df, COLUMNS, fan=fan, levels=depth).select(
        "doc_id", "leaf", "subroot", "root", "path").collect()
    got = [(*r[:4], tuple((s["before"], s["after"]) for s in r["path"])) for r in got]
    assert collections.Counter(got) == collections.Counter((*w[:4], tuple(w[4])) for w in plain(rows, fan))


def test_query_finds_the_tampered(spark):
    rows = rows_of(60, ["en", None]) + ODD
    path = scratch_path(spark, "t-merkle")
    spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("extra")).write.parquet(f"{path}/documents.parquet")
    want = []
    for (doc, own, sub, root, kin), row in zip(plain(rows), sorted(
            rows, key=lambda r: ((r[2] is not None, (r[2] or "").encode()), (r[0] is not None, r[0] or 0, leaf(r))))):
        seen = own
        if doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and row[3] is not None:
            seen = leaf((*row[:3], row[3] + 1, row[4]))
        for before, after in kin:
            seen = h(before + seen + after)
        want.append((doc, own, sub, root, h("".join(b + a for b, a in kin)), seen, seen == root))
    got = queries.op12_merkle_manifest(spark, path)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.merkle_manifest(spark, df, COLUMNS).count() == 0
    more = spark.createDataFrame([(1, "a", 2, 3), (2, "a", 3, 4)], "doc_id long, lang string, path int, `_h` int")
    out = merkle.merkle_manifest(spark, more, ["doc_id", "path"], carry={"_n": F.col("path"), "_pos": F.col("_h")}).orderBy("doc_id")
    assert [(r["_n"], r["_pos"], r["leaf"]) for r in out.collect()] == [(2, 3, h("1:11:2")), (3, 4, h("1:21:3"))]
