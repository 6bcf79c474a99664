import base64

import hypothesis
import hypothesis.strategies as st
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import bpe, line_dedup, packing, pieces, quality_rules, sharding, simhash_trie, suffix_dedup
from tests.llm import brute

PROSE = " ".join(f"word{i % 37} and other{i % 11}" for i in range(40))
LONG = " ".join(f"long{i * i % 9973}" for i in range(40_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))
TEXTS = [
    (1, PROSE), (2, None), (3, ""), (4, " \n\t "), (5, PROSE), (6, LONG), (7, PASSAGE + "\n" + "tail one.\nline two.\nline three."),
    (8, "Head.\n" + PASSAGE + "\nline two.\nline three.\n\nline two.\nline three."), (9, "don't  stop it's 12 café　中文 <|endoftext|>"),
    (10, PROSE.replace("word3 ", "word4 ", 1)), (11, "a"), (12, "x y"), (13, PROSE.upper()), (14, "#*$%&|<> " * 30),
    (None, "no id here, " + PROSE[:100]), (15, "same row"), (15, "same row"),
]
CLASH = ("fp", "row", "block", "_key", "name", "digest", "bits", "n", "stratum", "kept", "lang", "data", "size", "words",
         "shard", "hits", "copies", "piece", "start", "length", "_doc", "line", "first", "component_id", "doc")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, *[f"{c}{i}" for c in CLASH]) for i, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def by_row(rows, *cols):
    return sorted(((r["doc_id"] is None, r["doc_id"], *[r[c] for c in cols]) for r in rows), key=str)


def test_quality_counts_and_empty(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = quality_rules.quality_rules(spark, docs, labels).collect()
    assert by_row(got, *cols) == by_row([{"doc_id": d, **dict(zip(cols, brute.base_counts(t)))} for d, t in TEXTS], *cols)
    for r in got:       # too few labels to certify anything: only the base rule rejects
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])
    assert quality_rules.quality_rules(spark, none, labels).count() == 0
    kept = quality_rules.keep_good(spark, docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_quality_cutoffs_hold_their_risk(spark):
    # good documents have no symbols, bad ones do; one stratum has too few labels
    good = [(i, " ".join(f"w{(i * 7 + k) % 5003}" for k in range(60)), "en") for i in range(1600)]
    bad = [(2000 + i, " ".join(f"w{(i * 7 + k) % 5003} #" for k in range(60)), "en") for i in range(200)]
    few = [(3000 + i, good[i][1] + " #", None) for i in range(40)]
    d = spark.createDataFrame(good + bad + few, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 2000), 0) for r in good + bad], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(spark, d, labels).collect()}
    assert not any(kept[r[0]] for r in bad) and all(kept[r[0]] for r in few)
    assert sum(not kept[r[0]] for r in good) <= 0.01 * len(good)


def test_binomial_tail_and_levels():
    assert quality_rules.binomial_tail(0, 10, 0.1) == pytest.approx(0.9 ** 10)
    assert quality_rules.binomial_tail(1, 3, 0.5) == pytest.approx(0.5)
    # the second level fails, so the third is not looked at however good it is
    assert quality_rules.choose_level(np.array([0, 30, 0]), np.array([5, 50, 90]), 1000, 0.01, 0.05) == 0
    assert quality_rules.choose_level(np.array([0]), np.array([1]), 10, 0.01, 0.05) == -1


def test_line_dedup(spark, docs, none):
    rows = line_dedup.line_dedup(spark, docs)
    want = brute.drop_later_lines(sorted(TEXTS[:-1], key=lambda r: (r[0] is None, r[0] or 0)))
    flat = rows.select("row.*", "text")
    assert by_row(flat.collect(), "text") == by_row([{"doc_id": d, "text": want[d]} for d, _ in TEXTS], "text")
    assert sorted(flat.columns) == sorted(docs.columns) and flat.filter("lang is null or _key is null").count() == 0
    assert line_dedup.line_dedup(spark, none).count() == 0


@hypothesis.settings(max_examples=4, deadline=None)
@hypothesis.given(st.lists(st.lists(st.sampled_from(["a", "b", "c d", "", " "]), max_size=8), max_size=12), st.integers(1, 3))
def test_line_dedup_like_brute_force(spark, parts, min_lines):
    texts = [(i, "\n".join(p)) for i, p in enumerate(parts)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["text"] for r in line_dedup.line_dedup(spark, d, min_lines).collect()}
    assert got == brute.drop_later_lines(texts, min_lines)


def test_xxh64_of_all_lengths():
    data = np.frombuffer(bytes(range(256)) * 2, np.uint8)
    start = np.arange(60)
    got = simhash_trie.xxh64_many(data, start, start)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[s:s + s].tobytes(), 42) for s in start]


@pytest.mark.parametrize("leaf", [50_000, 4])
def test_simhash_groups(spark, docs, none, leaf):
    fp = [brute.fingerprint(t) for _, t in TEXTS]
    of = brute.near_components(fp)
    least = {}
    for (d, _), f in zip(TEXTS, fp):
        if d is not None:
            least[of[f]] = min(least.get(of[f], d), d)
    want = [{"doc_id": d, "fingerprint": f"{f:016x}", "component_id": least.get(of[f])} for (d, _), f in zip(TEXTS, fp)]
    got = simhash_trie.simhash_groups(spark, docs, leaf_rows=leaf).collect()
    assert by_row(got, "fingerprint", "component_id") == by_row(want, "fingerprint", "component_id")
    assert simhash_trie.simhash_groups(spark, none).count() == 0
    kept = [r["doc_id"] for r in simhash_trie.keep_one(spark, docs).collect()]
    assert sorted(x for x in kept if x is not None) == sorted(set(least.values())) and kept.count(None) == 1


def test_trie_links_in_dense_groups(spark):
    rng = np.random.default_rng(5)
    values = set(rng.integers(0, 2**63, 200).tolist())
    for c in rng.integers(0, 2**63, 3).tolist():          # clusters that share long prefixes, and chains
        for _ in range(150):
            c ^= 1 << int(rng.integers(0, 12)) if rng.random() < .5 else (1 << int(rng.integers(0, 64)))
            values.add(c & (2**64 - 1))
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    fps = spark.createDataFrame(signed, "fp long")
    want = brute.near_components(values)
    for leaf in (100_000, 10):
        roots = {r["node"]: r["root"] for r in simhash_trie.components(spark, simhash_trie.links(spark, fps, 2, leaf)).collect()}
        group = {}
        for (s,) in signed:
            group.setdefault(roots.get(s, s), set()).add(s % 2**64)
        expect = {}
        for v in values:
            expect.setdefault(want[v], set()).add(v)
        assert sorted(map(sorted, group.values())) == sorted(map(sorted, expect.values()))


def test_difference_covers():
    for v, residues in suffix_dedup.COVERS.items():
        assert {(a - b) % v for a in residues for b in residues} == set(range(v))


def check_suffix(spark, texts, length, frame=None):
    d = frame if frame is not None else spark.createDataFrame(texts, "doc_id long, text string")
    raw = [(t or "").encode() for _, t in texts]
    gone = brute.repeated_bytes(raw, length)
    want = []
    for (i, _), b, g in zip(texts, raw, gone):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(int), [0]])))
        want.append({"doc_id": i, "n": len(b), "spans": list(zip(edge[::2].tolist(), edge[1::2].tolist())),
                     "kept": np.frombuffer(b, np.uint8)[~g].tobytes()})
    got = [{"doc_id": r["row"]["doc_id"], "n": r["n_bytes"], "spans": [tuple(s) for s in r["spans"]], "kept": bytes(r["kept"])}
           for r in suffix_dedup.suffix_dedup(spark, d, length).collect()]
    assert by_row(got, "n", "spans", "kept") == by_row(want, "n", "spans", "kept")


def test_suffix_dedup(spark, docs, none):
    check_suffix(spark, TEXTS, 400, docs)
    check_suffix(spark, TEXTS, 20, docs)
    assert suffix_dedup.suffix_dedup(spark, none, 400).count() == 0
    text = {r["row"]["doc_id"]: r["kept"] for r in suffix_dedup.suffix_dedup(spark, docs, 400, as_text=True).collect()}
    assert text[2] == "" and text[9] == TEXTS[8][1]


@hypothesis.settings(max_examples=4, deadline=None)
@hypothesis.given(st.lists(st.text("abé", max_size=60), max_size=8), st.sampled_from([3, 14, 16, 45]))
def test_suffix_dedup_like_brute_force(spark, texts, length):
    check_suffix(spark, list(enumerate(texts)), length)


ALPHABET = list("ab '  \n\ts.t!1٣é中 　rvellmdD\U0001f642\x0b\x85") + ["'s", "'re", "'ll", " '", "  "]


@hypothesis.settings(max_examples=300, deadline=None)
@hypothesis.given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=12).map("".join), min_size=1, max_size=5))
def test_pieces_like_the_pattern(texts):
    import regex
    if not hasattr(test_pieces_like_the_pattern, "classes"):
        test_pieces_like_the_pattern.classes = pieces.code_point_classes()
    data, off, before = pieces.split(pa.array([t.encode() for t in texts], pa.large_binary()), test_pieces_like_the_pattern.classes)
    got = [[data[off[i]:off[i + 1]].tobytes().decode() for i in range(before[k], before[k + 1])] for k in range(len(texts))]
    assert got == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]


def test_bpe_round_trip(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(spark, docs, bpe.rank_file(path)).select("row.doc_id", "n_tokens", "ids")
    out = bpe.decode(coded.withColumn("same", F.col("ids")), ranks).collect()
    want = []
    for d, t in TEXTS:
        ids = enc.encode_ordinary(t or "")
        want.append({"doc_id": d, "n_tokens": len(ids), "same": np.array(ids, "<u4").tobytes(), "decoded": (t or "").encode()})
    cols = ("n_tokens", "same", "decoded")
    assert by_row([{**r.asDict(), "same": bytes(r["same"]), "decoded": bytes(r["decoded"])} for r in out], *cols) == by_row(want, *cols)
    assert bpe.decode(bpe.encode(spark, none, ranks), ranks).count() == 0
    at_once = bpe.encode(spark, docs, ranks, decoded=True).select("row.doc_id", "decoded").collect()
    assert by_row([{"doc_id": r["doc_id"], "d": bytes(r["decoded"])} for r in at_once], "d") == \
        by_row([{"doc_id": d, "d": (t or "").encode()} for d, t in TEXTS], "d")


def packed_rightly(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rows = packing.pack_documents(spark, docs, path).collect()
    want = [{"doc_id": d, "p": p} for d, text in TEXTS
            for p in brute.pieces([*t.encode(text or "", add_special_tokens=False).ids, 0])]
    got = [{"doc_id": r["doc_id"], "p": (r["piece"], r["start"], r["length"], r["ids_crc32"])} for r in rows]
    assert by_row(got, "p") == by_row(want, "p")
    n = packed_rightly(rows, packing.CAPACITY)
    assert n == -(-sum(r["length"] for r in rows) // packing.CAPACITY)
    assert packing.pack_documents(spark, none, path).count() == 0


@hypothesis.settings(max_examples=60, deadline=None)
@hypothesis.given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1))
def test_configurations_hold_every_piece(hist):
    plan = packing.configurations(np.array(list(hist)), np.array(list(hist.values())), 64)
    held = {}
    for config, times in plan:
        assert times > 0 and sum(s * a for s, a in config.items()) <= 64
        for s, a in config.items():
            held[s] = held.get(s, 0) + a * times
    assert held == hist
    # no two sequences could be one: at most one is half empty
    assert sum(m for c, m in plan if 2 * sum(s * a for s, a in c.items()) <= 64) <= 1


def test_sharding(spark, docs, none, tmp_path):
    rows = sharding.extendible_shards(spark, docs, max_bytes=5000, step=1).collect()
    assert by_row(rows, "n_bytes") == by_row([{"doc_id": d, "n_bytes": len((t or "").encode())} for d, t in TEXTS], "n_bytes")
    size = {}
    for r in rows:
        size[r["shard"]] = size.get(r["shard"], 0) + r["n_bytes"]
    total = {}
    for r in rows:
        assert r["shard_bytes"] == size[r["shard"]]
        assert r["oversized"] == (size[r["shard"]] > 5000) == (len(r["shard"]) == sharding.HASH_BITS)
        for k in range(len(r["shard"])):                # every bucket above had to split
            total[r["shard"][:k]] = total.get(r["shard"][:k], 0) + r["n_bytes"]
    assert all(v > 5000 for v in total.values())
    deep = sharding.extendible_shards(spark, docs, max_bytes=5000, step=7).collect()
    assert by_row(deep, "shard", "shard_docs") == by_row(rows, "shard", "shard_docs")
    assert sharding.extendible_shards(spark, none).count() == 0
    path = f"{tmp_path}/shards"
    buckets = sharding.write_shards(spark, docs, path, max_bytes=5000)
    back = spark.read.parquet(path)
    assert back.count() == len(TEXTS) and back.select("shard_bits").distinct().count() == buckets.count()


def test_binomial_tail_equals_the_sum():
    from math import comb
    for n, p in ((1, 0.5), (7, 0.01), (60, 0.3), (400, 0.01), (900, 0.97)):
        for k in range(-1, n + 2, max(1, n // 30)):
            want = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(0, min(k, n) + 1))
            assert quality_rules.binomial_tail(k, n, p) == pytest.approx(min(1.0, want), rel=1e-9, abs=1e-13)
    assert quality_rules.binomial_tail(10_000_000 // 100, 10_000_000, 0.01) == pytest.approx(0.5, abs=0.01)


def test_copied_holdouts_are_one_trial(spark):
    """Cutoffs do not change when labelled good texts are copied, under other ids and on other strata's names."""
    def base(i):
        return f"u{i} " + " ".join(f"w{(i * 37 + k * k) % 311}" for k in range(80))
    good = [(i, base(i), "en") for i in range(700)]
    bad = [(1000 + i, base(i) + " #!#" * (20 + i % 40), "en") for i in range(300)]
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good] + [(i, 0) for i, _, _ in bad], "doc_id long, quality int")
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    copies = [(10_000 + 10 * i + k, t, s) for i, t, s in good[:30] for k in range(10)]
    more_labels = labels.unionByName(spark.createDataFrame([(i, 1) for i, _, _ in copies], "doc_id long, quality int"))
    more = docs.unionByName(spark.createDataFrame(copies, docs.schema))

    def kept(d, y):
        return {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(spark, d, y).collect()}
    one, two = kept(docs, labels), kept(more, more_labels)
    assert {i: two[i] for i in one} == one
    assert sum(one[i] for i, _, _ in good) >= 0.98 * len(good) and sum(one[i] for i, _, _ in bad) < 0.2 * len(bad)
    # a stream of copies alone certifies nothing: 300 rows, one trial
    same = spark.createDataFrame([(i, base(1), "xx") for i in range(300)] + [(500 + i, base(2) + " #" * 20, "xx") for i in range(50)],
                                 docs.schema)
    y = spark.createDataFrame([(i, 1) for i in range(300)] + [(500 + i, 0) for i in range(50)], "doc_id long, quality int")
    assert all(kept(same, y).values())
    good_rows = quality_rules.keep_good(spark, more.withColumn("row", F.lit(1)), more_labels)
    assert good_rows.columns == ["doc_id", "text", "lang", "row"]
    assert sorted(r["doc_id"] for r in good_rows.collect()) == sorted(i for i, k in two.items() if k)


def test_keep_one_judges_rows_of_a_doc_id_by_text(spark):
    a, b = (" ".join(f"{s}{k * k % 97}" for k in range(60)) for s in "ab")
    rows = [(2, b, 1), (5, a, 2), (5, b, 3), (7, a, 4), (None, a, 5), (9, None, 6), (9, None, 7), (9, "", 8), (5, a, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = simhash_trie.keep_one(spark, docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert got == sorted([(2, b), (5, a), (0, a), (9, "")])


def test_shards_with_a_clashing_column(spark):
    from feedloom.session import scratch_path
    path = scratch_path(spark, "t-shards")
    docs = spark.createDataFrame([(i, "x" * 50, i, "y") for i in range(40)], "doc_id long, text string, shard_bits int, `Shard_Bits_` string")
    sharding.write_shards(spark, docs, path, max_bytes=500)
    back = spark.read.parquet(path)
    assert back.count() == 40 and back.filter("shard_bits <> doc_id").count() == 0
