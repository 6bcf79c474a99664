import gzip
import hashlib
import io

import numpy as np
import pytest

from feedloom.llm import ann, toxicity, warc
from feedloom.session import scratch_path

# -- toxicity ---------------------------------------------------------------


def labelled(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in rows], "doc_id long, text string, score string, feature double")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if y is not None], "doc_id long, quality int, toxic int")
    return docs, labels


def neutral(i):
    return " ".join(f"w{(i * 13 + k * k) % 97}" for k in range(12))


def test_toxicity_learns_and_scores_everything(spark):
    rows = [(i, neutral(i) + (" you stupid fool." if i % 4 == 0 else " fine."), int(i % 4 == 0)) for i in range(400)]
    extra = [(None, "no id stupid", None), (900, None, None), (901, "", None), (902, " \n ", None), (903, "stupid " * 50_000, None),
             (904, "STUPID!", None), (905, neutral(5), None), (905, neutral(5), None)]
    docs, labels = labelled(spark, rows + extra)
    bias, weights = toxicity.learn(spark, docs, labels.unionByName(labels).union(
        spark.createDataFrame([(None, 1, 1), (5, None, None)], labels.schema)))
    got = [(r["doc_id"], r["score"]) for r in toxicity.score(docs, bias, weights).collect()]
    assert len(got) == len(rows) + len(extra) and all(0 <= s <= 1 for _, s in got)
    by = dict(got)
    assert all((by[i] >= 0.5) == bool(y) for i, _, y in rows)
    assert by[None] >= 0.5 and by[903] >= 0.5 and by[904] >= 0.5
    assert by[900] == by[901] == by[902] < 0.5 and by[905] < 0.5
    # bounded sample and empty tables
    assert toxicity.learn(spark, docs, labels, per_class=20)[1]
    b, w = toxicity.learn(spark, docs.limit(0), labels)
    assert not w and toxicity.score(docs.limit(0), b, w).count() == 0


def test_identity_swaps_take_weight_off_group_names(spark):
    # "muslims" stands in toxic rows only, so plain training blames the word
    rows = [(i, f"muslims are stupid {neutral(i)}." if i % 3 == 0 else f"{neutral(i)} nothing here.", int(i % 3 == 0))
            for i in range(300)]
    docs, labels = labelled(spark, rows)
    mention = spark.createDataFrame([(1, "muslims live here"), (2, "christians live here"), (3, "stupid")], "doc_id long, text string")
    score = {}
    for weight in (0.0, toxicity.SWAP_WEIGHT):
        model = toxicity.learn(spark, docs, labels, swap_weight=weight)
        score[weight] = {r["doc_id"]: r["score"] for r in toxicity.score(mention, *model).collect()}
    plain, swapped = score[0.0], score[toxicity.SWAP_WEIGHT]
    assert plain[1] >= 0.5 and swapped[1] < 0.5 <= swapped[3]
    assert abs(swapped[1] - swapped[2]) < 0.5 * abs(plain[1] - plain[2])


def test_swaps_of_a_sentence():
    gained = toxicity.swaps("The women came. Nobody else.")
    assert len(gained) == len(toxicity.IDENTITIES["gender"]) - 1
    assert all(lost == tuple(toxicity.token_features("women")) for _, lost in gained)


# -- WARC -------------------------------------------------------------------

BODY = "<html>" + "same page " * 40 + "</html>"
PAGES = [(7, "http://a/7", BODY), (3, "http://a/3", BODY), (9, None, BODY), (4, "http://a/4", "short"), (5, "http://a/5", "short"),
         (1, "http://a/ 1\r\n", None), (2, "http://a/2", ""), (None, "http://a/n", BODY), (3, "http://a/3", BODY),
         (12, "http://a/ä", "long ä " * 60_000), (13, "http://a/13", "<p>\x1f\x8b\x08 WARC/1.1\r\n\r\n</p>" * 9)]


def expected_pages():
    out = []
    for i, _, html in PAGES:
        b = (html or "").encode()
        same = [j for j, _, h in PAGES if j is not None and (h or "").encode() == b]
        first = min(same, default=None) if len(b) >= 100 else None
        revisit = i is not None and first is not None and i > first
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in PAGES], "page_id long, url string, html string, digest string, n int").repartition(3)


@pytest.mark.parametrize("range_bytes", [97, 1000, 1 << 22])
def test_warc_round_trip_for_any_range(spark, pages, range_bytes):
    files = warc.write_warc(spark, pages, scratch_path(spark, "t-warc"))
    rows = warc.read_warc(files.select("path", "size"), range_bytes, with_payload=True)
    rows = rows.withColumn("page_id", warc.page_number("record_id")).withColumn("ref", warc.page_number("refers_to")).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["ref"]) for r in rows), key=str)
    assert got == expected_pages()
    body = {i: (h or "").encode() for i, _, h in PAGES}
    assert all(bytes(r["payload"]) == body[r["page_id"]] for r in rows if r["record_type"] == "response")
    assert {r["target_uri"] for r in rows if r["page_id"] == 1} == {"http://a/%201%0D%0A"}


def test_warc_files_are_plain_gzip_members(spark, pages):
    folder = scratch_path(spark, "t-warc")
    files = warc.write_warc(spark, pages, folder).collect()
    listed = warc.archive_files(spark, folder).collect()
    assert sorted(r["size"] for r in listed) == sorted(r["size"] for r in files)
    n = 0
    for r in files:
        raw = open(r["path"].removeprefix("file://"), "rb").read()
        n += gzip.GzipFile(fileobj=io.BytesIO(raw)).read().count(b"WARC-Record-ID")
    assert n == len(PAGES) == sum(r["records"] for r in files)
    empty = warc.archive_pages(spark, pages.limit(0))
    assert empty.count() == 0


class Bytes:
    def __init__(self, raw):
        self.raw = raw

    def read_at(self, n, at):
        return self.raw[at:at + n]


def test_a_damaged_archive_is_reported():
    raw = warc.record(1, "u", b"x" * 500, hashlib.sha256(b"x" * 500).hexdigest(), None)
    noise = warc.MAGIC + b"no gzip here" + gzip.compress(b"not a record")
    source = noise + raw
    assert [at for at, _, _ in warc.scan(warc.Window(Bytes(source), len(source)), 0, len(source))] == [len(noise)]
    cut = source[:-20]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.scan(warc.Window(Bytes(cut), len(cut)), 0, len(cut)))


# -- nearest neighbours -----------------------------------------------------


def vectors(n, d=24, seed=3, unit=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + 2 * rng.normal(size=(12, d))[rng.integers(0, 12, n)]
    return (x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x * rng.uniform(.5, 2, (n, 1))).astype(np.float32)


@pytest.mark.parametrize("unit", [True, False])
def test_nearest_recall(spark, unit, monkeypatch):
    x = vectors(3000, unit=unit)
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 1100)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 70)
    df = spark.createDataFrame([(i, v.tolist(), "clash") for i, v in enumerate(x)], "id long, x array<float>, vb string")
    rows = ann.nearest(spark, df, df.filter("id % 20 = 0").select("id"), k=20).collect()
    assert len(rows) == 150 * 20
    s, hit = x.astype(float) @ x.astype(float).T, 0
    for q in range(0, 3000, 20):
        mine = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        s[q, q] = -np.inf
        assert np.allclose([r["score"] for r in mine], s[q, [r["vec_id"] for r in mine]], atol=1e-9)
        assert all((-a["score"], a["vec_id"]) < (-b["score"], b["vec_id"]) for a, b in zip(mine, mine[1:]))
        hit += len(set(np.argsort(-s[q])[:20]) & {r["vec_id"] for r in mine})
    assert hit / (150 * 20) >= 0.9


def test_nearest_odd_rows(spark):
    good = [(i, [float(i % 3), 1.0, 0.5]) for i in range(0, 12)]
    odd = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [float("nan"), 1.0, 1.0]), (180, [float("inf"), 1.0, 1.0]),
           (200, [1.0, 2.0]), (None, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(good + odd, "id long, x array<float>")
    rows = ann.nearest(spark, df, df.filter("id % 20 = 0").select("id"), k=20).collect()
    assert {r["query_id"] for r in rows} == {0}            # the only usable query; fewer than 20 candidates: all
    want = sorted(range(1, 12), key=lambda i: (-sum(a * b for a, b in zip(good[i][1], good[0][1])), i))
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"])] == want
    assert ann.nearest(spark, df.limit(0), df.select("id")).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (400, 16)).astype(np.uint16)
    q = codes[:5] ^ (rng.random((5, 16)) < .2).astype(np.uint16)
    for radius in (0, 3, 17, 100, 256):
        far = np.bitwise_count(codes[None] ^ q[:, None]).sum(2, dtype=int)
        assert (ann.Index(codes).within(q, radius) == (far <= radius)).all()
