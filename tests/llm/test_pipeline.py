"""The pipeline against the plain versions of its stages, one after another."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from feedloom.llm import quality_rules
from feedloom.llm.common import cut
from tests.llm import brute

WORDS = " ".join(f"word{i}" for i in range(200))
SMALL = "/root/testdata/sf0.001"


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").orderBy("doc_id").collect()]


def test_stages_like_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)

    def stage(name, d):
        out = cut(spark, steps[name](spark, d, SMALL), "t-stage")
        if name != "best-fit packing":
            assert out.columns == columns
            assert out.filter(F.col("n_chars") != F.char_length("text")).count() == 0
        return out

    good = stage("quality rules", docs)
    # the base rule by hand; the labels are too few here to certify a cutoff
    keep = []
    for d, t in texts(docs):
        n, _, _, _, repeats = brute.base_counts(t)
        if n >= quality_rules.MIN_WORDS and 100 * repeats <= quality_rules.REPEAT_PERCENT * n:
            keep.append((d, t))
    assert texts(good) == keep

    lined = stage("line dedup", good)
    want = brute.drop_later_lines(keep)
    assert texts(lined) == sorted(want.items())

    single = stage("SimHash near-dedup", lined)
    rows = texts(lined)
    of = brute.near_components([brute.fingerprint(t) for _, t in rows])
    least = {}
    for d, t in rows:
        least.setdefault(of[brute.fingerprint(t)], d)
    assert [d for d, _ in texts(single)] == sorted(least.values())

    cut_down = stage("suffix-array dedup", single)
    rows = texts(single)
    gone = brute.repeated_bytes([t.encode() for _, t in rows], corpus_pipeline.REPEATED)
    assert texts(cut_down) == [(d, np.frombuffer(t.encode(), np.uint8)[~g].tobytes().decode("utf-8", "ignore"))
                               for (d, t), g in zip(rows, gone)]

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    packed = stage("best-fit packing", cut_down).collect()
    want = [(d, *p) for d, x in texts(cut_down) for p in brute.pieces([*t.encode(x, add_special_tokens=False).ids, 0])]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == sorted(want)
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole) == \
        sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, None, "s", None), (3, WORDS, "en", None, 1),
            (3, WORDS, "en", None, 1), (4, " ".join(f"x{i} of" for i in range(30_000)), "en", "s", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, fp string"
    d = spark.createDataFrame([(*r, "a", "b") for r in rows], schema)
    out = stage(spark, d, SMALL)
    last = stage is corpus_pipeline.STAGES[-1][1]
    assert last or out.columns == d.columns
    assert out.count() > 0
    assert stage(spark, d.limit(0), SMALL).count() == 0
