"""Packing where no configuration is exactly full, and the tokenizer's added tokens."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from feedloom.llm import packing, queries
from tests.llm import brute


@pytest.mark.parametrize("hist,best", [
    ({1033: 600, 531: 600, 522: 600, 492: 1200}, 900),        # material bound 900; exactly full ones do not exist
    ({1000: 90, 500: 60, 30: 30}, 60),
    ({683: 900, 682: 900, 100: 10}, 607),
])
def test_configurations_below_capacity_are_taken(hist, best):
    plan = packing.configurations(np.array(list(hist)), np.array(list(hist.values())))
    held = {}
    for config, times in plan:
        assert times > 0 and sum(s * a for s, a in config.items()) <= packing.CAPACITY
        for s, a in config.items():
            held[s] = held.get(s, 0) + a * times
    assert held == hist
    assert sum(times for _, times in plan) <= best


def test_queries_know_the_added_tokens(spark, tmp_path):
    end = "<|endoftext|>"
    texts = [f"a b{end} c", end, f"{end}{end}", f"x  {end}  it's{end}", "<|endof", "text|> tail", None, f"<{end}>",
             f"word {end} " * 1500, "plain words"]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert 50256 in t.encode(texts[0], add_special_tokens=False).ids
    want = sorted((d, *p) for d, x in rows for p in brute.pieces([*t.encode(x or "", add_special_tokens=False).ids, 0]))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for out in (queries.op8_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out.collect()]
        assert sorted(got) == want


def held(plan):
    have = {}
    for config, times in plan:
        assert sum(s * a for s, a in config.items()) <= packing.CAPACITY
        for s, a in config.items():
            have[s] = have.get(s, 0) + a * times
    return have


def histogram(seed, lengths, copies, longest):
    r = np.random.default_rng(seed)
    size = np.sort(r.choice(np.arange(1, longest + 1), lengths, replace=False))
    return size, r.integers(1, copies + 1, lengths)


@pytest.mark.parametrize("seed,lengths,copies,longest,pivots", [
    (0, 619, 2, 2048, 2000), (1, 619, 3, 1024, 2000), (2, 250, 3, 2048, 500), (3, 300, 5, 700, 500), (4, 60, 1, 2048, 50)])
def test_program_survives_many_pivots(monkeypatch, seed, lengths, copies, longest, pivots):
    size, count = histogram(seed, lengths, copies, longest)
    entered = []
    inverted = np.linalg.inv
    monkeypatch.setattr(np.linalg, "inv", lambda a: (entered.append(1), inverted(a))[1])
    known = packing.weighted(size, count, 2048, 2048) + packing.weighted(size, count, 2048, 1025)
    solved = packing.program(size, count, 2048, known, 1 << 40)        # nothing ends it early
    assert len(entered) > pivots // packing.REFACTOR // 4
    kept, rest = solved
    assert (rest >= 0).all()
    got = held(kept + packing.best_fit(size, rest, 2048))
    assert got == dict(zip(size.tolist(), count.tolist()))


def test_plans_are_never_longer_than_the_weighted_one():
    for seed in range(12):
        size, count = histogram(seed, 40 + 25 * seed, 1 + seed % 4, [2048, 1500, 900][seed % 3])
        plan = packing.configurations(size, count)
        assert held(plan) == dict(zip(size.tolist(), count.tolist()))
        least = packing.least_sequences(size, count, 2048)
        assert least <= packing.sequences(plan) <= packing.sequences(packing.weighted(size, count, 2048, 2048))


def test_lost_basis_leaves_the_weighted_plan(monkeypatch):
    def lost(_):
        raise np.linalg.LinAlgError("Singular matrix")
    size, count = np.array([492, 522, 531, 1033]), np.array([1200, 600, 600, 600])
    assert packing.sequences(packing.configurations(size, count)) == 900
    monkeypatch.setattr(np.linalg, "inv", lost)
    plan = packing.configurations(size, count)
    assert held(plan) == dict(zip(size.tolist(), count.tolist()))


def test_lower_bound_is_one():
    import itertools
    r = np.random.default_rng(9)
    for _ in range(200):
        pieces = sorted(r.integers(1, 11, r.integers(1, 7)).tolist())
        size, count = np.unique(pieces, return_counts=True)
        best = len(pieces)
        for groups in itertools.product(range(len(pieces)), repeat=len(pieces)):
            used = {}
            for p, g in zip(pieces, groups):
                used[g] = used.get(g, 0) + p
            if max(used.values()) <= 10:
                best = min(best, len(used))
            if len(pieces) > 5:
                break
        if len(pieces) <= 5:
            assert packing.least_sequences(size, count, 10) <= best
