import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedloom.llm import alignment as al
from feedloom.llm.common import pack
from feedloom.llm.packing import byte_ranks
from feedloom.llm.pieces import code_point_classes

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ZERO = (0, 0, 0, 0, 0, 0, "")


def plain(texts):
    """The contract, one whole text at a time, by the libraries themselves."""
    tok = Tokenizer.from_file(A_FILE)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    token_a = {i: t for t, i in byte_ranks(A_FILE).items()}
    token_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
               for i in range(sp.get_piece_size())]
    found, docs = [], collections.Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a, b = (tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        if not text or b"".join(token_a[i] for i in a) != raw or b"".join(token_b[i] for i in b) != raw:
            found.append(None)
            continue
        ea, eb = (np.cumsum([len(t[i]) for i in x]).tolist() for t, x in ((token_a, a), (token_b, b)))
        common = sorted(set(ea) & set(eb))
        groups, links, lo = [], [], 0
        for end in common:
            ga = [k for k, e in enumerate(ea) if lo < e <= end]
            gb = [k for k, e in enumerate(eb) if lo < e <= end]
            groups.append(",".join(str(a[k]) for k in ga) + "|" + ",".join(str(b[k]) for k in gb))
            links += [(a[i], b[j]) for i in ga for j in gb
                      if max(ea[i - 1] if i else 0, eb[j - 1] if j else 0) < min(ea[i], eb[j])]
            lo = end
        docs.update(set(links))
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = collections.Counter()
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    return [ZERO if f is None else
            (*f[:3], len(f[3]), sum(docs[x] == most[x[0]] for x in f[3]), sum(docs[x] for x in f[3]),
             hashlib.sha256(f[4].encode()).hexdigest()) for f in found]


def aligned(spark, rows, schema="doc_id long, text string", **more):
    df = spark.createDataFrame(rows, schema)
    return al.align(spark, df, A_FILE, B_FILE, **more).select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()


def odd_texts():
    rng = random.Random(3)
    parts = ["the", "cat's", "naïve", "東京都", "😀👍🏽", "x" * 30, "\n\n", "\t", "  ", "   \n", "1234567", "don't", "<s>", "<|endoftext|>",
             "<0x41>", "á", " ", "'re", "!!!", "　", "é", "ß", "\x00", "ſ", "‍"]
    texts = [None, "", " ", "  ", " a", "a ", "a  ", "▁", "a▁b", "x ▁", "\n", "é", "東", "́x", "the the", "x" * 3000]
    texts += ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += ["the cat sat on the mat. " * 300, "東京都に行く。" * 300, "naïve é " * 700]
    return texts + texts[20:40]


@pytest.mark.parametrize("chunk", [64, 700, 1 << 20])
def test_equals_the_libraries(spark, chunk):
    texts = odd_texts()
    want = collections.Counter((i, *w) for i, w in enumerate(plain(texts)))
    got = collections.Counter(tuple(r) for r in aligned(spark, list(enumerate(texts)), chunk_bytes=chunk))
    assert got == want


def test_given_documents(spark):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    want = collections.Counter((i, *w) for i, w in enumerate(plain(texts)))
    got = collections.Counter(tuple(r) for r in aligned(spark, list(enumerate(texts)), chunk_bytes=2000))
    assert got == want


def test_composition_is_associative():
    v = al.Vocabularies(byte_ranks(A_FILE), open(B_FILE, "rb").read(), pack(code_point_classes()))
    rng = random.Random(8)
    same = lambda x, y: all(np.array_equal(a, b) for a, b in zip(flat(x), flat(y)))

    def flat(f):
        return [f.ok, f.closed, f.text, f.n_groups, f.keys, f.counts, f.n_a, f.n_b,
                *[c for side in (*f.prefix, *f.suffix) for c in side]]
    for _ in range(200):
        # ends of both sides over 40 bytes, handed to three ranges that begin apart for A and B
        ends = [np.array(sorted(rng.sample(range(1, 40), rng.randrange(0, 20))) + [40]) for _ in range(2)]
        sides = [al.Side(np.array([rng.randrange(900) for _ in e]), e) for e in ends]
        cuts = [[0, *sorted(rng.sample(range(41), 2)), 40] for _ in range(2)]
        f = [al.settled(v, *[s.of((s.ends > c[k]) & (s.ends <= c[k + 1])) for s, c in zip(sides, cuts)], False) for k in range(3)]
        left, right = al.composed(v, al.composed(v, f[0], f[1]), f[2]), al.composed(v, f[0], al.composed(v, f[1], f[2]))
        whole = al.settled(v, *sides, False)
        assert same(left, right) and same(left, whole)
        assert same(al.composed(v, al.START, whole), al.settled(v, *sides, True))


def test_tables_without_rows_and_clashing_columns(spark):
    assert aligned(spark, []) == []
    rows = aligned(spark, [(None, "a b", 1, "x", 2.0, "q"), (None, "a b", 1, "x", 2.0, "q"), (7, None, None, None, None, None)],
                   "doc_id long, text string, n_a int, `row` string, fragment double, `a.b` string")
    assert collections.Counter(tuple(r) for r in rows) == collections.Counter(
        [(None, *w) for w in plain(["a b", "a b"])] + [(7, *ZERO)])


def test_pieces_across_blanks_are_noticed():
    v = al.Vocabularies({bytes([b]): b for b in range(256)}, open(B_FILE, "rb").read(), pack(code_point_classes()))
    assert v.parts
    v.parts = False                       # whole texts then: the same tokens
    import pyarrow as pa
    arr = pa.array([b" the cat  sat\n on", b" x"], pa.large_binary())
    whole = v.side_b(arr)
    v.parts = True
    assert all(np.array_equal(x, y) for x, y in zip(whole, v.side_b(arr)))
