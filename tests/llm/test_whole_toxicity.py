"""Identity swaps in the common forms of a term, and with a table of one's own."""

import pytest

from feedloom.llm import toxicity


def test_like_forms_are_swapped():
    for word, other in (("muslim", "jewish"), ("woman", "man"), ("black", "white"), ("immigrant", "refugee"), ("asian", "african"),
                        ("gays", "lesbians"), ("jüdische", "christliche"), ("musulmane", "juive"), ("negra", "blanca")):
        pairs = toxicity.swaps(f"A {word.upper()} neighbour.")
        assert (tuple(toxicity.token_features(other)), tuple(toxicity.token_features(word))) in pairs
        assert not any(gained == tuple(toxicity.token_features("frauen")) for gained, _ in pairs)
    assert len(toxicity.swaps("a red car", {"colour": ("red", "blue")})) == 1 and not toxicity.swaps("a red car")


@pytest.mark.parametrize("term", ["muslim", "black"])
def test_neutral_mentions_are_not_toxic(spark, term):
    # the term stands in toxic rows only, so plain training blames the word
    neutral = lambda i: " ".join(f"w{(i * 13 + k * k) % 97}" for k in range(12))
    rows = [(i, f"{term} people are stupid {neutral(i)}." if i % 3 == 0 else f"people are {neutral(i)} nothing here.", int(i % 3 == 0))
            for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    mention = spark.createDataFrame([(1, f"a {term} family lives here"), (2, "stupid")], "doc_id long, text string")
    score = [{r["doc_id"]: r["score"] for r in toxicity.score(mention, *toxicity.learn(spark, docs, labels, swap_weight=w)).collect()}
             for w in (0.0, toxicity.SWAP_WEIGHT)]
    assert score[0][1] >= 0.5 and score[1][1] < 0.5 <= score[1][2]
