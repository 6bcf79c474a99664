"""Quality rules with risk-controlled thresholds.

Base statistics are taken of every whole text.  On top of them stand rules of
the form "ratio above a cutoff means reject".  No cutoff is set by hand: they
are learned from labelled documents, separately per stratum, so that the share
of good documents (quality 1) that the rules together reject is at most
``alpha`` in every stratum, with probability at least 1 - ``delta``.

Trials are distinct texts: labelled copies of one text count once (in each stratum, as
the lowest quality), and all of them are in the same half, so the trials are what the
bound takes them for.

1. One half of the labelled texts (by a hash of the text) proposes: level t of a
   ladder puts every rule's cutoff at a quantile of the good documents' ratios
   (the loosest levels at their largest value with a margin), so rejection sets
   are nested from loose to tight.
2. The other half certifies: at each level the rejected good documents k of n
   give the exact binomial tail P(Bin(n, alpha) <= k).  Levels are tested from
   loose to tight and testing stops at the first failure (fixed sequence, so
   no correction is due inside a stratum); across strata the level is
   delta / (number of strata) (Bonferroni).
3. Of the certified levels the one with most bad minus good rejections on the
   proposing half is used; a stratum with none rejects nothing by ratios.

Defined cases: null text has no words (all counts 0, fails the base rule); a
null stratum is a stratum of its own; null doc_id rows get statistics and never
match a label; repeated rows each get a row; labels of one doc_id listed more
than once count once, as the lowest quality; an empty table gives no rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from feedloom.llm.common import binary, cut, dictionary, per_row, slices, view

#: fixed values: the contract's symbol characters and base limits
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50

#: levels from loose to tight: (share of good documents above the quantile, stretch, added steps)
LADDER = ((0.0, 2.0, 50), (0.0, 1.5, 25), (0.0, 1.2, 10), (0.0, 1.0, 0),
          (0.0005, 1.0, 0), (0.001, 1.0, 0), (0.002, 1.0, 0), (0.004, 1.0, 0), (0.008, 1.0, 0))
BINS = 1000
#: rule -> (numerator, denominator, scale): the ratio times scale, in BINS steps
RULES = {
    "symbols": ("n_symbols", "n_words", 1.0),
    "dup_lines": ("n_dup_lines", "n_lines", 1.0),
    "repeats": ("n_repeat_words", "n_words", 1.0),
    "upper": ("n_upper", "word_chars", 1.0),
    "digits": ("n_digits", "word_chars", 1.0),
    "marks": ("n_marks", "word_chars", 1.0),
    "short_lines": ("n_lines", "n_words", 1.0),
    "long_words": ("word_chars", "n_words", 0.02),
    "same_words": ("n_again", "n_words", 1.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks", "n_again")
#: broadcast the cutoffs up to so many strata, join by shuffle beyond
MAX_BROADCAST_STRATA = 10_000


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SPACE = _table(b" \t\n\r\x0b\x0c")
_SYMBOL = _table(SYMBOLS)
_UPPER = _table(bytes(range(65, 91)))
_DIGIT = _table(bytes(range(48, 58)))
_MARK = _table(b"!?;:=_~^@\"'()[]{}/\\")


def text_counts(arr: pa.LargeBinaryArray) -> dict[str, np.ndarray]:
    """COUNTS of each text of a slice, vectorised over its bytes."""
    data, off = view(arr)
    space = _SPACE[data]
    n = len(off) - 1
    lead = np.zeros(len(data) + 1, bool)      # first bytes of documents
    lead[off[:-1]] = True
    lead = lead[:len(data)]
    chars = ~space & ((data & 0xC0) != 0x80)  # first bytes of the words' code points
    out = {"word_chars": per_row(chars, off), "n_symbols": per_row(_SYMBOL[data], off),
           "n_upper": per_row(_UPPER[data], off), "n_digits": per_row(_DIGIT[data], off),
           "n_marks": per_row(_MARK[data], off)}
    after = np.ones(len(data), bool)
    after[1:] = space[:-1]
    starts = np.flatnonzero(~space & (after | lead))
    words_at = np.searchsorted(starts, off)
    out["n_words"] = np.diff(words_at)

    # words: their bytes back to back without white space
    solid = np.cumsum(~space) - ~space
    word_off = np.append(solid[starts], int((~space).sum()))
    code, values = dictionary(data[~space], word_off)
    code, size = code.astype(np.int64), len(values) + 1
    doc = np.repeat(np.arange(n), np.diff(words_at))
    out["n_again"] = out["n_words"] - np.bincount(np.unique(doc * size + code) // size, minlength=n)
    covered = np.zeros(len(code), bool)
    if len(code) >= 3:
        same = doc[2:] == doc[:-2]
        pair = dictionary_pairs(code[:-1], code[1:], size)
        tri = dictionary_pairs(pair[:-1], code[2:], size)
        at = np.flatnonzero(same)
        d, t = doc[at], tri[at]
        order = np.lexsort((t, d))
        equal = (np.diff(d[order]) == 0) & (np.diff(t[order]) == 0)
        twice = np.zeros(len(order), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        hit = at[order[twice]]
        for k in range(3):
            covered[hit + k] = True
    out["n_repeat_words"] = per_row(covered, words_at)

    # lines: split at \n and at document ends
    newline = data == 10
    ends = np.sort(np.concatenate([np.flatnonzero(newline), off[1:]]), kind="stable")
    kept = np.concatenate([[0], np.cumsum(~newline)])
    line_off = np.concatenate([[0], kept[ends]])
    per_doc = per_row(newline, off) + 1
    line_doc = np.repeat(np.arange(n), per_doc)
    worded = per_row(~space[~newline], line_off) > 0
    lcode, lvalues = dictionary(data[~newline], line_off)
    key = (line_doc * (len(lvalues) + 1) + lcode)[worded]
    out["n_lines"] = np.bincount(line_doc[worded], minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(np.unique(key) // (len(lvalues) + 1), minlength=n)
    return out


def dictionary_pairs(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Dense ids of the pairs (a, b), b < size."""
    return np.unique(a * size + b, return_inverse=True)[1].astype(np.int64)


def with_counts(docs: DataFrame, stratum: str | None = "lang", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(row struct of the columns ``carry``, stratum, COUNTS) of every document; no shuffle."""
    has = stratum is not None and stratum in docs.columns
    src = docs.select(F.struct(*carry).alias("row"),
                      (F.col(stratum).cast("string") if has else F.lit(None).cast("string")).alias("stratum"), "text")

    def run(batches):
        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("text"))):
                c = text_counts(arr)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("stratum"), *[pa.array(c[k], pa.int64()) for k in COUNTS]],
                    names=["row", "stratum", *COUNTS])

    schema = StructType([src.schema["row"], src.schema["stratum"]])
    for k in COUNTS:
        schema = schema.add(k, LongType())
    return src.mapInArrow(run, schema)


def _bins(df: DataFrame) -> DataFrame:
    """Adds ``bins``: array of the rules' ratios in steps, in the order of RULES."""
    one = lambda a, b, s: F.least(F.lit(BINS), F.floor(
        F.col(a) * F.lit(s * BINS) / F.greatest(F.col(b), F.lit(1)))).cast("int")
    return df.withColumn("bins", F.array(*[one(*r) for r in RULES.values()]))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k) to double precision, by the continued fraction of the incomplete beta
    function: some sqrt(n) steps at most, whatever k."""
    if n == 0 or k >= n:
        return 1.0
    if k < 0:
        return 0.0
    # P(Bin(n, p) <= k) = I_{1-p}(n - k, k + 1); the fraction converges below the mean
    a, b, x = n - k, k + 1, 1 - p
    turned = x > (a + 1) / (a + b + 2)
    if turned:
        a, b, x = b, a, p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100 + 20 * math.isqrt(n)):
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                  -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + t * d, 1 + t / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, max(0.0, 1 - front * h if turned else front * h))


def choose_level(good: np.ndarray, gain: np.ndarray, n_good: int, alpha: float, level: float) -> int:
    """Index of the certified ladder level with the largest gain, loosest on ties; -1 if none.

    good[t]: good holdout documents that levels up to t reject; n_good: all of them."""
    best = -1
    for t in range(len(good)):
        if n_good == 0 or binomial_tail(int(good[t]), n_good, alpha) > level:
            break
        if best < 0 or gain[t] > gain[best]:
            best = t
    return best


def learn_cutoffs(spark: SparkSession, counts: DataFrame, labels: DataFrame, alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """One row per stratum with a certified level: (stratum_key, cuts array<int>).

    counts: (doc_id, stratum, text_md5, COUNTS).

    Everything is aggregated to histograms (strata x rules x BINS) before a group
    meets in one task; no labelled row is dropped or sampled."""
    lab = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    # one trial a text: copies are no further evidence, and never on both halves
    rows = (_bins(counts).join(lab, "doc_id")
            .groupBy(F.coalesce(F.concat(F.lit("="), "stratum"), F.lit("")).alias("stratum_key"), "text_md5")
            .agg(F.min("bins").alias("bins"), F.min("quality").alias("quality"))
            .select("stratum_key", "bins", (F.col("quality") == 1).alias("good"),
                    (F.pmod(F.xxhash64("text_md5"), F.lit(2)) == 0).alias("proposes")))
    rows = cut(spark, rows, "quality-trials")
    hist = (rows.filter("good and proposes")
            .select("stratum_key", F.posexplode("bins").alias("rule", "bin"))
            .groupBy("stratum_key", "rule", "bin").count())

    def propose(pdf: pd.DataFrame) -> pd.DataFrame:
        ladder = []
        for r in range(len(RULES)):
            h = np.bincount(pdf.bin[pdf.rule == r], pdf["count"][pdf.rule == r], BINS + 1)
            below = np.cumsum(h)
            ladder.append([int(np.searchsorted(below, (1 - share) * below[-1]) * stretch) + more
                           for share, stretch, more in LADDER])
        return pd.DataFrame({"stratum_key": [pdf.stratum_key.iloc[0]],
                             "ladder": [np.array(ladder, np.int32).T.ravel().tolist()]})

    ladders = hist.groupBy("stratum_key").applyInPandas(propose, "stratum_key string, ladder array<int>")
    n_rules = len(RULES)
    # first level at which any rule rejects the row; len(LADDER) if none does
    first = F.coalesce(*[
        F.when(F.expr(f"exists(transform(bins, (b, r) -> b > ladder[{t * n_rules} + r]), x -> x)"), F.lit(t))
        for t in range(len(LADDER))], F.lit(len(LADDER)))
    joined = rows.join(F.broadcast(ladders) if _few(ladders) else ladders, "stratum_key")
    seen = joined.groupBy("stratum_key", "good", "proposes", first.alias("first")).count()
    n_strata = max(1, ladders.count())
    full = seen.join(ladders, "stratum_key")

    def certify(pdf: pd.DataFrame) -> pd.DataFrame:
        def upto(good, proposes):
            p = pdf[(pdf.good == good) & (pdf.proposes == proposes)]
            return np.cumsum(np.bincount(p["first"], p["count"], len(LADDER) + 1))
        hold = upto(True, False)
        gain = upto(False, True) - upto(True, True)
        t = choose_level(hold[:-1], gain[:-1], int(hold[-1]), alpha, delta / n_strata)
        key, ladder = pdf.stratum_key.iloc[0], list(pdf.ladder.iloc[0])
        rows = [(key, ladder[t * n_rules:(t + 1) * n_rules])] if t >= 0 else []
        return pd.DataFrame(rows, columns=["stratum_key", "cuts"])

    return full.groupBy("stratum_key").applyInPandas(certify, "stratum_key string, cuts array<int>")


def _few(table: DataFrame) -> bool:
    return table.limit(MAX_BROADCAST_STRATA + 1).count() <= MAX_BROADCAST_STRATA


def _counted(spark: SparkSession, docs: DataFrame, stratum: str | None, carry: tuple[str, ...]) -> DataFrame:
    """(doc_id, text_md5, stratum, COUNTS, row struct of ``carry``), written once: learning reads
    some of its columns, judging the rest."""
    marked = docs.withColumn(_MD5, F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = with_counts(marked, stratum, ("doc_id", _MD5, *[c for c in carry if c != "doc_id"]))
    return cut(spark, rows.select("row.doc_id", F.col("row")[_MD5].alias("text_md5"), "stratum", *COUNTS,
                                  *([F.struct(*[F.col("row")[c].alias(c) for c in carry]).alias("row")] if carry else [])),
               "quality-counts")


_MD5 = "_quality_text_md5"


def _judged(counts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds base_failed and kept."""
    rows = _bins(counts).withColumn("stratum_key", F.coalesce(F.concat(F.lit("="), "stratum"), F.lit("")))
    rows = rows.join(F.broadcast(cutoffs) if _few(cutoffs) else cutoffs, "stratum_key", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rejected = F.coalesce(F.expr("exists(transform(bins, (b, r) -> b > cuts[r]), x -> x)"), F.lit(False))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~rejected)


def _learned(spark: SparkSession, counts: DataFrame, labels: DataFrame, alpha: float, delta: float) -> DataFrame:
    return cut(spark, learn_cutoffs(spark, counts.select("doc_id", "text_md5", "stratum", *COUNTS), labels, alpha, delta),
               "quality-cutoffs")


def quality_rules(spark: SparkSession, docs: DataFrame, labels: DataFrame, stratum: str | None = "lang",
                  alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept for every document (see module docstring)."""
    counts = _counted(spark, docs, stratum, ())
    return _judged(counts, _learned(spark, counts, labels, alpha, delta)).select("doc_id", *COUNTS, "base_failed", "kept")


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, stratum: str | None = "lang",
              alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that are kept, judged one by one; no text is shuffled.

    Texts are counted once: the rows are written with their counts, learned from, then judged."""
    counts = _counted(spark, docs, stratum, tuple(docs.columns))
    judged = _judged(counts, _learned(spark, counts, labels, alpha, delta))
    return judged.filter("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
