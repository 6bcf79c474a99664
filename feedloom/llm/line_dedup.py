"""Line dedup: later copies of repeated runs of lines are deleted.

The corpus is read as one sequence of line ids per document (lines with a word;
blank lines stay where they are and belong to no run).  A repeated run of at least
L lines is the union of repeated windows of L lines, so deleting every window that
has an earlier equal window deletes the later copies of all repeated runs, whatever
their lengths.  With L = ``MIN_LINES`` = 2 a window's name is the hash of two
neighbouring 128-bit line ids.

What this is not: no suffix array is built, no rank is doubled beyond two lines, and
no longest common prefixes or maximal runs are computed; ``n_runs`` counts deleted
stretches, in which copies of two sources may meet.  Prefix doubling would settle the
same windows in its first round and then go on for results that the deletion does not use.

A run counts when it has ``min_lines`` lines, or when it is a single line of at
least ``min_words`` words (a passage written on one line).  Earlier means
smaller (doc_id, line); null doc_id comes last.  The first copy of a run stays.

Scale: a window's name needs the next line of the same document only (inside its
row) and no sort.  A group of equal windows may hold a third of all lines: it is
reduced to its earliest member by a map-side combined minimum, never gathered.  The
way back from group to windows is the skew-safe ``lookup``; only groups with two
members travel.

Defined cases: null text stays null and has no lines; empty text has no runs;
null doc_id rows come after all others in their order; rows equal in doc_id and
text are one document listed twice and get the same result; an empty table
gives no rows; other columns pass through unread."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from feedloom.llm.common import binary, cut, lookup

MIN_LINES, MIN_WORDS = 2, 50
_SPACES = b" \t\n\r\x0b\x0c"


def _key():
    """Names a row's document by doc_id and whole text."""
    return F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"))


def line_ids(lines: list[bytes]) -> np.ndarray:
    """(n, 2) 64-bit halves of each line's id."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), "<u8").reshape(-1, 2)


def double(rank: np.ndarray, step: int) -> np.ndarray:
    """Ranks at length n + step from ranks at length n >= step of one document's suffixes."""
    if len(rank) <= step:
        return rank[:0]
    both = np.concatenate([rank[:-step], rank[step:]], axis=1)
    raw = both.tobytes()
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[i:i + 32]) for i in range(0, len(raw), 32)),
                         "<u8").reshape(-1, 2)


def window_ranks(rank: np.ndarray, length: int) -> np.ndarray:
    """Ranks at ``length`` lines by doubling; the last step overlaps to meet it exactly."""
    n = 1
    while n < length:
        step = min(n, length - n)
        rank = double(rank, step)
        n += step
    return rank


def windows(keyed: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """(name, doc_id, _key, line, size): the windows that count, one row each."""
    def run(batches):
        for batch in batches:
            names, at, line, size = [], [], [], []
            for row, text in enumerate(binary(batch.column("text")).to_pylist()):
                lines = [(i, x) for i, x in enumerate(text.split(b"\n")) if x.strip(_SPACES)]
                if not lines:
                    continue
                ids = line_ids([x for _, x in lines])
                ranks = window_ranks(ids, min_lines)
                raw = ranks.tobytes()
                names += [raw[i:i + 16] for i in range(0, len(raw), 16)]
                at += [row] * len(ranks)
                line += range(len(ranks))
                size += [min_lines] * len(ranks)
                if min_lines > 1:
                    for k, (_, x) in enumerate(lines):
                        if len(x) >= 2 * min_words - 1 and len(x.split()) >= min_words:
                            names.append(ids[k].tobytes() + b"1")
                            at.append(row)
                            line.append(k)
                            size.append(1)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), batch.column("doc_id").take(rows), batch.column("_key").take(rows),
                 pa.array(line, pa.int32()), pa.array(size, pa.int32())], names=["name", "doc_id", "_key", "line", "size"])

    return keyed.select("doc_id", "_key", "text").mapInArrow(
        run, "name binary, doc_id long, _key string, line int, size int")


def later_copies(spark: SparkSession, keyed: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """(_key, starts array<struct<line, size>>): windows of each document that have an earlier equal one."""
    w = cut(spark, windows(keyed, min_lines, min_words), "lines-windows")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_key", "line")
    first = (w.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1"))
    first = cut(spark, first, "lines-intervals")
    hit = (lookup(w, first, "name", "n", "_key")
           .filter(F.col("first").isNotNull())
           .filter(place > F.col("first")))
    return hit.groupBy("_key").agg(F.collect_set(F.struct("line", "size")).alias("starts"))


def line_dedup(spark: SparkSession, docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(row struct of the other columns, text with later copies cut, n_lines, n_removed, n_runs) per row."""
    keyed = docs.select("doc_id", _key().alias("_key"), "text")
    found = cut(spark, later_copies(spark, keyed, min_lines, min_words), "lines-removed")
    keep = [c for c in docs.columns if c != "text"]
    hold = docs.select(_key().alias("_key"), "text", F.struct(*keep).alias("row"))
    joined = hold.join(found.hint("shuffle_hash"), "_key", "left")      # the same plan at every size
    kept_type = joined.schema["row"].dataType

    def run(batches):
        for batch in batches:
            texts, total, gone, runs = [], [], [], []
            starts = batch.column("starts")
            for row, text in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
                lines = (text or b"").split(b"\n")
                worded = [i for i, x in enumerate(lines) if x.strip(_SPACES)]
                drop = set()
                for s in starts[row].as_py() or ():
                    drop.update(range(s["line"], s["line"] + s["size"]))
                out = {worded[k] for k in drop}
                texts.append(None if text is None else text if not out else
                             b"\n".join(x for i, x in enumerate(lines) if i not in out))
                total.append(len(worded))
                gone.append(len(drop))
                runs.append(sum(k - 1 not in drop for k in drop))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string()),
                 *(pa.array(x, pa.int64()) for x in (total, gone, runs))],
                names=["row", "text", "n_lines", "n_removed", "n_runs"])

    schema = (StructType().add("row", kept_type).add("text", StringType())
              .add("n_lines", LongType()).add("n_removed", LongType()).add("n_runs", LongType()))
    return joined.select("row", "text", "starts").mapInArrow(run, schema)
