"""Best-fit packing of tokenised documents into sequences of fixed capacity.

The packing is planned on the histogram of piece lengths, which has at most
``capacity`` entries however large the corpus is:

* Configuration linear program: a configuration is a multiset of lengths that
  fits one sequence; minimise the number of sequences such that every length is
  covered as often as it occurs.
* Multiplicative weights: every length has a weight, at first its share of the
  material bound.  A pricing step is a knapsack dynamic program over the
  capacity that finds the configurations of largest price; each is taken with a
  step of ``STEP`` of what its scarcest length still needs, and the weights of
  the lengths that it covers shrink by the part covered.
* Column generation: weights alone take only exactly full configurations.  If
  that plan lies more than one sequence above the material bound, the program
  is also solved by simplex, where configurations of any fill enter by their
  dual value, and weights with configurations over half full are tried.
* Rounding: whole multiples of configurations are kept; what rounding leaves is
  packed by weights or best fit, longest first, so every piece has a place.  The
  shortest of the plans counts.

The corpus itself never meets on the driver: pieces are numbered within their
length by Spark (bucket counts, then a running sum over buckets), and a piece's
number says which configuration, copy and slot it gets.

Defined cases: null or empty text is the separator alone; documents longer than
the capacity are cut into full pieces, the first one shorter; rows with equal or
null doc_id are packed as separate documents; an empty table gives no rows."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.common import binary, cut, dictionary, pack, slices, unpack, view
from feedloom.llm.pieces import code_point_classes, split

CAPACITY, SEPARATOR = 2048, 0
STEP, EPS = 0.5, 0.5
ROUNDS, TAKES = 400, 48
PIVOTS = 2000               # of the configuration program
REFACTOR = 250              # pivots between two fresh inverses of the basis
TINY = 1e-7                 # pivots of a smaller share of their column are refused
NUMBER_ROWS = 250_000       # pieces numbered in one group
CACHE_WORDS = 300_000       # encoded words that a task remembers


def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    # fixed rule of byte-level vocabularies: printable bytes stand for themselves
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in shown}
    to_byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    return {bytes(to_byte[c] for c in token): i for token, i in vocab.items()}


def added_tokens(path: str) -> dict[bytes, int]:
    """Literal -> id of the added tokens of a file of the tokenizers library, which stand
    for themselves in a text before it is split into pieces."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"added token {t['content']!r} takes its surroundings into account")
    return {t["content"].encode(): t["id"] for t in tokens}


def encoder(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """An encoder of single pieces: merges only, whatever the piece holds."""
    return tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})


def encoded(arr: pa.LargeBinaryArray, classes: np.ndarray, enc: tiktoken.Encoding,
            cache: dict[bytes, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets per text) of a slice: every distinct piece is encoded once."""
    data, off, before = split(arr, classes)
    code, words = dictionary(data, off)
    known = []
    for w in words.to_pylist():
        ids = cache.get(w)
        if ids is None:
            if len(cache) >= CACHE_WORDS:
                cache.clear()
            ids = cache[w] = enc.encode_ordinary(w.decode("utf-8", "replace"))
        known.append(ids)
    size = np.fromiter(map(len, known), np.int64, len(known))
    flat = np.fromiter((i for ids in known for i in ids), np.uint32, int(size.sum()))
    n = size[code]
    end = np.cumsum(n)
    at = np.repeat((np.cumsum(size) - size)[code] - (end - n), n) + np.arange(int(n.sum()))
    return flat[at], np.concatenate([[0], end])[before]


def encoded_apart(arr: pa.LargeBinaryArray, classes: np.ndarray, enc: tiktoken.Encoding,
                  cache: dict[bytes, list[int]], added: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Like ``encoded``, where the literals in ``added`` are tokens and part the text around them.

    Of literals that begin at one place the longest counts, as in the tokenizers library."""
    raw = view(arr)[0].tobytes()
    if not any(t in raw for t in added):
        return encoded(arr, classes, enc, cache)
    literal = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True))))
    parts, first, marked, marks = [], [], [], []
    for text in arr.to_pylist():
        first.append(len(parts))
        at = 0
        for hit in literal.finditer(text):
            marked.append(len(parts))
            marks.append(added[hit[0]])
            parts.append(text[at:hit.start()])
            at = hit.end()
        parts.append(text[at:])
    ids, off = encoded(pa.array(parts, pa.large_binary()), classes, enc, cache)
    first.append(len(parts))
    return (np.insert(ids, off[np.array(marked, np.int64) + 1], np.array(marks, ids.dtype)),
            off[first] + np.searchsorted(marked, first))


def token_pieces(docs: DataFrame, ranks: dict[bytes, int], capacity: int, added: dict[bytes, int]) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece; no shuffle."""
    table = pack(code_point_classes())

    def run(batches) -> Iterator[pa.RecordBatch]:
        classes, enc, cache = unpack(table, np.uint8), encoder(ranks), {}
        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("text"))):
                ids, off = encoded_apart(arr, classes, enc, cache, added)
                row, piece, start, length, crc = [], [], [], [], []
                for d in range(len(arr)):
                    own = np.append(ids[off[d]:off[d + 1]], np.uint32(SEPARATOR)).astype("<u4")
                    n = len(own)
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(d)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(own[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def price(size: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack over the capacity: (best worth, chosen index or -1 to leave one token free).

    size: ascending; on ties the longest piece is taken."""
    value, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
    back, gain = size[::-1], worth[::-1]
    n = len(size)
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        k = n - fits[c]
        if k < n:
            v = value[c - back[k:]] + gain[k:]
            b = int(v.argmax())
            if v[b] > value[c]:
                value[c], pick[c] = v[b], n - 1 - (b + k)
    return value, pick


def sequences(plan: list[tuple[dict[int, int], int]]) -> int:
    return sum(times for _, times in plan)


def least_sequences(size: np.ndarray, count: np.ndarray, capacity: int) -> int:
    """A number of sequences that no plan can go below (size ascending): pieces of over half a
    sequence need one each, and what those leave free takes the others that are not too long."""
    n, tokens = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(size * count)])
    half = int(np.searchsorted(size, capacity // 2, side="right"))
    best = -(-int(tokens[-1]) // capacity)
    for k in range(half):                   # leave out pieces shorter than size[k]
        alone = int(np.searchsorted(size, capacity - int(size[k]), side="right"))
        free = int((n[alone] - n[half]) * capacity - (tokens[alone] - tokens[half]))
        best = max(best, int(n[-1] - n[half]) + max(0, -(-(int(tokens[half] - tokens[k]) - free) // capacity)))
    return max(best, int(n[-1] - n[half]))


def configurations(size: np.ndarray, count: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(configuration {length: copies}, number of sequences) that hold every piece: the shortest plan found."""
    order = np.argsort(size)
    size, need = np.asarray(size, np.int64)[order], np.asarray(count, np.int64)[order]
    bound = least_sequences(size, need, capacity)
    plans = [weighted(size, need, capacity, capacity)]
    if sequences(plans[0]) > bound + 1:
        plans.append(weighted(size, need, capacity, capacity // 2 + 1))
        solved = program(size, need, capacity, plans[0] + plans[1], min(map(sequences, plans)))
        if solved is not None:              # else the basis was lost to rounding: the weighted plans stand
            kept, rest = solved
            plans += [kept + weighted(size, rest, capacity, fill) for fill in (capacity, capacity // 2 + 1)]
            plans.append(kept + best_fit(size, rest, capacity))
    return min(plans, key=sequences)


def weighted(size: np.ndarray, need: np.ndarray, capacity: int, least: int) -> list[tuple[dict[int, int], int]]:
    """Plan by multiplicative weights from configurations that fill ``least`` tokens, the rest by best fit."""
    need = need.copy()
    total = np.maximum(need, 1).astype(float)
    weight = need * (size / capacity) ** 1.2          # long pieces a little dearer: short ones fill later
    plan: dict[tuple, int] = {}
    for _ in range(ROUNDS):
        live = np.flatnonzero(need > 0)
        if not len(live):
            break
        s, worth = size[live], weight[live] / total[live]
        value, pick = price(s, worth, capacity)
        # configurations that begin with a given length, the best priced first
        whole = worth + value[capacity - s]
        first = np.lexsort((-s, -np.round(whole / whole.max(), 6)))[:TAKES]
        taken = False
        for f in first[whole[first] >= 0.98 * whole.max()]:
            used, c = {int(f): 1}, capacity - int(s[f])
            while c > 0:
                i = int(pick[c])
                if i < 0:
                    c -= 1
                elif need[live[i]] > used.get(i, 0):
                    used[i] = used.get(i, 0) + 1
                    c -= int(s[i])
                else:                       # this length is used up: the next that fits
                    c -= 1
            at, a = live[list(used)], np.array(list(used.values()))
            most = int((need[at] // a).min())
            if most < 1:
                continue
            fill = int((size[at] * a).sum())
            if fill < least:                # rounding has an easier time with the rest
                continue
            times = max(1, int(most * STEP))
            need[at] -= times * a
            weight[at] *= np.exp(-EPS * times * a / total[at])
            key = tuple(sorted(zip(size[at].tolist(), a.tolist())))
            plan[key] = plan.get(key, 0) + times
            taken = True
        if not taken:
            break
    return [(dict(k), m) for k, m in plan.items()] + best_fit(size, need, capacity)


def program(size: np.ndarray, need: np.ndarray, capacity: int,
            known: list[tuple[dict[int, int], int]], most: int) -> tuple[list[tuple[dict[int, int], int]], np.ndarray] | None:
    """(configurations of the program's fractional solution rounded down, pieces left by length);
    None if the basis cannot be inverted or no longer gives the pieces, or if the dual values
    prove that no plan has fewer than ``most`` sequences.

    Revised simplex: first over the ``known`` configurations, then with generated ones.  Whatever
    a configuration fills, it enters if its lengths are worth more than one sequence by the dual
    values.  The solution covers every piece at each step, so it may end early: at PIVOTS, or when
    less than half a sequence lies between it and the bound that the dual values prove."""
    m = len(size)
    columns = np.diag(capacity // size).astype(float)        # configurations of one length each
    inverse, x = np.diag(1 / np.diag(columns)), need / np.diag(columns)
    dual = inverse.sum(axis=0)
    pool = np.zeros((len(known), m))
    for k, (config, _) in enumerate(known):
        pool[k, np.searchsorted(size, list(config))] = list(config.values())
    pivots = 0

    def enter(new: np.ndarray) -> bool:
        """False if no pivot of the column can be trusted."""
        nonlocal inverse, x, dual, pivots
        step = inverse @ new
        sure = step > TINY * max(1.0, float(np.abs(step).max()))
        if not sure.any():
            return False
        ratio = np.full(m, np.inf)
        np.divide(x, step, out=ratio, where=sure)
        # of rows that leave at about the same time, the one with the largest pivot keeps the basis regular
        ties = ratio <= ratio.min() * (1 + 1e-9) + 1e-12
        out = int(np.where(ties, step, -1.0).argmax())
        take = ratio[out]
        x = np.maximum(x - take * step, 0)
        x[out] = take
        columns[:, out] = new
        row = inverse[out] / step[out]
        some = np.flatnonzero(step)
        inverse[some] -= step[some, None] * row
        inverse[out] = row
        dual = dual + (1 - dual @ new) * row
        pivots += 1
        if pivots % REFACTOR == 0:                            # against rounding errors
            refactor()
        return True

    def refactor() -> None:
        nonlocal inverse, x, dual
        inverse = np.linalg.inv(columns)
        x, dual = inverse @ need, inverse.sum(axis=0)
        if not np.isfinite(inverse).all() or x.min() < -1e-6 * max(1.0, x.max()):
            raise np.linalg.LinAlgError("the basis no longer gives the pieces")
        x = np.maximum(x, 0)

    try:
        barred = np.zeros(len(pool), bool)
        while pivots < PIVOTS and len(pool):
            worth = np.where(barred, 0.0, pool @ dual)
            best = int(worth.argmax())
            if worth[best] <= 1 + 1e-7:
                break
            barred[best] = not enter(pool[best])
        while pivots < PIVOTS:
            value, pick = price(size, np.maximum(dual, 0), capacity)
            proven = need @ np.maximum(dual, 0) / max(1.0, value[capacity])
            if proven > most - 1 + 1e-6:
                return None
            if value[capacity] <= 1 + 1e-7 or x.sum() - proven < 0.5:
                break
            whole = dual + value[capacity - size]
            before = pivots
            for f in np.argsort(-whole, kind="stable")[:TAKES]:
                new, c = np.zeros(m), capacity - int(size[f])
                new[f] = 1
                while c > 0:
                    i = int(pick[c])
                    if i >= 0:
                        new[i] += 1
                    c -= int(size[i]) if i >= 0 else 1
                if dual @ new > 1 + 1e-7:                     # still worth it after the last pivots
                    enter(new)
            if pivots == before:
                break
        refactor()
    except np.linalg.LinAlgError:
        return None
    rest, kept = need.copy(), []
    for j in np.argsort(-x, kind="stable"):
        a = columns[:, j].astype(np.int64)
        at = np.flatnonzero(a)
        times = min(int(x[j] + 1e-6), int((rest[at] // a[at]).min()))
        if times > 0 and 2 * int(size @ a) > capacity:
            rest -= times * a
            kept.append((dict(zip(size[at].tolist(), a[at].tolist())), times))
    return kept, rest


def best_fit(size: np.ndarray, need: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into the fullest sequence that takes it; equal sequences are kept as one."""
    room: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]     # free tokens -> {configuration: number}
    some = np.zeros(capacity + 1, bool)
    for s, n in zip(size[::-1].tolist(), need[::-1].tolist()):
        while n > 0:
            fit = np.flatnonzero(some[s:capacity])
            if len(fit):
                free = s + int(fit[0])
                have = room[free]
                key, number = have.popitem()
                most = min(free // s, n)        # copies that go into one of them
                times = min(number, n // most)
                if number > times:
                    have[key] = number - times
            else:
                free, key = capacity, ()
                most = min(capacity // s, n)
                times = n // most
            n -= times * most
            left = free - most * s
            new = (*key, (s, most))
            room[left][new] = room[left].get(new, 0) + times
            some[left] = True
            some[free] = free < capacity and bool(room[free])
    return [(dict(k), m) for have in room for k, m in have.items()]


def places(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan by (length, first rank): sequence of the first copy, copies in one sequence, offset there."""
    rows, next_rank, sequence = [], {}, 0
    for config, times in plan:
        at = 0
        for s, a in config.items():
            r = next_rank.get(s, 0)
            rows.append((s, r, sequence, a, at))
            next_rank[s] = r + a * times
            at += s * a
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "copies", "offset"), cols.T))


def numbered(pieces: DataFrame, n_buckets: int) -> DataFrame:
    """Adds ``_rank``: 0, 1, ... within each length, without a task that sees a whole length."""
    b = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_buckets)))
    count = b.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    base = count.withColumn("_base", F.sum("_n").over(W.partitionBy("length").orderBy("_b")) - F.col("_n"))
    local = F.row_number().over(W.partitionBy("length", "_b").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    return (b.withColumn("_local", local).join(base.select("length", "_b", "_base"), ["length", "_b"])
            .withColumn("_rank", F.col("_base") + F.col("_local")).drop("_b", "_base", "_local"))


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   encode_special_tokens: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    encode_special_tokens: as in the tokenizers library; True merges the literals of added
    tokens like any text, False gives them their own ids."""
    added = {} if encode_special_tokens else added_tokens(tokenizer_path)
    pieces = cut(spark, token_pieces(docs, byte_ranks(tokenizer_path), capacity, added), "packing-pieces")
    hist = pieces.groupBy("length").count().collect()          # at most ``capacity`` rows
    size = np.array([r["length"] for r in hist], np.int64)
    count = np.array([r["count"] for r in hist], np.int64)
    where = places(configurations(size, count, capacity)) if len(hist) else None
    ranked = numbered(pieces, max(1, -(-int(count.sum()) // NUMBER_ROWS)))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    wide = int(count.max()) + 1 if len(hist) else 1

    def run(batches):
        key = where["length"] * wide + where["rank"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            i = np.searchsorted(key, length * wide + rank, side="right") - 1
            k, a = rank - where["rank"][i], where["copies"][i]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(where["sequence"][i] + k // a),
                 pa.array(where["offset"][i] + (k % a) * length)], names=[*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "_rank").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
