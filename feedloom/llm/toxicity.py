"""Toxicity by a counterfactually regularised linear classifier.

A document's features are the tokens of its distinct words and their beginnings,
hashed; its score is the logistic of their weights' sum.  Besides the usual
logistic loss, training penalises score changes under identity swaps: in every
labelled sentence that names a group by a term of the table ``identities``, the
term is replaced by each other term of the same kind, form and language, and the
squared difference of the two scores, times ``swap_weight``, is added to the
loss.  So the name of a group in the table cannot carry toxicity of its own, and
neutral mentions of it are not taken for toxic ones.

Training takes at most ``per_class`` labelled rows of each class (those with the
smallest hash of doc_id) and keeps at most ``MAX_FEATURES`` features, so it is of
bounded size and runs in one task; scoring reads every whole text, without a
shuffle.  A distinct word's weight is worked out once a task.

Defined cases: null and empty texts have no features and get the score of the
intercept alone; without labelled rows of both classes every score is the share
of the class that there is, or 0.5; labels of a doc_id that is listed more than
once count once, as the largest; null doc_id rows are scored, not trained on;
repeated rows each get a row; an empty table gives no rows."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import binary, cut, dictionary, slices, view

# identity terms by kind, form and language (English plural nouns and adjectives where nothing
# is said): a term is swapped with the others of its line, so like forms stand for like forms
IDENTITIES = {
    "gender": ("women", "men", "girls", "boys"),
    "gender, one": ("woman", "man", "girl", "boy"),
    "gender, adjective": ("female", "male"),
    "gender, adjective as noun": ("females", "males"),
    "gender, de": ("frauen", "männer", "mädchen", "jungen"),
    "gender, one, de": ("frau", "mann", "mädchen", "junge"),
    "gender, adjective, de": ("weiblich", "männlich"),
    "gender, adjective -e, de": ("weibliche", "männliche"),
    "gender, adjective -en, de": ("weiblichen", "männlichen"),
    "gender, fr": ("femmes", "hommes", "filles", "garçons"),
    "gender, one, fr": ("femme", "homme", "fille", "garçon"),
    "gender, es": ("mujeres", "hombres", "chicas", "chicos", "niñas", "niños"),
    "gender, one, es": ("mujer", "hombre", "chica", "chico", "niña", "niño"),
    "faith": ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "sikhs", "catholics", "protestants"),
    "faith, one": ("muslim", "christian", "jew", "hindu", "buddhist", "atheist", "sikh", "catholic", "protestant"),
    "faith, adjective": ("muslim", "islamic", "christian", "jewish", "hindu", "buddhist", "atheist", "sikh", "catholic",
                         "protestant"),
    "faith, de": ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten", "katholiken", "protestanten"),
    "faith, one, de": ("muslim", "christ", "jude", "hindu", "buddhist", "atheist", "katholik", "protestant"),
    "faith, women, de": ("musliminnen", "christinnen", "jüdinnen", "buddhistinnen", "atheistinnen"),
    "faith, one woman, de": ("muslimin", "christin", "jüdin", "buddhistin", "atheistin"),
    "faith, adjective, de": ("muslimisch", "christlich", "jüdisch", "buddhistisch", "katholisch", "evangelisch"),
    "faith, adjective -e, de": ("muslimische", "christliche", "jüdische", "buddhistische", "katholische", "evangelische"),
    "faith, adjective -en, de": ("muslimischen", "christlichen", "jüdischen", "buddhistischen", "katholischen",
                                 "evangelischen"),
    "faith, adjective -er, de": ("muslimischer", "christlicher", "jüdischer", "buddhistischer", "katholischer",
                                 "evangelischer"),
    "faith, fr": ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    "faith, one, fr": ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée", "catholique"),
    "faith, women, fr": ("musulmanes", "chrétiennes", "juives", "hindoues", "bouddhistes", "athées", "catholiques"),
    "faith, one woman, fr": ("musulmane", "chrétienne", "juive", "hindoue", "bouddhiste", "athée", "catholique"),
    "faith, es": ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    "faith, one, es": ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo", "católico"),
    "faith, women, es": ("musulmanas", "cristianas", "judías", "hindúes", "budistas", "ateas", "católicas"),
    "faith, one woman, es": ("musulmana", "cristiana", "judía", "hindú", "budista", "atea", "católica"),
    "origin": ("africans", "asians", "europeans", "americans", "arabs", "mexicans", "latinos", "turks", "indians"),
    "origin, one": ("african", "asian", "european", "american", "arab", "mexican", "latino", "turk", "indian"),
    "origin, adjective": ("african", "asian", "european", "american", "arab", "mexican", "latino", "turkish", "indian"),
    "origin, de": ("afrikaner", "asiaten", "europäer", "amerikaner", "araber", "türken"),
    "origin, one, de": ("afrikaner", "asiate", "europäer", "amerikaner", "araber", "türke"),
    "origin, adjective -e, de": ("afrikanische", "asiatische", "europäische", "amerikanische", "arabische", "türkische"),
    "origin, adjective -en, de": ("afrikanischen", "asiatischen", "europäischen", "amerikanischen", "arabischen", "türkischen"),
    "origin, fr": ("africains", "asiatiques", "européens", "américains", "arabes", "turcs"),
    "origin, one, fr": ("africain", "asiatique", "européen", "américain", "arabe", "turc"),
    "origin, one woman, fr": ("africaine", "asiatique", "européenne", "américaine", "arabe", "turque"),
    "origin, es": ("africanos", "asiáticos", "europeos", "americanos", "árabes", "turcos"),
    "origin, one, es": ("africano", "asiático", "europeo", "americano", "árabe", "turco"),
    "origin, one woman, es": ("africana", "asiática", "europea", "americana", "árabe", "turca"),
    "standing": ("immigrants", "migrants", "refugees", "foreigners", "natives", "citizens"),
    "standing, one": ("immigrant", "migrant", "refugee", "foreigner", "native", "citizen"),
    "standing, de": ("ausländer", "flüchtlinge", "einwanderer", "migranten", "einheimische"),
    "standing, one, de": ("ausländer", "flüchtling", "einwanderer", "migrant", "einheimischer"),
    "standing, fr": ("étrangers", "réfugiés", "immigrés", "migrants", "citoyens"),
    "standing, one, fr": ("étranger", "réfugié", "immigré", "migrant", "citoyen"),
    "standing, es": ("extranjeros", "refugiados", "inmigrantes", "migrantes", "ciudadanos"),
    "standing, one, es": ("extranjero", "refugiado", "inmigrante", "migrante", "ciudadano"),
    "colour, adjective": ("black", "white", "brown"),
    "colour": ("blacks", "whites", "browns"),
    "colour, adjective -e, de": ("schwarze", "weiße"),
    "colour, adjective -en, de": ("schwarzen", "weißen"),
    "colour, fr": ("noirs", "blancs"),
    "colour, one, fr": ("noir", "blanc"),
    "colour, one woman, fr": ("noire", "blanche"),
    "colour, women, fr": ("noires", "blanches"),
    "colour, es": ("negros", "blancos"),
    "colour, one, es": ("negro", "blanco"),
    "colour, one woman, es": ("negra", "blanca"),
    "colour, women, es": ("negras", "blancas"),
    "orientation": ("gays", "lesbians", "bisexuals", "homosexuals", "heterosexuals"),
    "orientation, one": ("homosexual", "lesbian", "bisexual", "heterosexual"),
    "orientation, adjective": ("gay", "lesbian", "straight", "bisexual", "transgender", "trans", "queer", "homosexual",
                               "heterosexual"),
    "orientation, de": ("schwule", "lesben", "bisexuelle", "homosexuelle", "heterosexuelle"),
    "orientation, fr": ("homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"),
    "orientation, one, fr": ("homosexuel", "lesbienne", "bisexuel", "hétérosexuel"),
    "orientation, es": ("homosexuales", "lesbianas", "bisexuales", "heterosexuales"),
    "orientation, one, es": ("homosexual", "lesbiana", "bisexual", "heterosexual"),
    "age": ("teenagers", "children", "adults", "seniors"),
    "age, one": ("teenager", "child", "adult", "senior"),
    "age, adjective": ("elderly", "young", "old"),
    "age, adjective -e, de": ("alte", "junge"),
    "age, adjective -en, de": ("alten", "jungen"),
    "age, fr": ("vieux", "jeunes"),
    "age, es": ("viejos", "jóvenes"),
    "ability, adjective": ("disabled", "blind", "deaf", "autistic"),
    "ability, adjective -e, de": ("behinderte", "blinde", "taube"),
    "ability, fr": ("handicapés", "aveugles", "sourds"),
    "ability, es": ("discapacitados", "ciegos", "sordos"),
}
PER_CLASS, MAX_FEATURES, MIN_DOCS = 6000, 50_000, 3
SPACE_BITS = 22               # features are hashed to so many bits
STARTS = (4, 5, 6, 7)         # lengths of the word beginnings that are features
SWAP_WEIGHT, RIDGE, ROUNDS = 4.0, 1e-3, 300
CACHE_WORDS = 300_000

_TOKEN = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def token_features(token: str) -> list[int]:
    """Hashed features of a lower-case token."""
    parts = ["=" + token, *[f"{n}^" + token[:n] for n in STARTS if len(token) >= n]]
    return [zlib.crc32(p.encode()) >> (32 - SPACE_BITS) for p in parts]


def word_features(word: str) -> list[int]:
    """Features of all tokens of a white-space word."""
    return [f for token in _TOKEN.findall(word.lower()) for f in token_features(token)]


def words_of(arr: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document, code) of the distinct words of each text, and the words by code."""
    data, off = view(arr)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.ones(len(data), bool)
    begins[1:] = space[:-1]
    begins[off[off < len(data)]] = True
    start = np.flatnonzero(begins & ~space)
    solid = np.concatenate([[0], np.cumsum(~space)])
    code, words = dictionary(data[~space], np.append(solid[start], solid[-1]))
    doc = np.searchsorted(off, start, side="right") - 1
    both = np.unique(doc * (len(words) + 1) + code)
    return both // (len(words) + 1), both % (len(words) + 1), words


def swaps(text: str, identities: dict[str, tuple[str, ...]] = IDENTITIES) -> list[tuple[list[int], list[int]]]:
    """(features gained, features lost) of every identity swap in the sentences of a text."""
    out = []
    for sentence in _SENTENCE.findall(text):
        tokens = set(_TOKEN.findall(sentence.lower()))
        for terms in identities.values():
            for own in tokens.intersection(terms):
                out += [(token_features(other), token_features(own)) for other in terms if other not in tokens]
    return sorted(set((tuple(a), tuple(b)) for a, b in out))


def training_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int,
                  identities: dict[str, tuple[str, ...]] = IDENTITIES) -> DataFrame:
    """(toxic, features array<int>, gained array<array<int>>, lost array<array<int>>) of the bounded sample."""
    lab = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id")
           .agg(F.max("toxic").cast("int").alias("toxic")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = None
    for c in (0, 1):
        one = lab.filter(F.col("toxic") == c).orderBy(*order).limit(per_class)
        chosen = one if chosen is None else chosen.unionByName(one)
    chosen = cut(spark, chosen, "toxicity-chosen")                # at most 2 * per_class rows
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def run(batches):
        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("text"))):
                doc, code, words = words_of(arr)
                feats = [word_features(w.decode("utf-8", "replace")) for w in words.to_pylist()]
                cuts = np.searchsorted(doc, np.arange(len(part) + 1))
                rows = [[f for c in code[a:b].tolist() for f in feats[c]] for a, b in zip(cuts, cuts[1:])]
                pairs = [swaps(t.decode("utf-8", "replace"), identities) for t in arr.to_pylist()]
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.array(rows, ints), pa.array([[p[0] for p in x] for x in pairs], pa.list_(ints)),
                     pa.array([[p[1] for p in x] for x in pairs], pa.list_(ints))], names=["toxic", "features", "gained", "lost"])

    return some.mapInArrow(run, "toxic int, features array<int>, gained array<array<int>>, lost array<array<int>>")


class Sparse:
    """Rows of (column, value), with products in both directions."""

    def __init__(self, rows: list[np.ndarray], values: list[np.ndarray], n: int):
        self.size = np.array([len(r) for r in rows], np.int64)
        self.col = np.concatenate(rows) if rows else np.empty(0, np.int64)
        self.val = np.concatenate(values) if rows else np.empty(0)
        self.row, self.n = np.repeat(np.arange(len(rows)), self.size), n

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=len(self.size))

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * g[self.row], minlength=self.n)


def fit(toxic: np.ndarray, features: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]],
        swap_weight: float = SWAP_WEIGHT) -> tuple[float, np.ndarray, np.ndarray]:
    """(intercept, feature numbers, weights) of the regularised classifier."""
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    if not n1 or not n0:
        p = (n1 + 1e-3) / (n1 + n0 + 2e-3)
        return float(np.log(p / (1 - p))), np.empty(0, np.int64), np.empty(0)
    distinct = [np.unique(f, return_counts=True) for f in features]
    every = np.concatenate([f for f, _ in distinct])
    of = np.repeat(toxic, [len(f) for f, _ in distinct])
    size = 1 << SPACE_BITS
    in1, in0 = np.bincount(every[of == 1], minlength=size), np.bincount(every[of == 0], minlength=size)
    # features that tell the classes apart, by the signed root of their likelihood ratio
    seen = np.flatnonzero(in1 + in0 >= MIN_DOCS)
    share = n1 / (n1 + n0)
    a, b = in1[seen] + 0.0, in0[seen] + 0.0
    expect = (a + b) * share
    gain = 2 * (np.where(a > 0, a * np.log(np.maximum(a, 1) / expect), 0)
                + np.where(b > 0, b * np.log(np.maximum(b, 1) / (a + b - expect)), 0))
    named = np.unique([f for g, l in pairs for f in (*g, *l)]).astype(np.int64)
    told = np.flatnonzero(gain > 10.83)        # one in a thousand by chance
    keep = np.union1d(seen[told[np.argsort(-gain[told], kind="stable")[:MAX_FEATURES]]], named)
    place = np.full(size, -1, np.int64)
    place[keep] = np.arange(len(keep))

    def rows(parts):
        cols, vals = [], []
        for f, v in parts:
            at = place[f]
            cols.append(at[at >= 0])
            vals.append(np.minimum(v[at >= 0], 3).astype(float))
        return cols, vals

    x = Sparse(*rows(distinct), len(keep))
    change = []
    for g, l in pairs:
        f = np.concatenate([g, l]).astype(np.int64)
        change.append((f, np.concatenate([np.ones(len(g)), -np.ones(len(l))])))
    d = Sparse([place[f] for f, _ in change], [v for _, v in change], len(keep))
    w, bias, speed = np.zeros(len(keep)), 0.0, np.zeros(len(keep))
    y = toxic.astype(float)
    each = np.where(y == 1, 0.5 / n1, 0.5 / n0)          # both classes count alike
    # step sizes from the curvature of each coordinate
    curve = 0.25 * np.bincount(x.col, (x.val ** 2) * each[x.row] * x.size[x.row].clip(1), minlength=len(keep)) + RIDGE
    if len(change):
        curve += 2 * swap_weight * np.bincount(d.col, d.size[d.row] / len(change), minlength=len(keep))
    for k in range(ROUNDS):
        ahead = w + (k / (k + 3)) * speed
        p = 1 / (1 + np.exp(-np.clip(x.times(ahead) + bias, -30, 30)))
        g = x.back((p - y) * each) + RIDGE * ahead
        if len(change):
            g += 2 * swap_weight / len(change) * d.back(d.times(ahead))
        new = ahead - g / curve
        speed, w = new - w, new
        bias -= 2.0 * float(((p - y) * each).sum())
    return bias - boundary(x.times(w) + bias, y), keep, w


def boundary(z: np.ndarray, y: np.ndarray) -> float:
    """The value that parts the classes best (equal weight for both), amid the gap that it lies in."""
    order = np.argsort(z, kind="stable")
    zs, ys = z[order], y[order]
    clean_below = np.append(0.0, np.cumsum(1 - ys)) / max(1, (1 - ys).sum())
    toxic_above = np.append(ys[::-1].cumsum()[::-1], 0.0) / max(1, ys.sum())
    good = clean_below + toxic_above
    gap = np.concatenate([[0.0], np.diff(zs), [0.0]])
    good[gap <= 0] = -1
    if not (gap > 0).any():
        return 0.0
    k = max(np.flatnonzero(good >= good.max() - 1e-12), key=lambda i: gap[i])
    return float((zs[k - 1] + zs[k]) / 2)


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
          swap_weight: float = SWAP_WEIGHT,
          identities: dict[str, tuple[str, ...]] = IDENTITIES) -> tuple[float, dict[int, float]]:
    """The classifier: (intercept, {feature: weight}), at most MAX_FEATURES and the identity terms.

    identities: terms (lower-case tokens) that are swapped for each other, by any name."""
    rows = cut(spark, training_rows(spark, docs, labels, per_class, identities), "toxicity-training")

    def run(batches):
        toxic, features, pairs = [], [], set()
        for batch in batches:
            toxic += batch.column("toxic").to_pylist()
            f = batch.column("features")
            off = f.offsets.to_numpy()
            flat = f.values.to_numpy(zero_copy_only=False)
            features += [flat[a:b].astype(np.int64) for a, b in zip(off, off[1:])]
            for g, l in zip(batch.column("gained").to_pylist(), batch.column("lost").to_pylist()):
                pairs.update((tuple(a), tuple(b)) for a, b in zip(g, l))
        order = sorted(pairs)
        bias, keep, w = fit(np.array(toxic, np.int64), features, order, swap_weight)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, keep), pa.int64()), pa.array(np.append(bias, w))],
                                         names=["feature", "weight"])

    model = rows.orderBy(F.xxhash64("features"), "toxic").coalesce(1).mapInArrow(run, "feature long, weight double")
    weights = {r["feature"]: r["weight"] for r in model.collect()}
    return weights.pop(-1, 0.0), weights


def score(docs: DataFrame, bias: float, weights: dict[int, float]) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every document."""
    def run(batches):
        known: dict[bytes, float] = {}
        for batch in batches:
            for part, arr in slices(batch, binary(batch.column("text"))):
                doc, code, words = words_of(arr)
                worth = np.empty(len(words))
                for i, w in enumerate(words.to_pylist()):
                    s = known.get(w)
                    if s is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        s = known[w] = sum(weights.get(f, 0.0) for f in word_features(w.decode("utf-8", "replace")))
                    worth[i] = s
                z = bias + np.bincount(doc, worth[code], minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
