"""Near-duplicate embeddings: all pairs within a cosine, by dual traversal of cover trees.

On the unit sphere a cosine of c is a distance of sqrt(2 - 2c), so the pairs
wanted are those within a fixed distance t.  A cover tree is a set of nested
levels: a node is a centre with the points it covers, within a radius; the next
level covers them by centres farther apart than half that radius.  Two nodes are
walked together: with their centres d apart and radii r and s, no pair of their
points is linked if d - r - s > t, every pair is if d + r + s <= t, and else
their children meet.  So a dense group is counted node by node and its pairs are
never listed; only where bounds do not decide do single points meet, and those
that lie on the threshold are decided by the cosine of the original vectors.

Spark builds the upper levels: a node with more rows than a task should hold is
split among some of its own rows as centres, and the radius of each part is
measured over all of its rows.  Node pairs go down level by level, pruned by the
same bounds, until both are blocks of bounded size.  A block's lower levels
(radii 1, 1/2, 1/4, ...) are built once, in one task; a task then walks one pair
of blocks.  It returns a number of links for each of its vectors and a star for
each group of linked ones, however many pairs there are.

Equal vectors are one point of some weight.  A node is split by key when nearest
centres do not make it small (vectors all alike), which keeps every bound.

What this costs: bounds prune where vectors are close or clustered.  Vectors
that are all about a right angle apart (as random ones are, in many dimensions)
separate only at radii below 1/2, so their blocks meet block by block.
Such a step is one product in single precision (see Walk.within), and the number of
pairs of blocks still grows with the square of the blocks.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, nor do rows without id (their component is null);
vectors of different lengths are not linked; rows with equal ids or vectors are
vectors of their own; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.llm.ann import dots, matrix
from feedloom.llm.common import cut, lookup, pack, unpack
from feedloom.llm.simhash_trie import components, forest

BLOCK_BYTES = 4 << 20         # vectors of one block
GROUP_BYTES = 8 << 20         # vectors that one task assigns at a time
FAN = 64                      # children of an upper node, at most
DEEP = 6                      # upper levels split by nearest centre; further ones by key
EPS = 1e-6                    # more than the rounding of a distance
NET = 128                     # centres chosen at a time
FINEST = 1 / 64               # the smallest radius of a level, in units of the threshold


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no sum of squares leaves the range of doubles."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0.0))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def apart(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


# -- upper levels, by Spark ---------------------------------------------------

POINT = "node string, cid long, n long, x array<double>, d double"


def _ways(count, dim):
    return F.ceil(count * dim * 8 / GROUP_BYTES).cast("int")


def split(spark: SparkSession, points: DataFrame, block_bytes: int, deep: int = DEEP) -> tuple[DataFrame, list[DataFrame]]:
    """points (node, cid, n, x) -> (POINT rows under their blocks, levels).

    A level has a row a child: (node, child, centre, radius); a node that is not split is its own
    child on all levels below."""
    dim = F.size("x")
    levels, blocks = [], []
    rows = points.withColumn("d", F.lit(2.0))
    while True:
        sizes = cut(spark, rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.max(dim).alias("dim"),
                                                    F.max("d").alias("radius")), "cover-sizes")
        limit = F.greatest(F.lit(FAN), F.floor(F.lit(block_bytes) / (F.col("dim") * 8)))
        sizes = sizes.withColumn("big", F.col("rows") > limit).withColumn(
            "fan", F.least(F.lit(FAN), F.ceil(2 * F.col("rows") / limit)).cast("int"))
        marked = lookup(rows, sizes, "node", "rows", "cid")
        marked = cut(spark, marked.drop("dim", "radius"), "cover-marked")
        blocks.append(marked.filter(~F.col("big")).select("node", "cid", "n", "x", "d"))
        if sizes.filter("big").isEmpty():
            break
        level = len(levels)
        order = W.partitionBy("node").orderBy(F.xxhash64("cid", F.lit(level)), "cid")
        some = (marked.filter("big").withColumn("_k", F.row_number().over(order)).filter(f"_k <= {FAN}").filter("_k <= fan")
                .select("node", (F.col("_k") - 1).alias("k"), F.col("x").alias("centre")))
        some = cut(spark, some, "cover-centres")
        ways = sizes.filter("big").select("node", _ways(F.col("rows"), F.col("dim")).alias("ways"))
        dealt = some.join(ways, "node").withColumn("way", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
        there = lookup(marked.filter("big"), sizes.filter("big").select("node", "rows", _ways(F.col("rows"), F.col("dim"))
                                                                      .alias("ways")), "node", "rows", "cid")
        there = there.withColumn("way", F.expr("cast(pmod(xxhash64(cid), ways) as int)"))
        rows = cut(spark, there.select("node", "way", "cid", "n", "x").groupBy("node", "way").cogroup(
            dealt.select("node", "way", "k", "centre").groupBy("node", "way")).applyInArrow(_assigner(level >= deep), POINT),
            "cover-rows")
        radii = rows.groupBy("node").agg(F.max("d").alias("radius"))
        kids = some.select(F.col("node"), F.concat_ws(".", "node", F.col("k").cast("string")).alias("child"), "centre")
        kids = kids.join(radii.withColumnRenamed("node", "child"), "child")
        levels.append(cut(spark, kids.select("node", "child", "centre", "radius"), "cover-level"))
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out, levels


def _assigner(by_key: bool):
    def assign(left, right):
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.float64())],
                            names=["node", "cid", "n", "x", "d"])
        k, cid = right.column("k").to_numpy(), left.column("cid").to_numpy()
        near = unit(scaled(matrix(left.column("x").combine_chunks()))) @ unit(scaled(matrix(right.column("centre").combine_chunks()))).T
        best = cid % len(k) if by_key else near.argmax(1)
        name = left.column("node")[0].as_py()
        return pa.table({"node": pa.array([f"{name}.{k[b]}" for b in best]), "cid": left.column("cid"), "n": left.column("n"),
                         "x": left.column("x"), "d": pa.array(apart(near[np.arange(len(best)), best]))})
    return assign


def block_pairs(spark: SparkSession, roots: DataFrame, levels: list[DataFrame], t: float) -> DataFrame:
    """(a, b) with a <= b: the pairs of blocks that may hold links, from the pairs of ``roots`` with themselves."""
    def meet(left, right):
        out = {"a": [], "b": []}
        if left.num_rows and right.num_rows:
            a, b = left.column("child").to_pylist(), right.column("child").to_pylist()
            x, y = (unit(scaled(matrix(s.column("centre").combine_chunks()))) for s in (left, right))
            reach = left.column("radius").to_numpy()[:, None] + right.column("radius").to_numpy()[None, :]
            lone = left.column("aa")[0] == left.column("ba")[0]
            for i, j in zip(*np.nonzero(apart(x @ y.T) <= reach + t + EPS)):
                if not lone or a[i] <= b[j]:
                    out["a"].append(a[i])
                    out["b"].append(b[j])
        return pa.table({k: pa.array(v, pa.string()) for k, v in out.items()})

    pairs = roots.select(F.col("node").alias("a"), F.col("node").alias("b"))
    settled = None
    for kids in levels:
        parents = kids.select("node").distinct()
        # a node that is not split stands for itself: its centre and radius are in the level it came from
        if settled is not None:
            old = settled.join(parents, "node", "left_anti").select("node", F.col("node").alias("child"), "centre", "radius")
            settled = kids.select(F.col("child").alias("node"), "centre", "radius").unionByName(
                settled.join(parents, "node", "left_anti"))
            kids = kids.unionByName(old)
        else:
            # roots are split by the first level or are blocks, which meet themselves only
            settled = kids.select(F.col("child").alias("node"), "centre", "radius")
        lone = pairs.filter("a = b").join(kids.select(F.col("node").alias("a")).distinct(), "a", "left_anti").select("a", "b")
        left, right = (pairs.join(kids.withColumnRenamed("node", side), side).select(
            F.col("a").alias(f"a{side}"), F.col("b").alias(f"b{side}"),
            *[F.col(c).alias(c) for c in ("child", "centre", "radius")]) for side in ("a", "b"))
        met = left.groupBy("aa", "ba").cogroup(right.groupBy("ab", "bb")).applyInArrow(meet, "a string, b string")
        pairs = cut(spark, met.unionByName(lone), "cover-pairs")
    return pairs


# -- lower levels, in a task --------------------------------------------------

def net(u: np.ndarray, radius: float) -> np.ndarray:
    """For each point the place of its centre: the first point, and others so that centres lie
    farther than ``radius`` apart and cover all points."""
    best = apart(u @ u[0])
    owner = np.zeros(len(u), np.int64)
    best[0] = -1.0
    while True:
        rest = np.flatnonzero(best > radius)
        if not len(rest):
            return owner
        head = rest[:NET]
        far = apart(u[head] @ u[head].T) > radius
        free, chosen = np.ones(len(head), bool), []
        for i in range(len(head)):
            if free[i]:
                chosen.append(i)
                free &= far[i]
        own = head[chosen]
        for a in range(0, len(u), 8192):
            d = apart(u[a:a + 8192] @ u[own].T)
            k = d.argmin(1)
            d = d[np.arange(len(k)), k]
            nearer = d < best[a:a + 8192]
            best[a:a + 8192][nearer] = d[nearer]
            owner[a:a + 8192][nearer] = own[k[nearer]]
        best[own], owner[own] = -1.0, own


class Tree:
    """Points in an order in which every node of every level is a range, its centre first.

    starts[l]: where the nodes of level l begin, and the number of points; radius[l]: theirs.
    On the last level every point is a node."""

    def __init__(self, x: np.ndarray, cid: np.ndarray, n: np.ndarray, starts: list, radius: list):
        self.x, self.cid, self.n, self.starts, self.radius = x, cid, n, starts, radius
        self.u = unit(x)
        self.weight = np.concatenate([[0], np.cumsum(n)])

    @classmethod
    def built(cls, x: np.ndarray, cid: np.ndarray, n: np.ndarray, t: float) -> Tree:
        x = scaled(x)
        u, order = unit(x), np.argsort(cid, kind="stable")
        starts, r = [np.array([0, len(x)])], 1.0
        while len(starts[-1]) <= len(x) and r >= t * FINEST:
            cuts = [np.zeros(1, np.int64)]
            for a, b in zip(starts[-1][:-1].tolist(), starts[-1][1:].tolist()):
                if b - a > 1:
                    own = order[a:b]
                    centre = net(u[own], r)
                    mine = np.lexsort((np.arange(b - a), centre != np.arange(b - a), centre))
                    order[a:b] = own[mine]
                    cuts.append(a + np.flatnonzero(np.diff(centre[mine], prepend=-1))[1:])
                cuts.append(np.array([b]))
            starts.append(np.concatenate(cuts))
            r /= 2
        starts.append(np.arange(len(x) + 1))
        u, radius = u[order], []
        for s in starts:
            centre = u[np.repeat(s[:-1], np.diff(s))]
            d = apart((u * centre).sum(1))
            d[s[:-1]] = 0.0
            radius.append(np.maximum.reduceat(d, s[:-1]))
        return cls(x[order], cid[order], n[order], starts, radius)

    def dumped(self) -> list:
        return [pack(self.x), self.x.shape[1], pack(self.cid), pack(self.n), [pack(s) for s in self.starts],
                [pack(r) for r in self.radius]]

    @classmethod
    def loaded(cls, x, dim, cid, n, starts, radius) -> Tree:
        return cls(unpack(x, np.float64).reshape(-1, dim), unpack(cid, np.int64), unpack(n, np.int64),
                   [unpack(s, np.int64) for s in starts], [unpack(r, np.float64) for r in radius])

    def kids(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First child and number of children of each node of a level."""
        at = np.searchsorted(self.starts[level + 1], self.starts[level])
        return at[:-1], np.diff(at)


class Walk:
    """Dual traversal of two trees (or of one with itself): links of every point, and their groups."""

    def __init__(self, a: Tree, b: Tree, cosine: float):
        self.same = a is b
        self.trees, self.cosine, self.t = (a, b), cosine, float(apart(np.float64(cosine)))
        self.more = [np.zeros(len(x.cid) + 1, np.int64) for x in (a, b)]     # differences of ranges
        if self.same:
            self.more[1] = self.more[0]
        self.shift = 0 if self.same else len(a.cid)
        self.label = np.arange(self.shift + len(b.cid))
        self.pairs = max(1024, (32 << 20) // (8 * a.x.shape[1]))
        self.down(np.zeros(1, np.int64), np.zeros(1, np.int64))

    def level(self, side: int, level: int) -> int:
        """Both trees' levels run on together; the shorter one stays at its last."""
        return min(level, len(self.trees[side].starts) - 1)

    def kids(self, side: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        tree, at = self.trees[side], self.level(side, level)
        if at == self.level(side, level + 1):
            n = len(tree.starts[at]) - 1
            return np.arange(n), np.ones(n, np.int64)
        return tree.kids(at)

    def down(self, i: np.ndarray, j: np.ndarray) -> None:
        todo = [(0, *self.judge(0, i, j, self.far(0, i, j)))]
        while todo:
            level, i, j = todo.pop()
            if len(i):
                for i, j, d in self.children(level, i, j):
                    todo.append((level + 1, *self.judge(level + 1, i, j, d)))

    def centres(self, side: int, level: int) -> np.ndarray:
        return self.trees[side].starts[self.level(side, level)][:-1]

    def far(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        (a, b), (p, q) = self.trees, (self.centres(0, level)[i], self.centres(1, level)[j])
        return apart(np.einsum("ij,ij->i", a.u[p], b.u[q]))

    def children(self, level: int, i: np.ndarray, j: np.ndarray):
        """The children's pairs with their distances, a bounded number at a time."""
        (ka, na), (kb, nb) = self.kids(0, level), self.kids(1, level)
        size = na[i] * nb[j]
        ca, cb = self.centres(0, level + 1), self.centres(1, level + 1)
        if size.sum() > self.pairs and size.sum() > 0.2 * len(ca) * len(cb):
            # most meet: whole rows of distances at once
            alive = np.zeros((len(ka), len(kb)), bool)
            alive[i, j] = True
            up_a, up_b = np.repeat(np.arange(len(ka)), na), np.repeat(np.arange(len(kb)), nb)
            ra, rb = (self.trees[s].radius[self.level(s, level + 1)] for s in (0, 1))
            for p, q, d in self.within(ca, cb, ra, rb):
                keep = (d <= ra[p] + rb[q] + (self.t + EPS)) & alive[up_a[p], up_b[q]]
                if self.same:
                    keep &= p <= q
                p, q, d = p[keep], q[keep], d[keep]
                for x in range(0, len(p), 8 * self.pairs):
                    yield p[x:x + 8 * self.pairs], q[x:x + 8 * self.pairs], d[x:x + 8 * self.pairs]
            return
        end, x = np.cumsum(size), 0
        while x < len(i):
            y = max(x + 1, int(np.searchsorted(end, (end[x - 1] if x else 0) + self.pairs, side="right")))
            n = size[x:y]
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(nb[j[x:y]], n)
            p, q = np.repeat(ka[i[x:y]], n) + at // wide, np.repeat(kb[j[x:y]], n) + at % wide
            if self.same:                      # a node with itself: each of its children's pairs once
                keep = (p <= q) | np.repeat(i[x:y] != j[x:y], n)
                p, q = p[keep], q[keep]
            for z in range(0, len(p), self.pairs):
                o = slice(z, z + self.pairs)
                yield p[o], q[o], self.far(level + 1, p[o], q[o])
            x = y

    def within(self, ca: np.ndarray, cb: np.ndarray, ra: np.ndarray, rb: np.ndarray):
        """(p, q, d): all pairs of the centres ca[p], cb[q] whose nodes may hold a link, and a few more.

        Cosines are made in single precision and compared with a bound that allows for its
        rounding; what passes has its distance worked out in double.  Columns go by radius, so that
        a few wide nodes do not widen the bound of the many narrow ones."""
        ua, ub = self.trees[0].u[ca], self.trees[1].u[cb]
        short_a, short_b = ua.astype(np.float32), ub.astype(np.float32)
        slack = (ua.shape[1] + 8) * 2.0 ** -23
        wide = np.searchsorted(self.t * 2.0 ** np.arange(-4, 4), rb)
        for w in np.unique(wide).tolist():
            col = np.flatnonzero(wide == w)
            reach = ra + (rb[col].max() + self.t + EPS)
            floor = np.where(reach < 2, 1 - reach * reach / 2 - slack, -np.inf).astype(np.float32)
            vb, rows = short_b[col].T, max(1, (4 << 20) // (4 * len(col)))
            for s in range(0, len(ca), rows):
                met = short_a[s:s + rows] @ vb >= floor[s:s + rows, None]
                n = np.count_nonzero(met)
                if not n:
                    continue
                p, q = np.divmod(np.flatnonzero(met), len(col))
                if n > met.size // 32:
                    d = apart((ua[s:s + rows] @ ub[col].T)[p, q])
                    yield p + s, col[q], d
                    continue
                p, q = p + s, col[q]
                for x in range(0, n, self.pairs):
                    y = slice(x, x + self.pairs)
                    yield p[y], q[y], apart(np.einsum("ij,ij->i", ua[p[y]], ub[q[y]]))

    def judge(self, level: int, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Drops pairs without links, counts those that are linked as a whole, returns the others."""
        (a, b), (la, lb) = self.trees, (self.level(0, level), self.level(1, level))
        ra, rb = a.radius[la][i], b.radius[lb][j]
        own = (i == j) if self.same else np.zeros(len(i), bool)
        d = np.where(own, 0.0, d)
        open_ = d <= ra + rb + self.t + EPS
        whole = open_ & (d + ra + rb <= self.t - EPS)
        sa, sb = a.starts[la], b.starts[lb]
        single = (np.diff(sa)[i] == 1) & (np.diff(sb)[j] == 1)
        whole &= ~(single & own)
        close = np.flatnonzero(open_ & ~whole & single & ~own)
        if len(close):
            x, y = a.x[sa[i[close]]], b.x[sb[j[close]]]
            cosine = dots(x, y) / (np.sqrt(dots(x, x)) * np.sqrt(dots(y, y)))
            whole[close[cosine >= self.cosine]] = True
        self.link(np.flatnonzero(whole), i, j, sa, sb, own)
        rest = open_ & ~whole & ~single
        return i[rest], j[rest]

    def link(self, at, i, j, sa, sb, own) -> None:
        if not len(at):
            return
        a, b = self.trees
        i, j, own = i[at], j[at], own[at]
        wa, wb = a.weight[sa[i + 1]] - a.weight[sa[i]], b.weight[sb[j + 1]] - b.weight[sb[j]]
        np.add.at(self.more[0], sa[i], wb)
        np.subtract.at(self.more[0], sa[i + 1], wb)
        np.add.at(self.more[1], sb[j[~own]], wa[~own])
        np.subtract.at(self.more[1], sb[j[~own] + 1], wa[~own])
        for k in i[own]:                       # a point is no link of its own
            self.more[0][sa[k]:sa[k + 1]] -= np.diff(a.n[sa[k]:sa[k + 1]], prepend=0)
            self.more[0][sa[k + 1]] += a.n[sa[k + 1] - 1]
        # all points of both nodes are one group: a star within each, and one link between
        ends = [np.stack([sa[i], sb[j] + self.shift])]
        for nodes, s, shift in ((np.unique(i), sa, 0), (np.unique(j), sb, self.shift)):
            n = np.diff(s)[nodes]
            head = np.repeat(s[nodes], n)
            ends.append(np.stack([head, s[nodes].repeat(n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]) + shift)
        x, y = np.concatenate(ends, 1)
        self.label = forest(len(self.label), self.label[x], self.label[y])[self.label]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cid, links, cid of the smallest place in its group) of the points with links."""
        a, b = self.trees
        cid = a.cid if self.same else np.concatenate([a.cid, b.cid])
        more = [np.cumsum(m)[:-1] for m in (self.more[:1] if self.same else self.more)]
        more = np.concatenate(more)
        some = np.flatnonzero(more > 0)
        return cid[some], more[some], cid[self.label[some]]


TREE = "node string, tx binary, dim int, tcid binary, tn binary, starts array<binary>, radius array<binary>"
FOUND = "cid long, links long, root long"


def links(spark: SparkSession, points: DataFrame, cosine: float, block_bytes: int = BLOCK_BYTES, deep: int = DEEP) -> DataFrame:
    """FOUND rows of points (cid, n, x): to be summed by cid; (cid, root) join all that are linked."""
    t = float(apart(np.float64(cosine)))
    points = points.withColumn("node", F.size("x").cast("string"))
    rows, levels = split(spark, points, block_bytes, deep)
    pairs = block_pairs(spark, points.select("node").distinct(), levels, t)

    def build(group):
        tree = Tree.built(matrix(group.column("x").combine_chunks()), group.column("cid").to_numpy(), group.column("n").to_numpy(), t)
        x, dim, cid, n, starts, radius = tree.dumped()
        binary = pa.binary()
        return pa.table([group.column("node").slice(0, 1), pa.array([x], binary), pa.array([dim], pa.int32()), pa.array([cid], binary),
                         pa.array([n], binary), pa.array([starts], pa.list_(binary)), pa.array([radius], pa.list_(binary))],
                        names=["node", "tx", "dim", "tcid", "tn", "starts", "radius"])

    def walk(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=["cid", "links", "root"])
        a, b = ({c: s.column(c)[0].as_py() for c in s.column_names} for s in (left, right))
        one = lambda r: Tree.loaded(r["tx"], r["dim"], r["tcid"], r["tn"], r["starts"], r["radius"])
        ta = one(a)
        return pa.table([pa.array(c) for c in Walk(ta, ta if a["aa"] == a["ba"] else one(b), cosine).found()],
                        names=["cid", "links", "root"])

    trees = cut(spark, rows.groupBy("node").applyInArrow(build, TREE), "cover-trees")
    left, right = (pairs.join(trees.withColumnRenamed("node", s), s).select(
        F.col("a").alias(f"a{s}"), F.col("b").alias(f"b{s}"), *[F.col(c).alias(c) for c in trees.columns[1:]]) for s in ("a", "b"))
    return left.groupBy("aa", "ba").cogroup(right.groupBy("ab", "bb")).applyInArrow(walk, FOUND)


def near_duplicates(spark: SparkSession, vectors: DataFrame, cosine: float = 0.95, block_bytes: int = BLOCK_BYTES,
                    deep: int = DEEP) -> DataFrame:
    """id, n_links, component_id (smallest id reachable) of every row of ``vectors`` (id, x); 0 < cosine < 1."""
    v = vectors.select(F.col("id").cast("long").alias("id"), F.col("x").cast("array<double>").alias("x"))
    fine = ("id is not null and x is not null and exists(x, c -> c <> 0) and "
            "not exists(x, c -> c is null or isnan(c) or abs(c) = double('Infinity'))")
    # null entries make exists() null rather than false
    v = cut(spark, v.withColumn("fine", F.coalesce(F.expr(fine), F.lit(False))), "cover-vectors")
    classes = (v.filter("fine").groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = cut(spark, classes, "cover-classes")
    found = cut(spark, links(spark, classes.select("cid", "n", "x"), cosine, block_bytes, deep), "cover-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(spark, found.select(F.col("cid").alias("u"), F.col("root").alias("w")))
    roots = cut(spark, roots.select(F.col("node").alias("cid"), "root"), "cover-roots")
    named = (classes.select("cid", "n", "x", "least").join(counts, "cid", "left").join(roots, "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    named = cut(spark, named, "cover-named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"))
    named = lookup(named.select("x", "n", "links", "root"), least, "root", "m", "links")
    named = cut(spark, named.select("x", "n", F.coalesce("links", F.lit(0)).alias("links"), "component_id"), "cover-classes-named")
    out = lookup(v.filter("fine").select("id", "x"), named.withColumn("copies", F.col("n")), "x", "n", "id").select(
        "id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    return out.unionByName(v.filter("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
