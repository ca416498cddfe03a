"""Near-duplicate vectors by a forest of random-projection trees.

Vectors are compared only within their label.  Vectors of a label that are equal
once divided by their largest component are one class, which its smallest
vec_id stands for, so a vector that a third of all rows share is compared once.  Every tree splits the classes of a label again
and again: at each level a node's classes are projected on a random direction
and parted at the middle of their projections; those near the middle (a
``SPILL`` share on either side) go to both children.  A node of at most
``LEAF`` classes is a leaf.  A label that fits into one leaf needs no tree.

A node is not split through a large group of near copies.  A sample of the
node shows whether one class is linked with ``DENSE`` of it or more; such
classes are pivots.  Where the largest number of links in the sample, taken
three deviations higher, leaves a group below that share for some levels, the
nodes below are looked at again only when it may have been reached.  The classes linked with a pivot are its core, those within
twice the angle its fringe, so by the triangle inequality every link of a core
class inside the node ends in the core or the fringe.  All of those pairs are
compared, cut into blocks of half a leaf with each pair of blocks as a group of
its own, and the core leaves the node.  This is done for a whole label before
the trees part, where it settles all links of the core, and at every node after.

All other classes go through all trees.  A leaf's classes are compared with one
another as a block in one task, which is bounded by ``LEAF``.  A pair that
several leaves share is counted in the first of them only: each class carries
the list of its leaves, cores and fringes.  A leaf returns, instead of pairs, the number of each
class's links and one edge to the smallest class it is connected with inside
the leaf; the components of those edges over all trees are the result.

Rows of a level hold no vectors: a class is projected once on the directions of
all trees and the next ``AHEAD`` levels, and a row carries those of its tree.
Vectors are joined to samples, to nodes with pivots and to leaves.

Vectors are hashed, projected and compared in double precision; single precision
only rules out pairs in a leaf, by a margin above its rounding.  Splits come
from approximate quantiles, which combine before their shuffle.  A node whose
projections are all equal and that has no pivot is parted by a hash that differs
by tree, so every node shrinks; rows left after ``MOST_LEVELS`` are an error.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, and one without label, links with nothing and is its own
component.  Vectors of different lengths never link.  Rows that repeat a vec_id
count as vectors of their own in n_links; one id with several vectors links
them when it is the smallest of its class.  A row without vec_id is counted by
others, and its component is that of its class, or null.  Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm.common import components, group_min_by_salt, materialize, table

MIN_COSINE = 0.93
TREES = 6
LEAF = 1024
SPILL = 0.08
DENSE = 8  # a pivot is linked with one in DENSE of its node, less than both spills hold
SALTS = 64
AHEAD = 4  # levels whose projections a row carries
MOST_LEVELS = 64
SEED = 20240301


def usable(vector) -> F.Column:
    """True for a vector with finite components, not all zero."""
    x = vector.cast("array<double>")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v)
                       | (F.abs(v) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """vectors (vec_id, embedding, label) -> (members, classes).  ``vector`` has
    the largest component 1 or -1, so exact multiples are mostly one class.

    members: one row per usable vector (vec_id, class_id, size).  classes: one
    row per class (class_id, rep, label, vector, size).  ``key`` is two hashes of
    label and vector, ``class_id`` a hash of both, ``rep`` the smallest vec_id."""
    good = vectors.where(F.col("label").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("raw"))
    most = F.array_max(F.transform("raw", F.abs))
    # found once a row, not once a component as inside of a transform over "raw"; a zero
    # is never negative, so equal vectors have equal bits
    scale = F.array_repeat(most, F.size("raw"))
    good = good.select("vec_id", "label",
                       F.zip_with("raw", scale, lambda x, m: x / m + 0.0).alias("vector"))
    key = F.struct(*[F.xxhash64(F.lit(seed), "label", "vector").alias(f"h{seed}") for seed in (1, 2)])
    keyed = good.select("vec_id", "label", "vector", key.alias("key"),
                        F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt"))
    keyed = materialize(keyed, "forest-keyed")
    reps = group_min_by_salt(keyed.select("key", "salt", "vec_id"), ["key"], "salt", "vec_id", "rep")
    reps = reps.withColumn("class_id", F.xxhash64("key"))
    members = keyed.select("vec_id", "key", "salt").join(reps, ["key", "salt"]).select(
        "vec_id", "class_id", F.col("rep_rows").alias("size"), "rep")
    one = keyed.groupBy("key").agg(F.first("label").alias("label"),
                                   F.first("vector").alias("vector"),
                                   F.min("vec_id").alias("rep"),
                                   F.count(F.lit(1)).alias("size"))
    return members, one.select(F.xxhash64("key").alias("class_id"), "rep", "label", "vector", "size")


def direction(seed: int, tree: int, level: int, dims: int) -> np.ndarray:
    v = np.random.default_rng([seed, tree, level, dims]).standard_normal(dims)
    return v / np.linalg.norm(v)


def _units(column: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their unit vectors) for each length of the vectors in a column."""
    vectors = column.combine_chunks()
    bounds = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False)
    dims = np.diff(bounds)
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        x = values[bounds[rows][:, None] + np.arange(d)]
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        yield rows, x


def projections(points: DataFrame, trees: int, level: int) -> DataFrame:
    """classes -> (class_id, all_at): the projections of the unit vector on the
    directions of every tree (slowest) and of ``AHEAD`` levels from ``level``."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            out = np.empty((batch.num_rows, trees * AHEAD))
            for rows, x in _units(pa.chunked_array([batch.column("vector")])):
                dims = x.shape[1]
                if dims not in known:
                    known[dims] = np.array([direction(SEED, t, level + k, dims)
                                            for t in range(trees) for k in range(AHEAD)])
                out[rows] = x @ known[dims].T
            ends = np.arange(0, out.size + 1, trees * AHEAD, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id"), pa.ListArray.from_arrays(ends, out.ravel())],
                ["class_id", "all_at"])

    return points.select("class_id", "vector").mapInArrow(
        project, "class_id long, all_at array<double>")


def _split(rows: DataFrame) -> DataFrame:
    """Rows (class_id, tree, node, at) of nodes that are too large -> the same
    rows in the nodes' children, without ``at``; other columns stay."""
    low, high = 0.5 - SPILL, 0.5 + SPILL
    cut = rows.groupBy("tree", "node").agg(
        F.percentile_approx("at", F.array(F.lit(low), F.lit(0.5), F.lit(high)),
                            F.lit(1000)).alias("q"),
        F.min("at").alias("least"), F.max("at").alias("most"))
    cut = cut.select("tree", "node", "q", (F.col("least") == F.col("most")).alias("flat"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # the children of a node are named by a hash of its name and the side
    child = lambda side: F.xxhash64("tree", "node", F.lit(side))
    coin = F.pmod(F.xxhash64("class_id", "tree", "node"), F.lit(2)) == 0
    left = F.when(F.col("flat"), coin).otherwise(F.col("at") <= F.col("q")[2])
    right = F.when(F.col("flat"), ~coin).otherwise(F.col("at") > F.col("q")[0])
    sides = F.filter(F.array(F.when(left, child(0)), F.when(right, child(1))),
                     lambda x: x.isNotNull())
    return (rows.withColumn("salt", F.pmod(F.xxhash64("class_id"), F.lit(SALTS)).cast("int"))
            .join(cut, ["tree", "node", "salt"])
            .select(*[c for c in rows.columns if c not in ("node", "at")],
                    F.explode(sides).alias("node")))


def _pivots(rows: DataFrame, points: DataFrame, level: int, leaf: int,
            min_cosine: float) -> DataFrame:
    """Rows (class_id, tree, node, k) of large nodes -> (tree, node, pivots, next):
    the pivots of the nodes with a group of near copies that a split would part,
    and the level at which a node without any, or those below it, may have one.
    The sample, about ``leaf`` classes of a node, only finds pivots."""
    sample = rows.where(F.pmod(F.xxhash64("class_id", "tree", "node", F.lit(level)),
                               F.col("k")) < leaf)

    def find(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("class_id")
        n = group.num_rows
        linked = np.zeros((n, n), bool)
        units: list[np.ndarray] = [np.empty(0)] * n
        for at, x in _units(group.column("vector")):
            linked[np.ix_(at, at)] = x @ x.T >= min_cosine
            for r, unit in zip(at, x):
                units[r] = unit
        degree = linked.sum(axis=1)
        # a child holds half of its node and the spill, and may hold the whole group
        share = (degree.max() + 3 * np.sqrt(degree.max()) + 5) / n
        levels = np.ceil(np.log(1 / (DENSE * share)) / -np.log(0.5 + SPILL))
        left = np.ones(n, bool)
        pivots = []
        while left.any():
            best = int(np.where(left, degree, 0).argmax())
            if degree[best] < max(2, left.sum() / DENSE, n / (4 * DENSE)):
                break
            pivots.append(units[best].tolist())
            gone = left & linked[best]
            gone[best] = True
            degree = degree - linked[:, gone].sum(axis=1)
            left &= ~gone
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()),
                         "node": pa.array([key[1].as_py()], pa.int64()),
                         "pivots": pa.array([pivots], pa.list_(pa.list_(pa.float64()))),
                         "next": pa.array([level + max(1, int(levels))], pa.int32())})

    return (sample.select("tree", "node", "class_id").join(points.select("class_id", "vector"), "class_id")
            .groupBy("tree", "node").applyInArrow(
                find, "tree int, node long, pivots array<array<double>>, next int"))


def _peel(rows: DataFrame, points: DataFrame, pivots: DataFrame, level: int,
          min_cosine: float) -> DataFrame:
    """Rows of the nodes in ``pivots`` -> the same with (core, fringes): the first
    pivot a class is linked with, or null, and the pivots before whose fringe it
    is in."""
    near = 2 * min_cosine ** 2 - 1 - 1e-9 if min_cosine > 0 else -2.0

    @F.pandas_udf("array<int>")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for vector, named in batches:
            out = []
            for v, ps in zip(vector, named):
                unit = v / np.sqrt(v @ v)
                found = [-1]
                for j, p in enumerate(ps):
                    cosine = p @ unit if len(p) == len(unit) else -2.0
                    if cosine >= min_cosine:
                        found[0] = j
                        break
                    if len(p) == len(unit) and cosine >= near:
                        found.append(j)
                out.append(found)
            yield pd.Series(out)

    salted = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    name = lambda j: F.xxhash64(F.lit("peel"), "tree", "node", F.lit(level), j)
    return (rows.withColumn("salt", F.pmod(F.xxhash64("class_id"), F.lit(SALTS)).cast("int"))
            .join(salted, ["tree", "node", "salt"])
            .join(points.select("class_id", "vector"), "class_id")
            .select(*rows.columns, place("vector", "pivots").alias("at"))
            .select(*rows.columns,
                    F.when(F.col("at")[0] >= 0, name(F.col("at")[0])).alias("core"),
                    F.transform(F.expr("slice(at, 2, size(at))"), name).alias("fringes")))


def leaves(points: DataFrame, trees: int = TREES, leaf: int = LEAF, *,
           min_cosine: float = MIN_COSINE) -> DataFrame:
    """classes -> (class_id, node, part): the leaves, cores and fringes of each
    class over all trees.

    One round per level; rows of nodes that are small enough leave the loop.  A
    node with pivots loses their cores and waits for the next round unsplit.
    Tree -1 is the label before the trees part.  ``due`` is the level at which a
    node is next searched for pivots, ``ats`` its tree's next projections."""
    labels = points.groupBy("label").agg(F.count(F.lit(1)).alias("k"))
    small = labels.where(F.col("k") <= leaf).select("label")
    root = F.xxhash64(F.lit("root"), F.col("label"))
    done = [points.join(small, "label", "left_semi").select(
        "class_id", root.alias("node"), F.lit("leaf").alias("part"))]
    vectors = points.join(small, "label", "left_anti").select("class_id", "label", "vector")
    rows = vectors.select("class_id", F.lit(-1).alias("tree"), root.alias("node"),
                          F.lit(0).alias("due"), F.lit(None).cast("array<double>").alias("ats"))
    known: dict[int, DataFrame] = {}

    def projected(rows: DataFrame, level: int) -> DataFrame:
        first = level - level % AHEAD
        if first not in known:
            known[first] = materialize(projections(vectors, trees, first), "forest-projections")
        ats = F.when(F.col("tree") >= 0, F.slice("all_at", F.col("tree") * AHEAD + 1, AHEAD))
        return rows.join(known[first], "class_id").select(
            "class_id", "tree", "node", "due", ats.alias("ats"))

    for level in range(MOST_LEVELS):
        rows = materialize(rows, "forest-level")
        sizes = materialize(rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("k"),
                                                             F.max("due").alias("due")), "forest-sizes")
        fit = sizes.where(F.col("k") <= leaf).select("tree", "node")
        done.append(rows.join(fit, ["tree", "node"], "left_semi").select(
            "class_id", F.xxhash64("tree", "node").alias("node"), F.lit("leaf").alias("part")))
        large = sizes.where(F.col("k") > leaf)
        if large.isEmpty():
            break
        whole = rows.join(large.select("tree", "node"), ["tree", "node"], "left_semi")
        rest = None
        searched = large.where(F.col("due") <= level).select("tree", "node", "k")
        if not searched.isEmpty():
            found = materialize(_pivots(rows.join(searched, ["tree", "node"]), points, level, leaf,
                                        min_cosine), "forest-pivots")
            pivots = found.where(F.size("pivots") > 0).select("tree", "node", "pivots")
            if not pivots.isEmpty():
                dense = whole.join(pivots.select("tree", "node"), ["tree", "node"], "left_semi")
                peeled = materialize(_peel(dense, points, pivots, level, min_cosine), "forest-peeled")
                done.append(peeled.where("core is not null").select(
                    "class_id", F.col("core").alias("node"), F.lit("core").alias("part")))
                done.append(peeled.select("class_id", F.explode("fringes").alias("node"),
                                          F.lit("fringe").alias("part")))
                rest = peeled.where("core is null").select("class_id", "tree", "node", "due", "ats")
                whole = whole.join(pivots.select("tree", "node"), ["tree", "node"], "left_anti")
            whole = whole.join(found.select("tree", "node", "next"), ["tree", "node"], "left").select(
                "class_id", "tree", "node", F.coalesce("next", "due").alias("due"), "ats")
        parted = whole.where("tree < 0").select(
            "class_id", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "node", "due")
        split = _split(whole.where("tree >= 0").withColumn("at", F.col("ats")[level % AHEAD]))
        kept = split if rest is None else split.unionByName(rest)
        if (level + 1) % AHEAD == 0:
            rows = projected(parted.unionByName(kept.drop("ats")), level + 1)
        elif sizes.where("tree < 0").isEmpty():
            rows = kept
        else:
            rows = projected(parted, level + 1).unionByName(kept)
    else:
        if not rows.isEmpty():
            raise RuntimeError(f"classes remain in large nodes after {MOST_LEVELS} levels")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.distinct()


def _blocks(leaf_rows: DataFrame) -> DataFrame:
    """(class_id, node, part, block, low, high): a leaf is one block; a core and
    its fringe are cut into blocks of half a leaf, and every pair of blocks with
    a block of the core is a group (node, low, high)."""
    one = leaf_rows.where("part = 'leaf'").select(
        "class_id", "node", "part", *[F.lit(0).alias(c) for c in ("block", "low", "high")])
    cut = leaf_rows.where("part <> 'leaf'")
    half = F.lit(max(1, LEAF // 2))
    number = lambda part: F.ceil(F.count(F.when(F.col("part") == part, 1)) / half).cast("int")
    counts = cut.groupBy("node").agg(number("core").alias("c"), number("fringe").alias("f"))
    counts = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    key = F.xxhash64("class_id", "node")
    core = F.col("part") == "core"
    last = F.when(core, F.col("c") + F.col("f")).otherwise(F.col("c")) - 1
    block = F.when(core, F.pmod(key, F.col("c"))).otherwise(
        F.col("c") + F.pmod(key, F.greatest(F.col("f"), F.lit(1)))).cast("int")
    pairs = (cut.withColumn("salt", F.pmod(F.xxhash64("class_id"), F.lit(SALTS)).cast("int"))
             .join(counts, ["node", "salt"]).where("c > 0")
             .select("class_id", "node", "part", block.alias("block"),
                     F.explode(F.sequence(F.lit(0), last)).alias("other")))
    return one.unionByName(pairs.select(
        "class_id", "node", "part", "block", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high")))


def compare(points: DataFrame, leaf_rows: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(class_id, links, root): per leaf or pair of blocks the vectors linked with
    each class, counted in the first leaf that both share, and the smallest rep
    connected there."""
    names = lambda fringe: F.sort_array(F.collect_list(
        F.when((F.col("part") == "fringe") == fringe, F.col("node"))))
    all_leaves = leaf_rows.groupBy("class_id").agg(names(False).alias("leaves"),
                                                   names(True).alias("fringes"))
    placed = (points.join(all_leaves, "class_id").join(_blocks(leaf_rows), "class_id")
              .select("class_id", "rep", "size", "vector", "leaves", "fringes", "node",
                      "block", "low", "high"))

    def block(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        node, low, high = (k.as_py() for k in key)
        class_id = group.column("class_id").to_numpy()
        rep = group.column("rep").to_numpy()
        size = group.column("size").to_numpy()
        side = group.column("block").to_numpy()
        held = [_earlier(group.column(c), node) for c in ("leaves", "fringes")]
        out_class, out_links, out_root = [], [], []
        for rows, x in _units(group.column("vector")):
            a, b = _linked(x, min_cosine)
            if low != high:
                crossing = side[rows[a]] != side[rows[b]]
                a, b = a[crossing], b[crossing]
            first = ~_share_earlier(*held, len(side), rows[a], rows[b])
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, a[first], size[rows[b[first]]])
            np.add.at(links, b[first], size[rows[a[first]]])
            root = _local_roots(rep[rows], a, b)
            touched = np.zeros(len(rows), bool)
            touched[a] = touched[b] = True
            out_class.append(class_id[rows][touched])
            out_links.append(links[touched])
            out_root.append(root[touched])
        return pa.table({"class_id": np.concatenate(out_class).astype(np.int64),
                         "links": np.concatenate(out_links).astype(np.int64),
                         "root": np.concatenate(out_root).astype(np.int64)})

    return placed.groupBy("node", "low", "high").applyInArrow(
        block, "class_id long, links long, root long")


def _linked(x: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b), a < b, of unit vectors with a cosine of ``min_cosine`` or more."""
    n, dims = x.shape
    rough = x.astype(np.float32)
    a, b = np.nonzero(rough @ rough.T >= min_cosine - (dims + 8) * 2.0 ** -23)
    a, b = a[a < b], b[a < b]
    if len(a) > n * n // 64:
        cosine = (x @ x.T)[a, b]
    else:
        cosine = np.einsum("ij,ij->i", x[a], x[b])
    return a[cosine >= min_cosine], b[cosine >= min_cosine]


def _earlier(lists: pa.ChunkedArray, node: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, names): the names before ``node`` in each row's list, by row."""
    column = lists.combine_chunks()
    bounds = column.offsets.to_numpy()
    names = column.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]]
    rows = np.repeat(np.arange(len(column)), np.diff(bounds))
    return rows[names < node], names[names < node]


def _share_earlier(own: tuple[np.ndarray, np.ndarray], fringe: tuple[np.ndarray, np.ndarray],
                   n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows a and b of each pair share one of their own leaves or cores,
    or one is in the core whose fringe the other is in; of n rows.

    Each pair's names are looked up, or where pairs are dense those of all rows
    are multiplied, so the work follows the links and not the leaves of a label."""
    names, at = np.unique(np.concatenate([own[1], fringe[1]]), return_inverse=True)
    if not len(names) or not len(a):
        return np.zeros(len(a), bool)
    codes = at[:len(own[0])], at[len(own[0]):]
    if len(names) <= 4096 and len(a) * len(at) * 2000 > n ** 3 * len(names):
        held = [np.zeros((n, len(names)), np.float32) for _ in range(2)]
        for h, rows, code in zip(held, (own[0], fringe[0]), codes):
            h[rows, code] = 1
        mixed = held[0] @ held[1].T
        return (held[0] @ held[0].T + mixed + mixed.T)[a, b] > 0
    known = np.sort(own[0] * len(names) + codes[0])
    shared = np.zeros(len(a), bool)
    for rows, code in ((own[0], codes[0]), (fringe[0], codes[1])):
        begin = np.searchsorted(rows, np.arange(n + 1))
        for u, v in ((a, b), (b, a)):
            for k in range(0, len(u), 1 << 16):
                count = (begin[1:] - begin[:-1])[u[k:k + (1 << 16)]]
                pair = np.repeat(np.arange(len(count)), count)
                place = begin[u[k + pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
                wanted = v[k + pair] * len(names) + code[place]
                near = np.searchsorted(known, wanted)
                hit = known[np.minimum(near, len(known) - 1)] == wanted if len(known) else np.zeros(0, bool)
                shared[k + pair[hit]] = True
            if rows is own[0]:
                break  # own names are shared either way round
    return shared


def _local_roots(rep: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest rep connected with each row by the edges (a, b)."""
    root = rep.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            return root


def join(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """vectors (vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    members, points = classes(vectors)
    points = materialize(points.where("rep is not null"), "forest-classes")
    placed = materialize(leaves(points, min_cosine=min_cosine), "forest-leaves")
    found = materialize(compare(points, placed, min_cosine), "forest-links")
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    edges = found.join(points.select("class_id", F.col("rep").alias("u")), "class_id").select(
        "u", F.col("root").alias("v"))
    named = components(edges, name="forest-components")
    by_class = (points.select("class_id", F.col("rep").alias("node"))
                .join(counts, "class_id").join(named, "node")
                .select("class_id", "links", "component"))
    member = members.join(by_class, "class_id", "left").select(
        "vec_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    alone = vectors.where(~(F.col("label").isNotNull() & usable(F.col("embedding")))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return member.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL
    AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM good a JOIN good b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r AS (SELECT vec_id AS start, vec_id AS node FROM v
      UNION SELECT r.start, l.w FROM r JOIN l ON l.u = r.node),
c AS (SELECT start, min(node) AS component_id FROM r GROUP BY 1),
k AS (SELECT u, count(*) AS n_links FROM l GROUP BY 1)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id,
       vec_id = component_id AS kept
FROM v JOIN c ON c.start = v.vec_id LEFT JOIN k ON k.u = v.vec_id
"""
