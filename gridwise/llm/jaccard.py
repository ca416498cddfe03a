"""Jaccard self-join on word shingles by token-combination prefixes.

Texts with equal shingle sets are one node.  A node's tokens (shingle hashes)
are ordered rare ones first, by hash within a class, and its prefix is as long
as the threshold needs: of ``e = n - ceil(t * n)`` tokens that a partner may
lack, one fewer than the prefix can lose.

* Rare tokens are indexed one by one.
* Frequent tokens are dealt by hash into small classes, and every pair of
  tokens of one class is indexed instead; the prefix is extended until, after
  any e losses, a rare token or two tokens of one class are left.  The number
  of classes follows the size of a set; sets that can be similar share a size
  step, for which both index.

A token is frequent when more than ``RARE_LIMIT`` different sets hold it.  All
tokens are counted, by 32-bit bucket; the result is a bitmap of 2**27 cells
(16 MB whatever the data) with the cells of heavy buckets set, which is all that is
broadcast.  A rare token in such a cell counts as frequent too: a token's class
need only be the same everywhere.

Verification goes in rounds over signature groups, so that a group of g alike
texts costs about g comparisons, not g**2: first each node is compared with its
neighbours in the order of sizes, then (where a group still has several
components) with a neighbour in a random order, and at last the nodes outside a
group's largest component with one another and with that component's nodes.
Pairs left out are pairs that are connected already.  Every link joins what it
should and no link is lost for the components.

Before texts are fetched, a pair's parity bits (``PARITY_BITS`` bits of a set,
of which every token flips one) are compared: they bound the tokens in which
the sets differ from below, so no similar pair is left out.

Defined results: a null text, or one without words, has 0 shingles and is its
own component.  Rows with equal sets are linked; repeated rows fall together.
A null doc_id never names a component: such a row reports that of its set, or
null.  An id that stands for several texts links them when it is the smallest
id of its set.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwise.llm import shingles
from gridwise.llm.common import (components, group_min_by_salt, materialize, release_memory,
                                 table)

PERCENT = 75
SALTS = 64
RARE_LIMIT = 4
CELL_BITS = 27
GROUP_TOKENS = 1 << 21
BATCH_CHARS = 1 << 20
SLICE_ROWS = 256
PARITY_BITS = 1024
BROADCAST_IDS = 1 << 20
CACHED_TOKENS = 1 << 20
_SINGLE, _PAIR = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


# -- sets and their classes ---------------------------------------------------

def set_index(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (doc_id, n_shingles, h1, h2, bits): the set's size,
    128 bits that stand for it (null for an empty set), and its parity bits."""

    @F.pandas_udf("n_shingles long, h1 long, h2 long, bits array<long>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for part in _parts(texts.tolist()):
                rows += [(len(s), *shingles.digest(s), parity_bits(s)) if len(s)
                         else (0, None, None, None) for s in shingles.sets(part)]
            # nullable integers column by column: a frame of rows would turn
            # longs beside nulls into doubles
            n, h1, h2, bits = zip(*rows) if rows else ((), (), (), ())
            yield pd.DataFrame({"n_shingles": pd.array(n, dtype="int64"),
                                "h1": pd.array(h1, dtype="Int64"),
                                "h2": pd.array(h2, dtype="Int64"),
                                "bits": pd.Series(bits, dtype=object)})

    return docs.select("doc_id", measure(F.col("text")).alias("m")).select("doc_id", "m.*")


def parity_bits(one: np.ndarray) -> np.ndarray:
    """Each token flips one of ``PARITY_BITS`` bits, so the bits in which two
    sets differ are no more than the tokens in which they differ."""
    flips = np.bincount((one % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((flips & 1).astype(bool), bitorder="little").view("<i8")


def _parts(texts: list) -> Iterator[list]:
    """Runs of texts of about ``BATCH_CHARS`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _text_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """The texts of batches in runs of about ``BATCH_CHARS`` characters, taken out of
    the batch a few rows at a time."""
    for batch in batches:
        texts = batch.column("text")
        held, size = [], 0
        for at in range(0, len(texts), SLICE_ROWS):
            for text in texts.slice(at, SLICE_ROWS).to_pylist():
                held.append(text)
                size += len(text or "")
                if size >= BATCH_CHARS:
                    yield held
                    held, size = [], 0
        if held:
            yield held
    release_memory()


def _distinct_sets(batches) -> Iterator[list[tuple[int, np.ndarray]]]:
    """(first half of the digest, set) of the different non-empty sets of runs of texts."""
    for part in _text_parts(batches):
        found: dict[tuple[int, int], np.ndarray] = {}
        for s in shingles.sets(part):
            if len(s):
                found.setdefault(shingles.digest(s), s)
        yield [(d[0], s) for d, s in found.items()]


def allowed_loss(n, percent: int = PERCENT):
    """How many of n tokens a similar set may lack."""
    return n - (percent * n + 99) // 100


# -- frequent tokens ----------------------------------------------------------

def heavy_cells(docs: DataFrame, tokens: int, limit: int = RARE_LIMIT) -> np.ndarray:
    """The bitmap of the cells (first ``CELL_BITS`` bits of a token) that hold a
    32-bit bucket of more than ``limit`` different sets.

    Every task sends, per range of buckets, the buckets it saw as differences
    (whose high bytes are zero and compress away) with their counts; a range
    comes back as its slice of the bitmap."""
    groups = min(_groups(tokens, GROUP_TOKENS), 1 << 16)
    bits = groups.bit_length() - 1
    shift = np.uint32(32 - bits)
    slice_bits = CELL_BITS - bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _distinct_sets(batches):
            if not found:
                continue
            all_buckets = np.concatenate([np.unique((s >> np.uint64(32)).astype(np.uint32))
                                          for _, s in found])
            bucket, n = np.unique(all_buckets, return_counts=True)
            group = bucket >> shift
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
            keys, blobs, counts = [], [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                steps = np.diff(bucket[a:b], prepend=np.uint32(0)).astype("<u4")
                keys.append(int(group[a]))
                blobs.append(steps.view(np.uint8).reshape(-1, 4).T.tobytes())
                counts.append(n[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), pa.array(blobs, pa.binary()),
                 pa.array(counts, pa.binary())], ["part", "buckets", "counts"])

    def planes(blob: bytes) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]

    def total(rows: pa.Table) -> pa.Table:
        bucket = np.concatenate([np.cumsum(planes(b), dtype=np.uint32)
                                 for b in rows.column("buckets").to_pylist()])
        n = np.concatenate([planes(b) for b in rows.column("counts").to_pylist()])
        order = np.argsort(bucket, kind="stable")
        bucket, n = bucket[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        sums = np.add.reduceat(n.astype(np.int64), first)
        cells = bucket[first][sums > limit] >> np.uint32(32 - CELL_BITS)
        marked = np.zeros(1 << slice_bits, bool)
        marked[cells & np.uint32((1 << slice_bits) - 1)] = True
        packed = zlib.compress(np.packbits(marked, bitorder="little").tobytes(), 1)
        release_memory()
        return pa.table({"part": pa.array([int(bucket[0] >> shift)], pa.int32()),
                         "cells": pa.array([packed], pa.binary())})

    slices = (docs.select("text").mapInArrow(count, "part int, buckets binary, counts binary")
              .groupBy("part").applyInArrow(total, "part int, cells binary"))
    bitmap = np.zeros(1 << (CELL_BITS - 3), np.uint8)
    width = 1 << (slice_bits - 3)
    for row in slices.collect():  # the slices of one bitmap, packed
        bitmap[row["part"] * width:(row["part"] + 1) * width] = np.frombuffer(
            zlib.decompress(row["cells"]), np.uint8)
    return bitmap


def _groups(tokens: int, size: int) -> int:
    """A power of two, at least 64, so that a group gets about ``size`` tokens."""
    return 1 << max(6, (max(1, tokens // size) - 1).bit_length())


# -- signatures ---------------------------------------------------------------

def size_steps(n: int, percent: int = PERCENT) -> range:
    """Steps (powers of four) of the sizes that sets similar to one of n tokens
    can have; two similar sets have the step of either's size in common."""
    least, most = -(-percent * n // 100), 100 * n // percent
    return range((least.bit_length() - 1) // 2, (most.bit_length() - 1) // 2 + 1)


def class_count(step: int, percent: int = PERCENT) -> int:
    """Classes of frequent tokens for sets of a step: about as many as tokens
    that a set in the middle of it may lack."""
    return max(1, 2 * 4 ** step * (100 - percent) // 100)


def token_pairs(rare: int, frequent: np.ndarray, n: int, step: int,
                percent: int = PERCENT) -> np.ndarray:
    """Signatures of the pairs of frequent tokens in the prefix of a set.

    The prefix takes frequent tokens, in order, until the rare ones and, of each
    class, all but one token outnumber the allowed loss."""
    m = class_count(step, percent)
    cls = (shingles.mix(frequent ^ _PAIR) % np.uint64(m)).astype(np.int64)
    first = np.zeros(len(frequent), bool)
    first[np.unique(cls, return_index=True)[1]] = True
    spare = np.cumsum(~first) + rare
    enough = np.flatnonzero(spare > allowed_loss(n, percent))
    end = enough[0] + 1 if len(enough) else len(frequent)
    order = np.argsort(cls[:end], kind="stable")
    cls, token = cls[order], frequent[:end][order]
    out, salt = [], shingles.mix(np.array([step + 1], np.uint64))
    for gap in range(1, end):
        same = cls[gap:] == cls[:-gap]
        if not same.any():
            break
        out.append(shingles.mix(shingles.mix(token[:-gap][same] + salt)
                                + token[gap:][same]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _split(found: list[tuple[int, np.ndarray]], heavy: np.ndarray):
    """(h1, n, rare tokens, frequent tokens), each in hash order."""
    tokens = np.concatenate([s for _, s in found])
    cell = tokens >> np.uint64(64 - CELL_BITS)
    is_heavy = (heavy[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
    begin = 0
    for h1, s in found:
        mask = is_heavy[begin:begin + len(s)]
        begin += len(s)
        yield h1, len(s), s[~mask], s[mask]


def shared_tokens(docs: DataFrame, heavy, tokens: int) -> DataFrame:
    """(sig, h1, n) for rare prefix tokens that at least two nodes index.

    Prefixes travel as arrays per range of token values.  A rare token is held
    by a bounded number of nodes, so ranges are even."""
    groups = _groups(tokens, 2 * GROUP_TOKENS)
    shift = np.uint64(64 - (groups.bit_length() - 1))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _distinct_sets(batches):
            if not found:
                continue
            prefix, owner, sizes = [], [], []
            for h1, n, rare, _ in _split(found, heavy.value):
                prefix.append(rare[:allowed_loss(n) + 1])
                owner.append(h1)
                sizes.append(n)
            count = np.fromiter(map(len, prefix), np.int64, len(prefix))
            token = np.concatenate(prefix)
            if not len(token):
                continue
            node = np.repeat(np.arange(len(prefix)), count)
            part = (token >> shift).astype(np.int64)
            order = np.argsort(part, kind="stable")  # by range, then node, then token
            token, node, part = token[order], node[order], part[order]
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            owner, sizes = np.array(owner, np.int64), np.array(sizes, np.int64)
            columns = [[], [], [], [], []]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                nodes, runs = np.unique(node[a:b], return_counts=True)
                for c, x in zip(columns, (int(part[a]), token[a:b].tobytes(),
                                          owner[nodes].tobytes(),
                                          sizes[nodes].astype("<i4").tobytes(),
                                          runs.astype("<i4").tobytes())):
                    c.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary())
                                                      for c in columns[1:]],
                ["part", "tokens", "nodes", "sizes", "runs"])

    def shared(rows: pa.Table) -> pa.Table:
        def whole(name, kind):
            return np.concatenate([np.frombuffer(b, kind) for b in rows.column(name).to_pylist()])

        runs = whole("runs", "<i4")
        token = whole("tokens", np.uint64)
        node = np.repeat(whole("nodes", np.int64), runs)
        size = np.repeat(whole("sizes", "<i4"), runs)
        order = np.lexsort((node, token))
        token, node, size = token[order], node[order], size[order]
        fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
        token, node, size = token[fresh], node[fresh], size[fresh]
        first = np.concatenate([[True], token[1:] != token[:-1]])
        last = np.concatenate([first[1:], [True]])
        keep = ~(first & last)
        return pa.table({"sig": shingles.mix(token[keep] ^ _SINGLE).view(np.int64),
                         "h1": node[keep], "n": size[keep].astype(np.int32)})

    return (docs.select("text")
            .mapInArrow(index, "part int, tokens binary, nodes binary, sizes binary, runs binary")
            .groupBy("part").applyInArrow(shared, "sig long, h1 long, n int"))


def pair_signatures(docs: DataFrame, heavy) -> DataFrame:
    """(sig, h1, n) for the token pairs of nodes whose prefix reaches their
    frequent tokens."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _distinct_sets(batches):
            for h1, n, rare, frequent in _split(found, heavy.value) if found else ():
                if len(rare) > allowed_loss(n):
                    continue
                sig = np.unique(np.concatenate([
                    token_pairs(len(rare), frequent, n, s) for s in size_steps(n)]))
                if len(sig):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sig.view(np.int64)),
                         pa.array(np.full(len(sig), h1, np.int64)),
                         pa.array(np.full(len(sig), n, np.int32))], ["sig", "h1", "n"])

    return docs.select("text").mapInArrow(index, "sig long, h1 long, n int").distinct()


# -- candidate pairs and verification -----------------------------------------

def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def neighbours(groups: DataFrame, order: list, *more: str) -> DataFrame:
    """(a, b) of nodes that stand side by side in their signature group.

    A group is cut by salt, so none is sorted whole in one task; the first nodes
    of the cuts are then compared among themselves."""
    salted = groups.withColumn("salt", F.pmod(F.xxhash64("h1"), F.lit(SALTS)))
    columns = ["sig", "h1", "n", *more]

    def chained(df: DataFrame, window) -> DataFrame:
        return df.select("*", *[F.lag(c).over(window).alias(f"p_{c}") for c in columns[1:]])

    inner = chained(salted, Window.partitionBy("sig", "salt").orderBy(*order))
    heads = inner.where("p_h1 is null").select(*columns)
    outer = chained(heads, Window.partitionBy("sig").orderBy(*order))
    found = inner.drop("salt").where("p_h1 is not null").unionByName(
        outer.where("p_h1 is not null"))
    alike = (F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * PERCENT)
    for c in more:
        alike = alike & (F.col(c) != F.col(f"p_{c}"))
    return found.where(alike & (F.col("h1") != F.col("p_h1"))).select(
        *_ordered("h1", "p_h1")).distinct()


def nodes(index: DataFrame) -> DataFrame:
    """(h1, rep, n, bits): one row per set, named by its smallest doc_id."""
    return (index.where("h1 is not null and doc_id is not null").groupBy("h1", "h2")
            .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                 F.first("bits").alias("bits")).drop("h2"))


def plausible(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) -> (a, b, u, v) with the ids of both, without those whose
    parity bits differ in more places than similar sets can differ in tokens."""
    for end, rep in (("a", "u"), ("b", "v")):
        pairs = pairs.join(known.select(F.col("h1").alias(end), F.col("rep").alias(rep),
                                        F.col("n").alias(f"n_{end}"),
                                        F.col("bits").alias(f"bits_{end}")), end)
    return pairs.where(may_be_similar("n_a", "bits_a", "n_b", "bits_b")).select("a", "b", "u", "v")


def may_be_similar(n_a: str, bits_a: str, n_b: str, bits_b: str) -> Column:
    """Whether sizes and parity bits of two sets allow them to be similar."""
    differ = F.aggregate(F.zip_with(bits_a, bits_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda s, x: s + x.cast("int"))
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT) & (
        differ * (100 + PERCENT) <= (F.col(n_a) + F.col(n_b)) * (100 - PERCENT))


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (u, v) for the pairs (a, b, u, v) whose sets are similar.  Each row
    holds the texts of one pair; rows stream through."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[tuple[int, int], np.ndarray] = {}  # by node: its digest and id
        held = 0
        for batch in batches:
            links = []
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                ends = [list(zip(rows.column(h).to_pylist(), rows.column(i).to_pylist()))
                        for h, i in (("a", "u"), ("b", "v"))]
                if held > CACHED_TOKENS:
                    recent.clear()
                    held = 0
                fresh: dict[tuple[int, int], tuple[str, int]] = {}
                for nodes_of, column in zip(ends, ("ta", "tb")):
                    for i, node in enumerate(nodes_of):
                        if node not in recent:
                            fresh.setdefault(node, (column, i))
                names, texts, size = [], [], 0
                for node, (column, i) in fresh.items():
                    text = rows.column(column)[i].as_py()
                    names.append(node)
                    texts.append(text)
                    size += len(text)
                    if size >= BATCH_CHARS:
                        found = shingles.sets(texts)
                        held += sum(map(len, found))
                        recent.update(zip(names, found))
                        names, texts, size = [], [], 0
                if names:
                    found = shingles.sets(texts)
                    held += sum(map(len, found))
                    recent.update(zip(names, found))
                for i, (one, other) in enumerate(zip(*ends)):
                    x, y = recent[one], recent[other]
                    both = np.intersect1d(x, y, assume_unique=True).size
                    if 100 * both >= PERCENT * (len(x) + len(y) - both):
                        links.append(at + i)
            yield batch.select(["u", "v"]).take(pa.array(links, pa.int64()))
        recent.clear()
        release_memory()

    texts = _node_texts(docs, pairs.select(F.col("a").alias("h1"), F.col("u").alias("rep"))
                        .unionByName(pairs.select(F.col("b").alias("h1"), F.col("v").alias("rep")))
                        .distinct())
    left = texts.select(F.col("h1").alias("a"), F.col("rep").alias("u"), F.col("text").alias("ta"))
    right = texts.select(F.col("h1").alias("b"), F.col("rep").alias("v"), F.col("text").alias("tb"))
    return (pairs.join(left, ["a", "u"]).join(right, ["b", "v"]).select("a", "b", "u", "v", "ta", "tb")
            .mapInArrow(compare, "u long, v long"))


def _node_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, rep, text) of the wanted nodes (h1, rep): one text each.

    The ids are broadcast only where they are few, counted first; otherwise
    ids and documents are shuffled."""

    @F.pandas_udf("long")
    def digest_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingles.digest(s)[0] for part in _parts(texts.tolist())
                             for s in shingles.sets(part)], dtype="int64")

    wanted = materialize(wanted, "jaccard-wanted")
    count = wanted.count()
    rows = docs.where("text is not null").select(F.col("doc_id").alias("rep"), "text").join(
        F.broadcast(wanted) if count <= BROADCAST_IDS else wanted, "rep")
    # an id may stand for several texts: the node's own is the one with its digest
    texts = materialize(rows.select("rep", "h1", "text", digest_of(F.col("text")).alias("d"))
                        .where("d = h1").drop("d"), "jaccard-texts")
    return texts if texts.count() <= count else texts.dropDuplicates(["rep", "h1"])


def _named(known: DataFrame, found: DataFrame) -> DataFrame:
    """(h1, n, bits, component) of all nodes."""
    return (known.select("h1", "n", "bits", F.col("rep").alias("node"))
            .join(found, "node", "left")
            .select("h1", "n", "bits", F.coalesce("component", "node").alias("component")))


def _undecided(groups: DataFrame, known: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (sig, h1, n, component) of the groups that hold several components."""
    rows = groups.join(_named(known, found).select("h1", "component"), "h1")
    open_groups = rows.groupBy("sig").agg(F.min("component").alias("lo"),
                                          F.max("component").alias("hi")).where("lo < hi")
    return rows.join(open_groups.select("sig"), "sig").select("sig", "h1", "n", "component")


def _outside_pairs(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs (a, b) that may still join components: nodes outside their group's
    largest component, with one another and with that component's nodes, where
    sizes allow.  The latter are paired once per component, not once per group."""
    sizes = rows.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("sig").agg(
        F.max(F.struct("k", "component"))["component"].alias("main"))
    # the joins themselves leave out what sizes and parity bits rule out
    alike = may_be_similar("n", "bits", "o_n", "o_bits")
    outside = (rows.join(main, "sig").where("component <> main")
               .join(named.select("h1", "bits"), "h1"))
    o = outside.select("sig", "main", F.col("h1").alias("o_h1"), F.col("n").alias("o_n"),
                       F.col("bits").alias("o_bits"), F.col("component").alias("o_c"))
    to_main = o.select("main", "o_h1", "o_n", "o_bits").distinct().join(
        named, (F.col("component") == F.col("main")) & alike)
    inner = outside.drop("main").withColumnRenamed("sig", "i_sig")
    others = o.join(inner, (F.col("sig") == F.col("i_sig")) & (F.col("o_h1") < F.col("h1"))
                    & (F.col("component") != F.col("o_c")) & alike)
    return to_main.select(*_ordered("h1", "o_h1")).unionByName(
        others.select(*_ordered("h1", "o_h1"))).distinct()


def join(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = materialize(set_index(docs), "jaccard-index")
    tokens = index.agg(F.sum("n_shingles")).first()[0] or 0
    heavy = spark.sparkContext.broadcast(heavy_cells(docs, tokens))
    groups = materialize(shared_tokens(docs, heavy, tokens).unionByName(
        pair_signatures(docs, heavy)), "jaccard-groups")
    heavy.destroy()  # the groups are written
    known = materialize(nodes(index), "jaccard-nodes")

    tested = materialize(neighbours(groups, ["n", "h1"]), "jaccard-pairs")
    likely = materialize(plausible(tested, known), "jaccard-likely")
    links = materialize(verified(likely, docs), "jaccard-links")
    found = materialize(components(links, name="jaccard-components"), "jaccard-found")
    for pairs_of in (lambda r: neighbours(r, [F.xxhash64("sig", "h1"), "h1"], "component"),
                     lambda r: _outside_pairs(r, _named(known, found))):
        rows = materialize(_undecided(groups, known, found), "jaccard-undecided")
        if rows.isEmpty():
            break
        fresh = materialize(pairs_of(rows).join(tested, ["a", "b"], "left_anti"), "jaccard-pairs")
        likely = materialize(plausible(fresh, known), "jaccard-likely")
        tested = tested.unionByName(fresh)
        if likely.isEmpty():
            continue
        more = materialize(verified(likely, docs), "jaccard-links")
        if not more.isEmpty():
            # what is joined already counts as a star, so only what is new takes rounds
            links = found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)
            found = materialize(components(links, name="jaccard-components"), "jaccard-found")

    # membership: a set's smallest id, and that id's component, per set and salt
    keyed = index.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    reps = group_min_by_salt(keyed.where("h1 is not null"), ["h1", "h2"], "salt", "doc_id", "rep")
    named = (reps.join(found, reps["rep"] == found["node"], "left")
             .select("h1", "h2", "salt", F.coalesce("component", "rep").alias("component_id")))
    member = keyed.where("h1 is not null").join(named, ["h1", "h2", "salt"]).select(
        "doc_id", "n_shingles", "component_id")
    return member.unionByName(index.where("h1 is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3),
         lambda i: array_to_string(words[i:i + 4], ' '))) END AS grams FROM w),
n AS (SELECT doc_id, CAST(len(grams) AS BIGINT) AS n FROM g),
t AS (SELECT doc_id, unnest(grams) AS gram FROM g),
-- shared shingles by pair, the smaller id first
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
      FROM t a JOIN t b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
      WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id AS start, doc_id AS node FROM n
      UNION SELECT r.start, e.v FROM r JOIN e ON e.u = r.node)
SELECT n.doc_id, n.n AS n_shingles, min(r.node) AS component_id
FROM n JOIN r ON r.start = n.doc_id GROUP BY 1, 2
"""
