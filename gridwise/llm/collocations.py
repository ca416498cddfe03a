"""Phrase collocations by dynamic itemset counting.

The texts are encoded once: a 64-bit hash per (lang, word), 0 between pieces,
written in ``SHARDS`` shards.  The shards are then scanned in a cycle, one a
step.  Words count from step 0 on.  A longer phrase is active from the step after
both its subphrases (all words but the last, all but the first) have reached the
threshold, and counts for one full cycle from there.  So one scan counts phrases
of several lengths, each from where it became active, and the scans end when the
last active phrase has seen every shard.

A phrase is known by a hash while it counts.  Its tasks' counts go to buckets as
packed arrays (six bytes a phrase); a bucket holds about ``BUCKET_WORDS`` words'
phrases at any size of corpus.  The steps at which phrases reached the threshold
are told to the next scan by an array of at most 2**MAX_CELL_BITS bytes: that is
all that is broadcast or collected, whatever the corpus.  Phrases that share a
cell or a hash can only add candidates.  A last scan names the candidates by
their words' hashes and counts them exactly; ``spellings`` reads the texts once more
for the candidates' words' own texts and makes sure that none of them shares its hash
with another word (another seed is taken if one does).

Defined results: null and empty texts have no words; a null lang is ``und``.
Repeated rows count as often as they occur.  Very long texts are encoded in
segments, with the words around a border repeated but counted once.  An empty
table gives no rows.  Extra columns are ignored.  Ties are cut as the contract
says: score, then count, then the phrase in UTF-8 byte order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwise.llm.common import discard, materialize, release_memory, table

THRESHOLD = 100
LONGEST = 5
TOP = 2000
SHARDS = 3
SEGMENT_BYTES = 1 << 21
CHUNK_WORDS = 1 << 15
KNOWN_WORDS = 40_000  # of a language, in a task that hashes words
SEEN_WORDS = 100_000  # of all languages, in a task that spells words
TASK_LANGS = 16
COUNT_BUFFER = 1 << 20
NAMED_BUFFER = 1 << 18
BUCKET_WORDS = 1 << 19
MIN_CELL_BITS, MAX_CELL_BITS = 16, 26
UNREACHED = 255

BORDER = b"\xff"  # occurs in no UTF-8 text
_TO_BORDER = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BORDER * 10)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def segments(data: bytes, limit: int = SEGMENT_BYTES) -> Iterator[list[bytes]]:
    """The words of a text and BORDER between pieces, in segments cut at a blank
    or a border at or after ``limit`` bytes."""
    data = data.translate(_LOWER).translate(_TO_BORDER)
    start = 0
    while start < len(data):
        end = start + limit
        if end < len(data):
            ends = [at for at in (data.find(c, end) for c in (b" ", b"\t", BORDER)) if at >= 0]
            end = min(ends) if ends else len(data)
        # blanks and tabs are the only white space left: all other became BORDER
        yield data[start:end].replace(BORDER, b" \xff ").split()
        start = end


class _Lang(dict):
    """Hash of each word of one language."""

    def __init__(self, lang: str, seed: int):
        super().__init__({BORDER: 0})
        self.seed, self.prefix = seed, lang.encode() + BORDER

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
            self[BORDER] = 0
        h = xxhash.xxh3_64_intdigest(self.prefix + word, self.seed) or 1
        self[word] = h
        return h


ENCODED = pa.schema([("shard", pa.int32()), ("ids", pa.binary()), ("lead", pa.int32()),
                     ("words", pa.int64()), ("lang", pa.string())])


def encode(docs: DataFrame, seed: int, shards: int = SHARDS, longest: int = LONGEST,
           name: str = "phrase-words") -> DataFrame:
    """Two kinds of rows: chunks (shard, ids, lead, words), ids being hashes as
    little-endian 64-bit integers of which the first ``lead`` were counted in the
    chunk before; and each task's number of words per language (lang, words)."""

    def chunk(shard: int, ids: list[np.ndarray], lead: int, words: int) -> pa.RecordBatch:
        row = {"shard": shard, "ids": np.concatenate(ids).tobytes(), "lead": lead, "words": words}
        return pa.RecordBatch.from_pylist([row], schema=ENCODED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, _Lang] = {}
        totals: dict[str, int] = {}
        held: list[np.ndarray] = []
        lead = size = words = 0
        shard = 0
        end = np.zeros(1, dtype=np.uint64)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for at in range(batch.num_rows):
                shard = batch.column("shard")[at].as_py()
                lang = batch.column("lang")[at].as_py()
                for tokens in segments(texts[at].as_py() or b""):
                    known = langs.get(lang)
                    if known is None:
                        if len(langs) > TASK_LANGS:
                            langs.clear()
                        known = langs[lang] = _Lang(lang, seed)
                    ids = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64,
                                      count=len(tokens))
                    found = int(np.count_nonzero(ids))
                    totals[lang] = totals.get(lang, 0) + found
                    held.append(ids)
                    size += len(ids)
                    words += found
                    if size >= CHUNK_WORDS:
                        whole = np.concatenate(held)
                        yield chunk(shard, [whole], lead, words)
                        # the words before the cut that a phrase across it begins with
                        tail = whole[-(longest - 1):]
                        cut = np.flatnonzero(tail == 0)
                        tail = tail[cut[-1] + 1:] if len(cut) else tail
                        held, size, lead, words = [tail], len(tail), len(tail), 0
                held.append(end)
                size += 1
        if words:
            yield chunk(shard, held, lead, words)
        yield pa.RecordBatch.from_pylist([{"lang": k, "words": n} for k, n in totals.items()],
                                         schema=ENCODED)
        langs.clear()
        release_memory()

    dealt = docs.select(F.pmod(F.spark_partition_id(), F.lit(shards)).cast("int").alias("shard"),
                        _lang().alias("lang"), "text")
    return materialize(dealt.mapInArrow(
        rows, "shard int, ids binary, lead int, words bigint, lang string"), name)


def _lang() -> Column:
    return F.coalesce("lang", F.lit("und"))


def candidate_words(named: DataFrame, layout: Layout) -> bytes:
    """The cells of the words of candidate phrases, compressed: each task's as an array,
    so at most 4 * 2**cell_bits bytes of one task are with the driver at a time."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, dtype=np.uint32)
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            found = np.union1d(found, layout.cell(layout.place(h)).astype(np.uint32))
        yield pa.RecordBatch.from_arrays([pa.array([found.astype("<u4").tobytes()], pa.binary())], ["cells"])

    h = F.explode(F.array(*[f"w{i + 1}" for i in range(layout.longest)])).alias("h")
    found = named.where("w2 <> 0").select(h).where("h <> 0").distinct().mapInArrow(packed, "cells binary")
    cells = np.full(1 << layout.cell_bits, UNREACHED, dtype=np.uint8)
    for row in found.toLocalIterator():
        cells[np.frombuffer(row["cells"], dtype="<u4")] = 0
    return zlib.compress(cells.tobytes(), 1)


def spellings(docs: DataFrame, seed: int, cells: bytes, layout: Layout) -> DataFrame:
    """(h, lang, word, clash) of the words whose cells are named (and of others
    that share a cell with one); clash marks words that share a hash."""
    shared = docs.sparkSession.sparkContext.broadcast(cells)
    schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("word", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)
        told: dict[str, set[bytes]] = {}
        seen: dict[str, set[bytes]] = {}
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fresh: dict[str, set[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                known, new = seen.setdefault(lang, {BORDER}), fresh.setdefault(lang, set())
                for tokens in segments(text.as_py() or b""):
                    unseen = set(tokens) - known
                    new |= unseen
                    known |= unseen
                if sum(map(len, seen.values())) > SEEN_WORDS:
                    seen.clear()
            for lang, new in fresh.items():
                sent = told.setdefault(lang, set())
                words = list(new - sent)
                prefix = lang.encode() + BORDER
                h = np.fromiter((xxhash.xxh3_64_intdigest(prefix + w, seed) or 1 for w in words),
                                dtype=np.uint64, count=len(words))
                hit = np.flatnonzero(reached[layout.cell(layout.place(h))] != UNREACHED)
                found = [words[i] for i in hit.tolist()]
                sent.update(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[hit].view(np.int64)), pa.array([lang] * len(found), pa.string()),
                     pa.array(found, pa.binary()).cast(pa.string())], schema=schema)
        seen.clear()
        release_memory()

    found = docs.select(_lang().alias("lang"), "text").mapInArrow(
        rows, "h bigint, lang string, word string")
    each = found.repartition("h").distinct()
    same = F.count(F.lit(1)).over(Window.partitionBy("h"))
    return each.withColumn("clash", same > 1)


@dataclass(frozen=True)
class Layout:
    """How hashes are dealt to buckets and cells."""

    buckets: int
    cell_bits: int
    shards: int = SHARDS
    threshold: int = THRESHOLD
    longest: int = LONGEST

    @property
    def count_type(self) -> type:
        return np.uint8 if self.threshold <= 255 else np.uint32

    def place(self, h: np.ndarray) -> np.ndarray:
        """Bucket and 32 further bits of each hash, in the low 56 bits."""
        bucket = ((h >> np.uint64(40)) * np.uint64(self.buckets)) >> np.uint64(24)
        return (bucket << np.uint64(32)) | ((h >> np.uint64(8)) & np.uint64(0xFFFFFFFF))

    def cell(self, place: np.ndarray) -> np.ndarray:
        mixed = place * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.cell_bits)).astype(np.int64)


def phrase_hashes(ids: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, hash, whole) of the phrases starting at each word; whole is false
    where a border lies inside."""
    h, whole = ids, ids != 0
    yield 1, h, whole
    for length in range(2, longest + 1):
        if len(h) < 2:
            return
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[length - 1:]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        whole = whole[:-1] & (ids[length - 1:] != 0)
        yield length, h, whole


def active_phrases(ids: np.ndarray, lead: int, cells: np.ndarray, layout: Layout
                   ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, place, first, reached): of the phrases starting at each word, the
    step from which they count (UNREACHED if no step) and whether they reached the
    threshold.  Phrases that end within the first ``lead`` words counted before."""
    before = None
    for length, h, whole in phrase_hashes(ids, layout.longest):
        place = layout.place(h)
        if length == 1:
            first = np.where(whole, 0, UNREACHED).astype(np.uint8)
        else:
            first = np.where(whole, np.maximum(before[:-1], before[1:]), UNREACHED).astype(np.uint8)
        known = first != UNREACHED
        if length > 1 and not known.any():
            return
        after = np.full(len(first), UNREACHED, dtype=np.uint8)
        after[known] = cells[layout.cell(place[known])]
        before = np.maximum(after, first)
        fresh = first.copy()
        fresh[:max(0, lead - length + 1)] = UNREACHED
        yield length, place, fresh, after != UNREACHED


def _pack(keys: np.ndarray, counts: np.ndarray, layout: Layout) -> Iterator[dict]:
    """Rows (bucket, keys, counts) of sorted keys (place and first step * 8 + length)."""
    bucket = (keys >> np.uint64(40)).astype(np.int64)
    border = np.flatnonzero(np.diff(bucket)) + 1
    counts = np.minimum(counts, layout.threshold).astype(layout.count_type)
    low = keys & np.uint64((1 << 40) - 1)
    for s, e in zip([0, *border.tolist()], [*border.tolist(), len(keys)]):
        if e > s:
            yield {"bucket": int(bucket[s]), "keys": _five_bytes(low[s:e]),
                   "counts": counts[s:e].tobytes()}


def _five_bytes(low: np.ndarray) -> bytes:
    return np.ascontiguousarray(low.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five_bytes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :5] = raw
    return out.view(np.uint64).ravel()


PACKED = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def scan(encoded: DataFrame, step: int, cells: bytes, layout: Layout) -> DataFrame:
    """(bucket, keys, counts): what the phrases active at ``step`` count in its shard."""
    shared = encoded.sparkSession.sparkContext.broadcast(cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)
        held: list[np.ndarray] = []
        size = 0

        def packed() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pylist(list(_pack(keys, counts, layout)), schema=PACKED)

        for batch in batches:
            for data, lead in zip(batch.column("ids"), batch.column("lead").to_pylist()):
                ids = np.frombuffer(data.as_buffer(), dtype=np.uint64)
                for length, place, first, _ in active_phrases(ids, lead, reached, layout):
                    now = (first <= step) & (first.astype(np.int16) > step - layout.shards)
                    meta = first[now].astype(np.uint64) * np.uint64(8) + np.uint64(length)
                    held.append((place[now] << np.uint64(8)) | meta)
                    size += int(now.sum())
                if size > COUNT_BUFFER:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()
            held.clear()
        release_memory()

    shard = encoded.where(F.col("shard") == step % layout.shards).select("ids", "lead")
    return shard.mapInArrow(count, "bucket int, keys binary, counts binary")


STATE = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
                   ("cells", pa.binary()), ("last_cells", pa.binary())])


def merge(counts: DataFrame, step: int, layout: Layout) -> DataFrame:
    """One row per bucket: the phrases whose cycle goes on, with their counts, and the
    cells of those that reached the threshold (``last_cells``: of the longest ones)."""

    def together(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        keys = np.concatenate([_from_five_bytes(k) for k in group["keys"].to_pylist()])
        counts = np.concatenate([np.frombuffer(c, dtype=layout.count_type)
                                 for c in group["counts"].to_pylist()])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        border = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
        keys = keys[border]
        counts = np.add.reduceat(counts.astype(np.int64), border)
        length = keys & np.uint64(7)
        ends = (keys >> np.uint64(3) & np.uint64(31)).astype(np.int64) + layout.shards - 1
        hit = counts >= layout.threshold
        place = (np.uint64(bucket) << np.uint64(32)) | (keys >> np.uint64(8))
        cell = layout.cell(place).astype(np.uint32)
        last = length == layout.longest
        goes_on = ends > step
        kept = np.minimum(counts[goes_on], layout.threshold).astype(layout.count_type)
        row = {"bucket": bucket, "keys": _five_bytes(keys[goes_on]), "counts": kept.tobytes(),
               "cells": np.unique(cell[hit & ~last]).tobytes(),
               "last_cells": np.unique(cell[hit & last]).tobytes()}
        release_memory()
        return pa.Table.from_pylist([row], schema=STATE)

    return counts.groupBy("bucket").applyInArrow(
        together, "bucket int, keys binary, counts binary, cells binary, last_cells binary")


def _new_cells(state: DataFrame, column: str, cells: np.ndarray, step: int) -> bool:
    """Note the cells reached first at ``step``; true if there is one.  A cell is
    collected at most once a step, so at most 4 * 2**cell_bits bytes."""
    new = False
    for row in state.where(F.length(column) > 0).select(column).toLocalIterator():
        at = np.frombuffer(row[0], dtype=np.uint32)
        at = at[cells[at] == UNREACHED]
        cells[at] = step + 1
        new |= bool(len(at))
    return new


def count_cycles(encoded: DataFrame, layout: Layout) -> bytes:
    """Scan the shards until every active phrase has seen all of them; return the
    cells of the phrases that reached the threshold, compressed."""
    cells = np.full(1 << layout.cell_bits, UNREACHED, dtype=np.uint8)
    state, step, last_step = None, 0, layout.shards - 1
    while step <= last_step:
        counts = scan(encoded, step, zlib.compress(cells.tobytes(), 1), layout)
        if state is not None:
            counts = counts.unionByName(state.where(F.length("keys") > 0)
                                        .select("bucket", "keys", "counts"))
        merged = materialize(merge(counts, step, layout), "phrase-state")
        if state is not None:
            discard(state)
        state = merged
        if _new_cells(state, "cells", cells, step):
            last_step = step + layout.shards
        _new_cells(state, "last_cells", cells, step)
        step += 1
    if state is not None:
        discard(state)
    return zlib.compress(cells.tobytes(), 1)


def _tallied(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of word hashes and the sums of their counts, ordered by a hash of
    the row; rows that share one without being equal are ordered by their words."""
    h = _row_hash(words)
    order = np.argsort(h)
    words, counts, h = words[order], counts[order], h[order]
    new = np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)])
    if (new[1:] & (h[1:] == h[:-1])).any():
        order = np.lexsort(words.T[::-1])
        words, counts = words[order], counts[order]
        new = np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)])
    first = np.flatnonzero(new)
    return words[first], np.add.reduceat(counts, first)


def _row_hash(words: np.ndarray) -> np.ndarray:
    """A hash of each row of word hashes."""
    mix = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) for i in range(words.shape[1])],
                   dtype=np.uint64)
    return (words.view(np.uint64) * mix).sum(axis=1, dtype=np.uint64)


def name_candidates(encoded: DataFrame, cells: bytes, layout: Layout) -> DataFrame:
    """(w1 .. w<longest>, a): the word hashes (0 beyond the last word) and the exact
    number of occurrences of each word and phrase that reaches the threshold."""
    shared = encoded.sparkSession.sparkContext.broadcast(cells)
    longest = layout.longest
    names = [f"w{i + 1}" for i in range(longest)]

    def added(known: tuple, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """What the task counted so far, with the phrases of ``held``."""
        words = np.concatenate(held)
        words, counts = _tallied(words, np.ones(len(words), dtype=np.int64))
        return _tallied(np.concatenate([known[0], words]), np.concatenate([known[1], counts]))

    def packed(words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        h = _row_hash(words)
        bucket = (((h >> np.uint64(40)) * np.uint64(layout.buckets)) >> np.uint64(24)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        words, counts, bucket = words[order], counts[order], bucket[order]
        border = np.flatnonzero(np.diff(bucket)) + 1
        rows = [{"bucket": int(bucket[s]), "keys": words[s:e].tobytes(), "counts": counts[s:e].tobytes()}
                for s, e in zip([0, *border.tolist()], [*border.tolist(), len(words)])]
        return pa.RecordBatch.from_pylist(rows, schema=PACKED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)
        held: list[np.ndarray] = []
        size = 0
        none = np.zeros((0, longest), dtype=np.int64), np.zeros(0, dtype=np.int64)
        so_far = none
        for batch in batches:
            for data, lead in zip(batch.column("ids"), batch.column("lead").to_pylist()):
                ids = np.frombuffer(data.as_buffer(), dtype=np.uint64)
                for length, _, first, known in active_phrases(ids, lead, reached, layout):
                    at = np.flatnonzero(known & (first != UNREACHED))
                    if len(at):
                        words = np.zeros((len(at), longest), dtype=np.int64)
                        words[:, :length] = ids.view(np.int64)[at[:, None] + np.arange(length)]
                        held.append(words)
                        size += len(at)
                if size > NAMED_BUFFER:
                    so_far, held, size = added(so_far, held), [], 0
                    if len(so_far[1]) > NAMED_BUFFER:
                        yield packed(*so_far)
                        so_far = none
        if size:
            so_far = added(so_far, held)
            held.clear()
        if len(so_far[1]):
            yield packed(*so_far)
        so_far = none
        release_memory()

    def together(group: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(k, dtype=np.int64) for k in group["keys"].to_pylist()])
        counts = np.concatenate([np.frombuffer(c, dtype=np.int64) for c in group["counts"].to_pylist()])
        words, counts = _tallied(words.reshape(-1, longest), counts)
        kept = counts >= layout.threshold
        return pa.table({**{n: np.ascontiguousarray(words[kept, i]) for i, n in enumerate(names)},
                         "a": counts[kept]})

    found = encoded.where("ids is not null").select("ids", "lead").mapInArrow(
        rows, "bucket int, keys binary, counts binary")
    return found.groupBy("bucket").applyInArrow(
        together, ", ".join(f"{c} bigint" for c in [*names, "a"]))


def spelled(candidates: DataFrame, words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, a) of the candidates, words being an array of texts."""
    names = [f"w{i + 1}" for i in range(longest)]
    each = candidates.select(*names, "a", F.posexplode(F.array(*names)).alias("at", "h"))
    named = each.where("h <> 0").join(words.select("h", "lang", "word"), "h")
    parts = (named.groupBy(*names).agg(
        F.first("a").alias("a"), F.first("lang").alias("lang"),
        F.array_sort(F.collect_list(F.struct("at", "word"))).alias("p")))
    return (parts.select("lang", F.col("p.word").alias("words"), "a")
            .withColumn("phrase", F.concat_ws(" ", "words")))


def _slice(start: str, length: str) -> Column:
    return F.concat_ws(" ", F.expr(f"slice(words, {start}, {length})"))


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): the lowest-scoring cut of each phrase."""
    counts = phrases.select("lang", "phrase", "a").unionByName(
        words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")))
    cuts = phrases.select("lang", "phrase", "a", "words",
                          F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _slice("1", "k").alias("first"),
                       _slice("k + 1", "size(words) - k").alias("rest"))
    for part, count in (("first", "l"), ("rest", "r")):
        known = counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(count))
        cuts = cuts.join(known, ["lang", part])
    cuts = cuts.join(totals, "lang")
    value = F.expr("""cast((cast(1000 * cast(a as decimal(19,0)) as decimal(38,0)) * n)
                      div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)""")
    low = F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("low")
    return (cuts.groupBy("lang", "phrase", "a", "n").agg(low)
            .select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score"))


def maximal(phrases: DataFrame) -> DataFrame:
    """Phrases without a longer one that holds their words and is as frequent."""
    inner = phrases.select("lang", "a", "words", F.explode(F.expr(
        "sequence(2, greatest(2, size(words) - 1))")).alias("length")).where("length < size(words)")
    inner = inner.select("lang", "a", "words", "length", F.explode(F.expr(
        "sequence(1, size(words) - length + 1)")).alias("start"))
    longer = (inner.select("lang", "a", _slice("start", "length").alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer_a")))
    whole = phrases.join(longer, ["lang", "phrase"], "left")
    return whole.where("longer_a is null or 100 * longer_a < 100 * a").drop("longer_a")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                 shards: int = SHARDS, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top``
    phrases of ``docs`` (columns lang and text)."""
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seed = 0
    while True:
        encoded = encode(docs, seed, shards, longest)
        total = encoded.where("lang is not null").agg(F.sum("words")).first()[0] or 0
        bits = min(MAX_CELL_BITS, max(MIN_CELL_BITS, (total // 8).bit_length()))
        layout = Layout(max(parallel, -(-total // BUCKET_WORDS)), bits, shards, threshold, longest)
        cells = count_cycles(encoded, layout)
        named = materialize(name_candidates(encoded, cells, layout), "phrase-named")
        told = materialize(spellings(docs, seed, candidate_words(named, layout), layout),
                           "phrase-spellings")
        frequent = named.where("w2 = 0").select(F.col("w1").alias("h"), F.col("a").alias("n"))
        words = told.join(frequent, "h")
        if words.where("clash").isEmpty():
            break
        for table_of in (encoded, named, told):
            discard(table_of)
        seed += 1
    phrases = materialize(spelled(named.where("w2 <> 0"), words, longest), "phrase-candidates")
    totals = encoded.where("lang is not null").groupBy("lang").agg(F.sum("words").alias("n"))
    ranked = scored(phrases, words, totals).join(
        maximal(phrases).select("lang", "phrase"), ["lang", "phrase"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                    "a", "l", "r", "n", "score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w, row_number() OVER () AS p FROM pieces),
words AS (
  SELECT lang, p, unnest(w) AS w1, unnest(range(len(w))) AS i FROM listed),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER q AS w2, lead(w1, 2) OVER q AS w3, lead(w1, 3) OVER q AS w4,
         lead(w1, 4) OVER q AS w5
  FROM words WINDOW q AS (PARTITION BY p ORDER BY i)),
f AS (
  SELECT lang, w1 AS g, 1 AS k, count(*) AS a FROM runs GROUP BY lang, w1
  UNION ALL
  SELECT lang, w1 || ' ' || w2 AS g, 2, count(*) FROM runs WHERE w2 IS NOT NULL
  GROUP BY ALL HAVING count(*) >= 100
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3 AS g, 3, count(*) FROM runs WHERE w3 IS NOT NULL
  GROUP BY ALL HAVING count(*) >= 100
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 AS g, 4, count(*) FROM runs
  WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 AS g, 5, count(*) FROM runs
  WHERE w5 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(a)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT *, string_split(g, ' ') AS w FROM f WHERE k >= 2),
cut AS (
  SELECT lang, g, a, j, array_to_string(w[1:j], ' ') AS lg, array_to_string(w[j + 1:k], ' ') AS rg
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)),
cuts AS (
  SELECT c.lang, c.g, c.a, t.n, j, l.a AS l, r.a AS r,
         (1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a) AS score
  FROM cut c JOIN f l ON l.lang = c.lang AND l.g = c.lg
       JOIN f r ON r.lang = c.lang AND r.g = c.rg JOIN totals t ON t.lang = c.lang),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM cand))),
longer AS (SELECT lang, g, max(a) AS longer_a FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT low.lang, low.g AS phrase, low.a, l, r, n, score
  FROM low LEFT JOIN longer ON longer.lang = low.lang AND longer.g = low.g
  WHERE longer_a IS NULL OR 100 * longer_a < 100 * low.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM kept)
SELECT * FROM ranked WHERE rank <= 2000
"""
