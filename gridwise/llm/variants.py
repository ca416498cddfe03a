"""Spelling variant grouping by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: with m the longer length, their common prefix and common suffix
together reach m - 1.  Such a pair shares, for a suitable multiple ``a`` of
``GAP``, its first ``a`` and its last ``m - a - GAP`` code points.  Words are
dealt to blocks by (m, a, those two affixes), for m their own length and one
more.  Within a block only the windows of GAP code points next to the shared
affixes can differ: they become padded code-point matrices, and tiles of words
by words are compared densely.  A pair counts in the one block whose ``a`` is
the last multiple of GAP within its common prefix, so no pair counts twice.

Bounds: letters are ``a-z`` and U+00C0 to U+00FF, 90 in all, so a block holds at
most 90**GAP + 90**(GAP-1) words (8,190) whatever the corpus; tiles bound the
memory of a comparison.  A word's partial results (number of near words, best
one) are combined before the shuffle.

Defined results: null and empty texts have no words.  Rows without an id are read
as if their runs had no deletion.  Repeated rows count as often as they occur.
An empty table gives no rows.  Extra columns are ignored.  Very long texts are
taken whole; a run of any length is one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm.common import discard, materialize, table

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
ONE_IN = 31
FORM_FACTOR = 10
GAP = 2
TILE = 256
CELLS = 1 << 20


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal letter run, A-Z lower-cased."""
    lowered = F.translate("text", UPPER, LOWER)
    return docs.select("doc_id", F.explode(
        F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))


def with_slips(found: DataFrame) -> DataFrame:
    """``word``: the run, with one code point deleted where 31 divides the crc32
    of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    cut = F.concat(F.expr("substring(run, 1, cast(_h % length(run) as int))"),
                   F.expr("substring(run, cast(_h % length(run) as int) + 2)"))
    return found.withColumn("_h", h).select(
        F.when(F.col("_h") % ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    return (words.where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _block_keys(gap: int) -> Column:
    """One struct (m, a, k) per block of ``word``; k hashes m, a and the affixes."""
    text = f"""
      flatten(transform(array(length(word), length(word) + 1), m ->
        transform(sequence(0, cast(m - 1 as int), {gap}), a -> named_struct(
          'm', m, 'a', a,
          'k', xxhash64(m, a, substring(word, 1, a),
                        if(m - a - {gap} > 0, substring(word, -(m - a - {gap})), ''))))))"""
    return F.expr(text)


def blocks(words: DataFrame, gap: int = GAP) -> DataFrame:
    """(k, m, a, word, n), the rows of a block next to each other in one partition."""
    dealt = words.select("word", "n", F.explode(_block_keys(gap)).alias("b"))
    return (dealt.select("b.k", "b.m", "b.a", "word", "n")
            .repartition("k").sortWithinPartitions("k", "m", "a"))


def code_windows(words: list[str], start: np.ndarray, gap: int) -> np.ndarray:
    """Padded code-point matrix: the ``gap`` code points from ``start`` on of each
    word, 0 outside of the word."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    first = np.cumsum(length) - length
    out = np.zeros((len(words), gap), dtype=np.uint32)
    for i in range(gap):
        at = start + i
        inside = (at >= 0) & (at < length)
        out[inside, i] = flat[(first + at)[inside]]
    return out


def _agreeing(left: np.ndarray, right: np.ndarray, order: range) -> np.ndarray:
    """Leading equal columns of the two matrices (tiles by words by gap), in ``order``."""
    run = np.ones(np.broadcast_shapes(left.shape[:-1], right.shape[:-1]), dtype=bool)
    count = np.zeros(run.shape, dtype=np.int8)
    for i in order:
        run &= left[..., i] == right[..., i]
        count += run
    return count


class _Rows:
    """The rows of whole blocks, sorted by block, with their windows."""

    def __init__(self, k, m, a, words, n, gap):
        self.words, self.n, self.m, self.a, self.gap = words, n, m, a, gap
        self.length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.suffix = np.maximum(m - a - gap, 0)
        self.head = code_windows(words, a, gap)
        self.tail = code_windows(words, self.length - self.suffix - gap, gap)
        border = np.flatnonzero((k[1:] != k[:-1]) | (m[1:] != m[:-1]) | (a[1:] != a[:-1])) + 1
        self.first = np.concatenate([[0], border])
        self.size = np.diff(np.concatenate([self.first, [len(words)]]))

    def near(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of the near pairs of the tiles x by y (tiles by words; -1 pads)."""
        left, right = x[:, :, None], y[:, None, :]
        m, a = self.m[x][:, :1, None], self.a[x][:, :1, None]
        suffix = self.suffix[x][:, :1, None]
        prefix_run = _agreeing(self.head[x][:, :, None], self.head[y][:, None], range(self.gap))
        suffix_run = _agreeing(self.tail[x][:, :, None], self.tail[y][:, None],
                               range(self.gap - 1, -1, -1))
        longer = np.maximum(self.length[x][:, :, None], self.length[y][:, None]) == m
        here = (prefix_run < self.gap) | (suffix == 0)
        hit = (longer & here & (a + prefix_run + suffix + suffix_run >= m - 1)
               & (left >= 0) & (right >= 0) & (left < right))
        t, i, j = np.nonzero(hit)
        return x[t, i], y[t, j]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs of all blocks: small blocks stacked by size, large ones in tiles."""
        side = 2
        while side < TILE:
            side = min(TILE, side * 2)
            low = side // 2 if side > 4 else 1
            some = np.flatnonzero((self.size > low) & (self.size <= side))
            step = max(1, CELLS // (side * side))
            for s in range(0, len(some), step):
                group = some[s:s + step]
                at = self.first[group][:, None] + np.arange(side)[None, :]
                at = np.where(np.arange(side)[None, :] < self.size[group][:, None], at, -1)
                yield self.near(at, at)
        for block in np.flatnonzero(self.size > TILE):
            first, size = self.first[block], self.size[block]
            parts = [np.arange(first + s, first + min(size, s + TILE)) for s in range(0, size, TILE)]
            for p, one in enumerate(parts):
                for other in parts[p:]:
                    yield self.near(one[None], other[None])


def _verified(rows: _Rows, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drop pairs of different affixes: blocks are known by a hash."""
    keep = [rows.words[x][:a] == rows.words[y][:a]
            and (not s or rows.words[x][-s:] == rows.words[y][-s:])
            for x, y, a, s in zip(i.tolist(), j.tolist(), rows.a[i].tolist(), rows.suffix[i].tolist())]
    keep = np.array(keep, dtype=bool)
    return i[keep], j[keep]


def _partial(rows: _Rows) -> pa.RecordBatch:
    """Per word of ``rows`` with a near word: their number and the best one."""
    found = [_verified(rows, i, j) for i, j in rows.pairs() if len(i)]
    if found:
        i = np.concatenate([f[0] for f in found] + [f[1] for f in found])
        j = np.concatenate([f[1] for f in found] + [f[0] for f in found])
    else:
        i = j = np.zeros(0, dtype=np.int64)
    near: dict[str, list] = {}
    n = rows.n
    for x, y in zip(i.tolist(), j.tolist()):
        word, other, weight = rows.words[x], rows.words[y], -int(n[y])
        known = near.get(word)
        if known is None:
            near[word] = [1, weight, other]
        else:
            known[0] += 1
            if (weight, other) < (known[1], known[2]):
                known[1], known[2] = weight, other
    return pa.RecordBatch.from_arrays(
        [pa.array(list(near), pa.string()),
         pa.array([v[0] for v in near.values()], pa.int64()),
         pa.array([v[1] for v in near.values()], pa.int64()),
         pa.array([v[2] for v in near.values()], pa.string())],
        names=["word", "links", "minus_n", "other"])


def near_words(words: DataFrame, gap: int = GAP) -> DataFrame:
    """(word, n_near, best_n, best): near words of each word that has one; best is
    the near word of largest n, the smallest in code-point order among equals."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def rows_of(part: pa.Table) -> _Rows:
            cols = [part[c].to_numpy().astype(np.int64) for c in ("k", "m", "a")]
            return _Rows(*cols, part["word"].to_pylist(), part["n"].to_numpy().astype(np.int64), gap)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            together = pa.Table.from_batches(held)
            k = together["k"].to_numpy()
            # the last block may go on in the next batch
            whole = int(np.searchsorted(k, k[-1]))
            if whole:
                yield _partial(rows_of(together.slice(0, whole)))
                held = together.slice(whole).combine_chunks().to_batches()
        if held:
            yield _partial(rows_of(pa.Table.from_batches(held)))

    partial = blocks(words, gap).mapInArrow(
        compare, "word string, links bigint, minus_n bigint, other string")
    best = F.min(F.struct("minus_n", "other"))
    return (partial.groupBy("word").agg(F.sum("links").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.minus_n")).alias("best_n"),
                    F.col("b.other").alias("best")))


def roots(forms: DataFrame, name: str = "variant-roots") -> DataFrame:
    """(word, root) of rows (word, form): forms followed to the last one.

    Each round doubles the distance followed.  A form has at least ten times its
    word's count, so a chain of 64-bit counts has at most 19 steps: six rounds.
    """
    known = materialize(forms.select("word", F.col("form").alias("root")), name)
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialize(
            known.join(ahead, "root", "left")
            .select("word", F.coalesce("next", "root").alias("root"),
                    F.col("next").isNotNull().alias("moved")), name)
        discard(known)
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        known = longer


def variants(words: DataFrame, gap: int = GAP, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of rows (word, n) of distinct words."""
    words = materialize(words, "variant-words")
    near = near_words(words, gap)
    is_form = F.col("best_n") >= factor * F.col("n")
    told = materialize(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n")), "variant-forms")
    last = roots(told.where("form is not null"))
    return (told.join(last, "word", "left")
            .withColumn("root", F.coalesce("root", "word")))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_slips(runs(table(spark, sf_dir, "documents")))
    return variants(word_counts(found)).select(
        "word", "form", "root", "n", "n_near", "form_n")


#: crc32 bit by bit: a byte is mixed in, then eight shifts (marked -1) follow; near
#: words agree after one deletion each at the same place, or after one of the longer
OP11_SQL = """
WITH RECURSIVE runs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run
  FROM documents WHERE text IS NOT NULL),
tallied AS (SELECT id, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, k, CASE WHEN id IS NOT NULL THEN
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
             ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END)),
      lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
                     ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) END AS h
  FROM tallied),
slipped AS (
  SELECT CASE WHEN h % 31 = 0
              THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, k FROM hashed),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 7
  GROUP BY word HAVING sum(k) >= 2),
less AS (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS k
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n
  FROM less x JOIN less y ON x.k = y.k AND x.i = y.i AND x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM less x JOIN words y ON x.k = y.word
  UNION
  SELECT y.word, x.word, x.n FROM less x JOIN words y ON x.k = y.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n,
         (list(other ORDER BY other_n DESC, other))[1] AS best FROM near GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN b.best_n >= 10 * w.n THEN b.best END AS form,
         CASE WHEN b.best_n >= 10 * w.n THEN b.best_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
steps AS (
  SELECT word, word AS at, form FROM told
  UNION ALL
  SELECT s.word, t.word, t.form FROM steps s JOIN told t ON t.word = s.form)
SELECT t.word, t.form, s.at AS root, t.n, t.n_near, t.form_n::BIGINT AS form_n
FROM told t JOIN steps s ON s.word = t.word AND s.form IS NULL
"""
