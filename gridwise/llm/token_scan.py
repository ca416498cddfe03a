"""Token counts from flat token files by a separator scan.

A token file is nothing but ids of one fixed width, an end-of-document id after
each document; there is no index.  ``scan`` cuts the files into blocks, finds
the separators of a block in one array comparison, and stitches documents that
cross block borders: a block returns the lengths between its separators and the
tokens after its last one, and a prefix scan over the blocks of a file (sums of
window frames) carries open tokens and document numbers on.

Files lie in a folder given as a URI that the executors reach; the writer names
them by task attempt, and its manifest, a Parquet table, names only files of
attempts that succeeded.

Defined results: a null or empty text is a document of 0 tokens.  Tokens after
a file's last separator are one more document (``closed`` is false).  An empty
file holds no document.  The separator is an id that the vocabulary does not
use, so no text can hold it.  Repeated rows are documents of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwise.llm.bpe import Encoder, default_vocabulary, learn_batch, stream_ids, vocabulary
from gridwise.llm.common import materialize, table
from gridwise.llm.warc import open_folder
from gridwise.session import work_dir

BLOCK_IDS = 1 << 21
FILE_BYTES = 1 << 28


def separator(vocab_path: str) -> int:
    """The first id that the vocabulary leaves free."""
    return len(vocabulary(vocab_path).tokens)


def id_type(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def write(docs: DataFrame, folder: str, vocab_path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode docs (doc_id, text) into token files below ``folder``; returns the
    manifest (file, ordinal, doc_id, file_ids)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        eod = len(vocab.tokens)
        kind = id_type(eod)
        end = np.array([eod], kind).tobytes()
        store, base = open_folder(folder)
        encoder = Encoder(vocab)
        out = name = None
        held: list[int | None] = []
        size = 0

        def closed() -> pa.RecordBatch:
            out.close()
            n = size // np.dtype(kind).itemsize
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(held)), pa.array(range(len(held)), pa.int64()),
                 pa.array(held, pa.int64()), pa.array([n] * len(held), pa.int64())],
                ["file", "ordinal", "doc_id", "file_ids"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, learn_batch(encoder, batch.column("text").to_pylist())):
                if out is None:
                    task = TaskContext.get()
                    name = (f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}-"
                            f"{uuid.uuid4().hex[:8]}.bin")
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    held, size = [], 0
                for packed in stream_ids(encoder, text):
                    data = np.frombuffer(packed, "<u4").astype(kind).tobytes()
                    out.write(data)
                    size += len(data)
                out.write(end)
                size += len(end)
                held.append(doc_id)
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    store, base = open_folder(folder)
    store.create_dir(base, recursive=True)
    return materialize(docs.select("doc_id", "text").mapInArrow(
        encode, "file string, ordinal long, doc_id long, file_ids long"), "token-manifest")


def scan(files: DataFrame, folder: str, eod: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """files (file, file_ids) -> one row per document: file, ordinal, n_tokens,
    closed."""
    kind = id_type(eod)
    width = np.dtype(kind).itemsize
    lists = pa.list_(pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    source.seek(row["block"] * block_ids * width)
                    ids = np.frombuffer(source.read(block_ids * width), kind)
                at = np.flatnonzero(ids == eod)
                lengths = np.diff(at, prepend=-1) - 1
                tail = len(ids) - (int(at[-1]) + 1 if len(at) else 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]]), pa.array([row["block"]], pa.int64()),
                     pa.array([lengths.tolist()], lists), pa.array([tail], pa.int64())],
                    ["file", "block", "lengths", "tail"])

    last = F.greatest(F.ceil(F.col("file_ids") / block_ids) - 1, F.lit(0)).cast("long")
    blocks = files.where("file_ids > 0").select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    found = (blocks.repartition("file", "block")
             .mapInArrow(read, "file string, block long, lengths array<bigint>, tail long"))
    by_file = Window.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    n = F.size("lengths").cast("long")
    # blocks since the last one that held a separator share a run
    numbered = found.select(
        "*", F.coalesce(F.sum(n).over(before), F.lit(0)).alias("first"),
        F.coalesce(F.sum((n > 0).cast("long")).over(before), F.lit(0)).alias("run"),
        F.lead("block").over(by_file).isNull().alias("is_last"))
    in_run = Window.partitionBy("file", "run").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    # a run begins after a block with separators: that block's tail is carried in
    opening = F.lag("tail").over(by_file)
    opened = numbered.withColumn("opening", F.coalesce(opening, F.lit(0)))
    carried = opened.withColumn(
        "carry", F.first("opening").over(Window.partitionBy("file", "run").orderBy("block"))
        + F.coalesce(F.sum("tail").over(in_run), F.lit(0)))
    ended = carried.select("file", "first", "carry", F.posexplode("lengths").alias("k", "length"))
    ended = ended.select("file", (F.col("first") + F.col("k")).alias("ordinal"),
                         (F.col("length") + F.when(F.col("k") == 0, F.col("carry")).otherwise(0))
                         .alias("n_tokens"), F.lit(True).alias("closed"))
    left = F.col("tail") + F.when(n == 0, F.col("carry")).otherwise(0)
    rest = carried.where(F.col("is_last") & (left > 0)).select(
        "file", (F.col("first") + n).alias("ordinal"), left.alias("n_tokens"),
        F.lit(False).alias("closed"))
    return ended.unionByName(rest)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and n_tokens of every document, counted in flat token files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocab_path, folder = default_vocabulary(), work_dir(spark, "llm-tokens")
    manifest = write(docs, folder, vocab_path)
    counted = scan(manifest.select("file", "file_ids").distinct(), folder, separator(vocab_path))
    # the manifest has a row per document: never broadcast, however small its file
    return counted.join(manifest.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
