import numpy as np
import pytest

from gridwise.llm import bpe, token_scan, warc
from gridwise.session import work_dir

EOD = 9


def scanned(spark, arrays, block):
    folder = work_dir(spark, "test-tokens")
    store, base = warc.open_folder(folder)
    store.create_dir(base, recursive=True)
    for name, ids in arrays.items():
        with store.open_output_stream(f"{base}/{name}", compression=None) as out:
            out.write(np.array(ids, "<u2").tobytes())
    files = spark.createDataFrame([(k, len(v)) for k, v in arrays.items()], "file string, file_ids long")
    got = {}
    for r in sorted(token_scan.scan(files, folder, EOD, block).collect(),
                    key=lambda r: (r.file, r.ordinal)):
        got.setdefault(r.file, []).append((r.ordinal, r.n_tokens, r.closed))
    return got


def brute(ids):
    out, n = [], 0
    for x in ids:
        if x == EOD:
            out.append((len(out), n, True))
            n = 0
        else:
            n += 1
    return out + ([(len(out), n, False)] if n else [])


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_stitching_equals_one_pass(spark, block):
    rng = np.random.default_rng(block)
    arrays = {f"f{i}": np.where(rng.random(60) < p, EOD, 1).tolist()
              for i, p in enumerate((0.0, 0.02, 0.3, 0.9))}
    arrays |= {"all": [EOD] * 10, "one": [EOD], "open": [1] * 13, "edge": [1, 1, EOD, EOD, 1, EOD],
               "empty": []}
    want = {k: brute(v) for k, v in arrays.items() if v}
    assert scanned(spark, arrays, block) == want


def test_counts_of_documents(spark):
    path = bpe.default_vocabulary()
    rows = [(1, "some words <|endoftext|> more"), (2, None), (3, ""), (None, "x"), (1, "again"),
            (4, "long " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = work_dir(spark, "test-token-files")
    manifest = token_scan.write(docs, folder, path, file_bytes=1000)
    counted = token_scan.scan(manifest.select("file", "file_ids").distinct(), folder,
                              token_scan.separator(path), block_ids=64)
    got = sorted((str(r.doc_id), r.n_tokens) for r in
                 counted.join(manifest, ["file", "ordinal"]).collect())
    want = sorted((str(r.doc_id), r.n_tokens) for r in bpe.digests(docs, path).collect())
    assert got == want
    assert token_scan.write(docs.where("false"), folder, path).count() == 0
