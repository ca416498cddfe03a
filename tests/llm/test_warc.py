import hashlib
import io

import pytest
import zstandard

from gridwise.llm import warc
from gridwise.session import work_dir


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "x" * 3_000_000 + "</p>"
    rows = [(1, "http://a/%20\r\nx", "é" * 80), (2, "http://b", "é" * 80), (0, None, "é" * 80),
            (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (7, "u", big),
            (8, "u", big), (0, None, "é" * 80), (None, "n", "é" * 80), (None, "m", "y" * 200)]
    rows += [(100 + i, "h", "copy " * 50) for i in range(300)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'clash' as digest", "1 as salt").repartition(4)


@pytest.fixture(scope="module")
def written(spark, pages):
    folder = work_dir(spark, "test-warc")
    return folder, warc.write(pages, folder)


def test_round_trip(pages, written):
    folder, index = written
    rows = pages.collect()
    got = warc.read(index, folder).collect()
    assert len(got) == len(rows)
    first = {}
    for r in rows:
        data = (r.html or "").encode()
        if len(data) >= 100 and r.page_id is not None:
            first[data] = min(first.get(data, r.page_id), r.page_id)
    want = []
    for r in rows:
        data = (r.html or "").encode()
        low = first.get(data)
        refers = low if low is not None and (r.page_id is None or low < r.page_id) else None
        want.append((r.page_id, r.url, len(data), hashlib.sha256(data).hexdigest(),
                     "response" if refers is None else "revisit", refers))
    found = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
             for r in got]
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_lookup_reads_single_frames(spark, pages, written):
    folder, index = written
    wanted = index.where("page_id in (1, 5, 7, 250)")
    html = {r.page_id: r.html for r in pages.collect()}
    got = warc.lookup(index, folder, wanted.select("record_id")).collect()
    assert sorted(r.page_id for r in got) == [1, 5, 7, 250]
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (html[r.page_id] or "")
        else:
            assert bytes(r.payload) == b""


def test_bundles_are_plain_zstandard_with_a_seek_table(written):
    folder, index = written
    store, base = warc.open_folder(folder)
    for bundle in {r.bundle for r in index.select("bundle").distinct().collect()}:
        with store.open_input_file(f"{base}/{bundle}") as source:
            frames = warc.read_seek_table(source)
            source.seek(0)
            raw = source.read()
        # any Zstandard reader unpacks the frames and skips the table
        whole = zstandard.ZstdDecompressor().stream_reader(
            io.BytesIO(raw), read_across_frames=True).read()
        assert len(whole) == sum(f[2] for f in frames) and whole.startswith(b"WARC/1.1\r\n")
        entries = index.where(index.bundle == bundle).collect()
        assert {(e.frame, e.frame_at, e.frame_bytes) for e in entries} == {
            (i, a, n) for i, (a, n, _) in enumerate(frames)}


def test_damaged_seek_table_is_refused():
    with pytest.raises(ValueError):
        warc.read_seek_table(io.BytesIO(b"x" * 100))


def test_empty_table(spark, pages):
    folder = work_dir(spark, "test-warc-empty")
    index = warc.write(pages.where("false"), folder)
    assert index.count() == 0 and warc.read(index, folder).count() == 0
