"""Tables with versions: readers see one whole version while the table is replaced."""

import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from gridwise.operators.row_index import with_starts
from gridwise.plans.loaders import inspection_rounds
from gridwise.sinks import tables as T
from gridwise.sinks import versions as V


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_readers_see_whole_versions(spark, path):
    """A version holds its number in every row and as many rows as its number says."""
    def version(n):
        return spark.range(100 + n).select(F.lit(n).alias("n"), "id").repartition(3)

    V.replace_version(version(0), path)
    seen, failed, done = set(), [], threading.Event()

    def read():
        try:
            while not done.is_set():
                r = V.scan_version(spark, path).agg(
                    F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("rows")).first()
                assert r.lo == r.hi and r.rows == 100 + r.lo
                seen.add(r.lo)
        except Exception as exc:  # noqa: BLE001  (told by the test below)
            failed.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 9):
        V.replace_version(version(n), path)
    done.set()
    reader.join()
    assert not failed and len(seen) > 1
    assert T.scan_table(spark, path).select("n").distinct().first().n == 8


def test_a_reader_keeps_its_version(spark, path):
    V.replace_version(spark.range(3), path)
    first = V.scan_version(spark, path)
    V.replace_version(first.union(spark.range(3, 9)), path)  # a table may be its own input
    assert first.count() == 3 and V.scan_version(spark, path).count() == 9


def test_failed_run_leaves_the_table(spark, path):
    V.replace_version(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        V.replace_version(broken, path)
    assert V.scan_version(spark, path).count() == 5
    V.replace_version(spark.range(6), path)
    assert V.remove_old(spark, path, keep=1) >= 1
    assert V.scan_version(spark, path).count() == 6 and len(V.commits(spark, path)) == 1


def test_commits_at_once(spark, path):
    """Runs that commit with one number: one of them is in force, whole."""
    V.replace_version(spark.range(1), path)
    threads = [threading.Thread(target=V.replace_version, args=(spark.range(n), path)) for n in (2, 3, 4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(V.commits(spark, path)) == 4
    assert V.scan_version(spark, path).count() in (2, 3, 4)


def test_no_table(spark, path):
    with pytest.raises(FileNotFoundError):
        V.scan_version(spark, path)


def test_create_as_select_moves_the_location(spark):
    name = "gw_versions_ctas"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder = tempfile.mkdtemp()
    T.create_table_as_select(spark, spark.range(5), name, f"{folder}/a")
    before = spark.table(name)
    assert T.create_table_as_select(spark, spark.range(9), name, f"{folder}/b").count() == 9
    assert before.count() == 5
    other = T.create_table_as_select(spark, spark.range(2).select(F.lit("x").alias("s")), name, f"{folder}/c")
    assert other.columns == ["s"] and other.count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_rounds_are_evaluated_once(spark):
    """K2: the documents behind the loader's index are read once."""
    reads = spark.sparkContext.accumulator(0)
    size = 40

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    doc = F.struct(F.lit("x").alias("closingUserDisplayName"), F.struct(F.struct(
        F.struct(F.lit("Point").alias("type")).alias("geometry")).alias("geoJsonFeature")).alias("location"),
        F.transform(F.sequence(F.lit(0), F.col("id") % 3), lambda i: F.struct(
            F.lit("u").alias("creatingUserDisplayName"), i.alias("score"),
            F.array(i).alias("photos"))).alias("results"))
    plain = spark.range(size).select("id", F.array(doc, doc).alias("inspections"))
    docs = plain.mapInPandas(counted, plain.schema)
    rows = inspection_rounds(docs, doc_order=["id"]).select("idx", "id", "score").orderBy("idx").collect()
    assert reads.value == size
    assert [r.idx for r in rows] == list(range(len(rows)))
    want = [(i, s) for i in range(size) for _ in range(2) for s in range(i % 3 + 1)]
    assert [(r.id, r.score) for r in rows] == want


def test_starts_are_sums_of_weights(spark):
    df = spark.createDataFrame([(k % 4, k % 3 if k % 7 else None, k) for k in range(500)],
                               "k int, w int, n int")
    rows = with_starts(df, ["k"], F.col("w"), partitions=5).collect()
    # a row without weight starts where the next one does
    rows.sort(key=lambda r: (r._start, r.w or 0, r.k))
    heavy = [r.k for r in rows if r.w]
    assert heavy == sorted(heavy)
    total = 0
    for r in rows:
        assert r._start == total
        total += r.w or 0
    assert with_starts(df.where("false"), ["k"], F.lit(1)).count() == 0
