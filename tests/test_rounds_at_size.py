"""How often the rounds' rows move and are evaluated."""

import datetime

import pytest
from pyspark.sql import functions as F

from gridwise.operators.flatten import flatten_json_long
from gridwise.operators.row_index import with_starts
from gridwise.plans import inputs as I
from gridwise.plans.loaders import inspection_rounds
from gridwise.sinks.stored import stored


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.date(2024, 3, 5)
    frames = {
        "customer": ([(k, f"c{k}", "S") for k in range(5)], "c_custkey long, c_name string, c_mktsegment string"),
        "orders": ([(10 + k, k % 4 if k < 7 else None, "1-URGENT", day, "F") for k in range(8)] * 2,
                   "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate date, o_orderstatus string"),
        "lineitem": ([(10 + k % 6 if k < 20 else None, k // 6 + 1, k, k % 7, 2.0 * k, 1.0, 0.0, 0.0, "N", "O", day)
                      for k in range(22)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate date")}
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return I.Tables(spark, str(tmp_path))


def test_round_documents_hold_every_line(tables):
    docs = I.round_docs(tables).collect()
    assert sorted(d.id for d in docs) == [0, 1, 2, 3, 4]
    lines = {}
    for k in range(20):
        lines.setdefault(10 + k % 6, []).append((k // 6 + 1, k % 25, k % 7, (k // 6 + 1) % 3, 2.0 * k))
    for d in docs:
        want = [o for o in range(10, 17) for _ in range(2) if (o - 10) % 4 == d.id]
        assert [i.id for i in d.inspections] == want
        assert (d._doc_chunk == -1) == (not want)
        for i in d.inspections:
            assert i.createdAt == "2024-03-05" and i.closingUserDisplayName == "1-URGENT"
            got = [(r.id, r.score, r.creatingUserId, min(len(r.photos), 2), r.quantity) for r in i.results]
            assert got == lines.get(i.id, [])


def test_lines_are_shuffled_twice(spark, tables):
    """By order and by customer; orders and customers once each."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = I.round_docs(tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange ") == 4
    assert all("photos" not in line for line in plan.splitlines() if "Exchange " in line)


def test_documents_without_index_are_evaluated_once(spark):
    size, reads = 20, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    doc = F.struct(F.lit("x").alias("closingUserDisplayName"), F.struct(F.struct(
        F.struct(F.lit("Point").alias("type")).alias("geometry")).alias("geoJsonFeature")).alias("location"),
        F.array(F.struct(F.lit("u").alias("creatingUserDisplayName"),
                         F.array("id").alias("photos"))).alias("results"))
    plain = spark.range(size).select("id", F.array(doc).alias("inspections"))
    rows = inspection_rounds(plain.mapInPandas(counted, plain.schema), doc_order=["id"], with_index=False)
    assert sorted(r["photos.0"] for r in rows.collect()) == list(range(size))
    assert reads.value == size


def test_numbered_rows_are_read_by_column(spark):
    df = spark.range(50).select((F.col("id") % 7).alias("k"), F.array("id").alias("wide"))
    numbered = with_starts(df, ["k"], None)
    assert "Scan parquet" in numbered._jdf.queryExecution().sparkPlan().toString()
    assert sorted(r._start for r in numbered.collect()) == list(range(50))


def test_stored_keeps_what_parquet_cannot(spark):
    plain = spark.range(3).select("id", F.struct(F.lit(1).alias("a")).alias("s"))
    names = spark.range(3).select("id", F.struct(F.lit(1).alias("a"), F.lit(2).alias("A")).alias("s"))
    none = spark.range(3).select("id", F.lit(None).alias("n"))
    for df in (plain, names, none):
        got = stored(df, "test")
        assert got.dtypes == df.dtypes
        assert sorted(got.collect()) == sorted(df.collect())


def test_open_documents_are_evaluated_once(spark):
    """The measure of the depth and both kinds of texts read what is stored."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    plain = spark.createDataFrame([(1, '{"a":[{"b":1}]}'), (2, '{"a":{"b":1},"a.b":2}'), (3, None)],
                                  "id long, t string")
    rows = flatten_json_long(plain.mapInPandas(counted, plain.schema), ["id"], "t").collect()
    assert sorted((r.id, r.path, r.value) for r in rows) == [(1, "a.0.b", "1"), (2, "a.b", "2")]
    assert reads.value == 3
