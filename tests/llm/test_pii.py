import random

from brute import base_spans
from pyspark.sql import functions as F

from gridwise.llm import pii

PIECES = ["a@b.co", "_x@y.com", "@", "a.b", "..", "%", "+1 (988) 555-2485", "+", "12",
          "4041894974608795", "4041 8949 7460 8795", "-", " ", "255.1.2.3", "256.1.1.1",
          "1.2.3.4.5.6.7.8", "007.0.0.255", ".", "é", "😀", "\n", "card ", "x",
          "+49-30-12345678", "()", "0", "9"]


def text_of(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def test_base_spans_equal_brute_force(spark):
    draw = random.Random(11)
    rows = [(i, "".join(draw.choice(PIECES) for _ in range(draw.randrange(30)))) for i in range(600)]
    rows += [(9001, None), (9002, ""), (9003, "a" * 100000), (9004, "1.2.3.4 " * 3000),
             (9005, "a@b" + ".c" * 50000), (9006, "1 " * 50000), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = pii.find(docs).select("doc_id", "text", pii.listed(F.col("base")).alias("b"),
                                pii.listed(F.col("found")).alias("f")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.b == text_of(base_spans(r.text)), r.text[:100]
        assert set(filter(None, r.b.split(","))) <= set(r.f.split(","))


def test_added_kinds_need_checksum_or_context(spark):
    texts = ["IBAN DE89370400440532013000.", "DE89 3704 0044 0532 0130 00", "DE88370400440532013000",
             "ssn 123-45-6789", "123-45-6789", "ssn 000-12-3456"]
    docs = spark.createDataFrame([(t, "kept") for t in texts], "text string, found string")
    rows = {r.text: r for r in pii.find(docs).collect()}
    kinds = {t: [s.kind for s in rows[t].found if s.kind in ("iban", "ssn")] for t in texts}
    assert list(kinds.values()) == [["iban"], ["iban"], [], ["ssn"], [], []]
    assert rows[texts[0]].found[0].score > rows[texts[1]].found[0].score


def test_masking(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 (988) 555-2485!"), (2, None), (3, "plain"),
                                  (4, "a@1.2.3.4 end")], "doc_id long, text string")
    rows = {r.doc_id: r.m for r in pii.find(docs).select(
        "doc_id", pii.masked(F.col("text"), F.col("found")).alias("m")).collect()}
    assert rows == {1: "mail [EMAIL] or [PHONE]!", 2: None, 3: "plain", 4: "[EMAIL] end"}


def test_empty_table_and_plan(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found = pii.find(docs)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
