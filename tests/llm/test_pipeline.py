import corpus_pipeline
import pytest
from brute import base_spans, jaccard_join
from pyspark.sql import functions as F

from gridwise.llm import langid, mixing, pii

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        if name != "tokens":
            assert docs.columns == columns
        kept.append(docs.toPandas())
    first, unique, clean, mixed, tokens = kept
    source = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    model = langid.fit(langid.training_rows(spark.read.parquet(f"{SF}/documents.parquet")))
    accepted = langid.identify(spark.read.parquet(f"{SF}/documents.parquet"), model).where(
        "not rejected").toPandas()
    assert set(first["doc_id"]) == set(accepted["doc_id"]) and len(first) > 0.97 * len(source)
    want = {i for i, (_, c) in jaccard_join(zip(first["doc_id"], first["text"])).items() if i == c}
    assert set(unique["doc_id"]) == want and len(unique) == len(want)
    texts = dict(zip(source["doc_id"], source["text"]))
    changed = clean[clean["text"] != clean["doc_id"].map(texts)]
    assert len(changed) and (clean["n_chars"] == clean["text"].str.len()).all()
    assert changed["text"].str.contains(r"\[(?:EMAIL|IP|CARD|PHONE|IBAN|SSN)\]").all()
    again = pii.find(spark.createDataFrame(clean[["doc_id", "text"]])).where("size(found) > 0")
    assert again.count() == 0
    times = mixed["doc_id"].value_counts()
    plan = mixing.mix(spark.createDataFrame(clean)).where("taken > 0").toPandas()
    assert {r.doc_id: r.taken // r.size for r in plan.itertuples()} == times.to_dict()
    assert sorted(tokens["doc_id"]) == sorted(mixed["doc_id"])
    assert (tokens["ids"].str.len() == tokens["n_tokens"]).all()


def test_null_rows_and_empty_table(spark):
    rows = [(1, "the cat and the dog went out " * 5, "en", "a", 5), (None, "the cat of " * 9, "en", "a", 1),
            (2, None, "en", None, None), (3, "the cat and the dog went out " * 5, None, "b", 5),
            (3, "the cat and the dog went out " * 5, None, "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "'mine' as score", "'own' as found")
    for table in (docs, docs.where("false")):
        out = table
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.materialize(stage(spark, out, SF), f"test-{name}")
        ids = {r.doc_id for r in out.collect()}
        assert ids == ({1, None} if table is docs else set())


CLEAN = ["the cat sat on the mat and looked at every bird that came along the wall today",
         "we went out to the market in the morning and bought bread and cheese for lunch",
         "nobody knows when the next train leaves from this station but all of them wait",
         "the old house at the end of the road has been empty since the spring of that year"]


def _odd_ids(spark):
    """Null ids, ids that stand for several texts, repeated rows, near copies."""
    near = CLEAN[0].split()
    long = [" ".join(near[i:] + near[:i]) for i in range(4)]
    copy = " ".join(long * 4)
    rows = [(None, CLEAN[0]), (None, CLEAN[1]), (5, CLEAN[2]), (5, CLEAN[3]), (7, copy), (8, copy + " end"),
            (None, copy), (9, CLEAN[2]), (9, None), (None, ""), (9, None)]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "own") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _row string")


def test_near_duplicates_keep_rows_without_an_id_of_their_own(spark):
    docs = _odd_ids(spark)
    kept = [corpus_pipeline.near_duplicates(spark, d, SF) for d in (docs, docs.repartition(5), docs.coalesce(1))]
    texts = [sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in k.collect()) for k in kept]
    assert texts[0] == texts[1] == texts[2]
    assert kept[0].columns == docs.columns
    stay = {t for _, _, t in texts[0]}
    assert set(CLEAN) <= stay                      # every clean text is still there
    assert sum("mat and looked" in t and len(t) > 200 for t in stay) == 1   # one of the copies
    assert (False, 7, next(t for t in stay if len(t) > 200)) in texts[0]
    assert [x for x in texts[0] if x[2] == CLEAN[2]] == [(False, 5, CLEAN[2])]


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.toPandas()
    want = {i for i, (_, c) in jaccard_join(zip(rows["doc_id"], rows["text"])).items() if i == c}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()} == want


def test_source_mix_tells_rows_apart(spark):
    docs = _odd_ids(spark)
    docs = docs.drop("_row").unionByName(docs.drop("_row").withColumn("source", F.lit("other")))
    out = corpus_pipeline.source_mix(spark, docs, SF)
    sized = {(r.doc_id, r.source, r.text): 0 for r in docs.collect()}
    for r in out.collect():
        sized[r.doc_id, r.source, r.text] += 1
    plan = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()
    for r in plan:
        assert r.t == sum(n * len(t.split()) for (i, s, t), n in sized.items() if t and s == r.source)
    assert all(n > 0 for (i, s, t), n in sized.items() if t and s == "s")  # more than one epoch


def test_private_data_equals_brute_force(spark):
    """Base spans leave the text: no base span of the stage's result is found by the
    plain version, and texts without any span stay as they are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    spans = {r.doc_id: r.n for r in pii.find(docs.select("doc_id", "text")).select(
        "doc_id", F.size("found").alias("n")).collect()}
    for r in corpus_pipeline.private_data(spark, docs, SF).collect():
        assert not base_spans(r.text)
        assert (r.text == before[r.doc_id]) == (spans[r.doc_id] == 0)
        if base_spans(before[r.doc_id]):
            assert spans[r.doc_id] > 0


def test_tokens_equal_the_library(spark):
    import hashlib

    import public_tokenizers
    import tokenizers
    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    library.no_truncation()
    library.no_padding()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in corpus_pipeline.tokens(spark, docs, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and list(r.ids) == ids
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_names(name):
    assert name.isidentifier()
