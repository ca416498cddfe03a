"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input.

Defined results: a row is a document of its own, whether it has a doc_id or shares
it with other rows.  Documents without a letter have no language and leave at the
first stage.  Of near duplicates the row with the smallest doc_id stays (null last),
of equal ids that whose text has the smallest hash.  Of rows equal in doc_id, source
and text the mix writes one, as often as it takes all of them.  An empty table passes
through all stages.  Columns beyond those of ``documents`` pass through the first four
stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.llm import bpe, jaccard, langid, mixing, pii
from gridwise.llm.common import materialize, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents whose language the classifier rejects go."""
    model = langid.fit(langid.training_rows(docs))
    whole = docs.select("text", F.struct("*").alias("row"))
    return langid.identify(whole, model).where("not rejected").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near duplicates one document stays.

    Rows get a number, written with them, as ids may be null or stand for several texts."""
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("_row"),
                                   F.struct("*").alias("_doc")), "numbered")
    joined = jaccard.join(rows.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text")))
    order = F.struct(F.col("_doc.doc_id").isNull().alias("n"), F.col("_doc.doc_id").alias("i"),
                     F.xxhash64("_doc.text").alias("h"), F.col("_row").alias("_row"))
    first = (joined.select(F.col("doc_id").alias("_row"), "component_id")
             .join(rows.select("_row", order.alias("o")), "_row")
             .groupBy("component_id").agg(F.min("o")["_row"].alias("_row")))
    return rows.join(first.select("_row"), "_row", "left_semi").select("_doc.*")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: each span of personal data is replaced by its kind."""
    found = pii.find(docs.select("text", F.struct("*").alias("row")))
    clean = found.select("row", pii.masked(F.col("text"), F.col("found")).alias("clean"),
                         (F.size("found") > 0).alias("changed"))
    row = F.col("row").withField("text", F.col("clean"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("changed"), F.length("clean").cast("long"))
                            .otherwise(F.col("row.n_chars")))
    return clean.select(row.alias("row")).select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each document as often as the mix takes it.

    A document is known by its id, source and text."""
    name = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                       F.sha2(F.to_json(F.struct("source", "text")), 256))
    rows = docs.select(name.alias("_name"), F.struct(*docs.columns).alias("_row"))
    mixed = mixing.mix(docs.select("doc_id", "source", "text", name.alias("_name")), carry=["_name"])
    times = (mixed.where("taken > 0").groupBy("_name")
             .agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("_times")))
    one = rows.groupBy("_name").agg(F.first("_row").alias("_row"))
    return (one.join(times, "_name")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
            .select("_row.*"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the ids of each document, their number and digests."""
    return bpe.tokenized(docs.select("doc_id", "lang", "source", "text"), bpe.default_vocabulary())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: compression, shingle components and BPE have no SQL form over these tables;
#: the tests hold every stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
