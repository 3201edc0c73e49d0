"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the columns of
documents; the last returns packed pieces. Between stages rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid.llm import mixing, packing, pseudonyms, setsketch, toxicity
from fathomgrid.llm.common import id_remainder, store, table, training_labels
from fathomgrid.llm.queries import tokenizer_path


def nested(docs: DataFrame) -> DataFrame:
    """Each row as one value `row`, so that no column of a table can clash with a stage's own."""
    return docs.select(F.struct("*").alias("row"))


def text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the rejection threshold."""
    labels = training_labels(table(spark, sf_dir, "labels"), "toxic", id_remainder("doc_id", 5) == 0)
    # The text alone fixes the score, so rejected rows are known by their text.
    scored = toxicity.scored(docs.select("doc_id", "text"), labels, {"key": text_key(F.col("text"))})
    rejected = store(scored.filter(F.col("score") >= toxicity.REJECT_AT).select("key").distinct(), "rejected")
    rows = nested(docs).withColumn("key", text_key(F.col("row.text")))
    return rows.join(rejected, "key", "left_anti").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and each of its texts once.

    Rows without an id stay. A document is the rows of one id; of rows with equal shingles the one whose text
    and other columns come first stays, so the result does not depend on the order of rows.
    """
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    found = setsketch.near_duplicates(keyed, also=("key",))
    kept = found.filter("kept and doc_id is not null").groupBy("doc_id", "digest").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("n")
    )
    kept = store(kept.select(F.col("doc_id").alias("id"), "key", "n"), "dedup")
    rows = nested(docs).withColumns({"id": F.col("row.doc_id"), "key": text_key(F.col("row.text"))})
    single = rows.join(kept.filter("n = 1").select("id", "key"), ["id", "key"], "left_semi").select("row.*")
    several = rows.join(kept.filter("n > 1").select("id", "key"), ["id", "key"], "left_semi")
    first = several.groupBy("id", "key").agg(F.min("row").alias("row")).select("row.*")
    without = docs.filter(F.col("doc_id").isNull())
    return single.unionByName(first).unionByName(without)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with pseudonyms in its text."""
    texts = nested(docs).select("row", F.col("row.text").alias("text"))
    found = pseudonyms.with_pseudonyms(texts, pseudonyms.key_of(spark))
    return found.select(
        *(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    rows = store(nested(docs).withColumn("number", F.monotonically_increasing_id()), "rows")
    sized = rows.select("row.doc_id", "row.source", "row.text", "number")
    taken = mixing.mix(sized, row="number").filter("copies > 0").select("number", F.col("copies").cast("int").alias("copies"))
    joined = rows.join(taken, "number")
    turns = joined.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return turns.select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequences and places."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None
"""SQL cannot express the stages; the tests hold each against a plain version."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
