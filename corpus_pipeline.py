"""A training corpus from raw documents: toxic ones go, copies and near copies go, personal data is replaced, the rest is packed.

An empty table goes through all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import exact_dedup, jaccard, packing, pii, toxicity
from plumbline.llm._spark import free, ship, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones that aren't held out, doesn't call toxic.

    Rows with null or repeated ids and null or empty texts are scored as any other; other columns don't matter.
    """
    ship(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    toxic = free(docs, "toxic")
    return toxicity.score(docs, model, keep=toxic).where(~F.col(toxic)).drop(toxic)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null is empty) the row with the largest id; of several such rows one. A null id loses to any other."""
    ship(spark)
    return exact_dedup.keep_one(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts: that with the smallest id, null ids last. Texts without words all stay.

    Rows are known by a number of their own, so ids may be null or repeat.
    """
    ship(spark)
    row = free(docs, "row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = jaccard.near_duplicates(rows.select(row, "text"), row, count_links=False).withColumnRenamed("doc_id", "at")
    worded = found.where("n_shingles > 0").join(rows.select(F.col(row).alias("at"), "doc_id"), "at")
    first = worded.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at"))["at"].alias("kept"))
    kept = first.select("kept").union(found.where("n_shingles = 0").select("at"))
    return rows.join(kept, rows[row] == kept["kept"], "left_semi").drop(row)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars, where there is such a column, follows the new text."""
    ship(spark)
    new = pii.replace(docs)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: a row for each piece of a document. Null text counts as empty; ids may be null or repeat."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", replace_private),
    ("best-fit packing", pack),
]

#: The classifier, the hashes' surrogates and the packing have no SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
