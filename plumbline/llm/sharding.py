"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows of a source are shuffled by a seeded hash and ranked; a row's fraction is (rank - 0.5) / rows of its source.
All rows, sorted by fraction, are cut into equal runs, so every shard holds the mixture of the whole. Both orders are
sorts by ranges of all sorting columns with counts of the ranges, so neither one source with a third of all rows, nor
very many sources whose rows have the same fractions, nor the whole table is sorted in one task. Texts are read once
and not shuffled, only their sizes and checksums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import discard, numbered, utf8, written

#: A source's rows are dealt to so many keys where they meet their source's counts.
SALTS = 64


def shard(docs: DataFrame, shards: int = 8, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, source.

    The law is `rows`: counts of shards differ by one at most, also for a table with fewer rows than shards. Null text
    has no bytes (size 1); null sources form a source of their own; equal ids and texts are ordered arbitrarily among
    themselves, which changes no result row. Equal texts aren't held together: the law and one very large group exclude each other.
    grown_shard is null, as positions depend on all rows. Columns other than the three aren't read, so their names can't clash.
    """
    body = utf8(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    rows = written(rows.withColumn("draw", F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_crc32")), "rows")
    order = ["draw", "doc_id", "text_crc32", "size"]
    by_source = numbered(rows, ["source", *order], "at", "by-source")
    salt = F.pmod("draw", F.lit(SALTS))
    sources = written(by_source.groupBy("source").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("of_source")), "sources")
    total = sources.agg(F.coalesce(F.sum("of_source"), F.lit(0))).first()[0]
    starts = sources.select(F.col("source").alias("s"), "start", "of_source", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("t"))
    ranked = by_source.join(starts, F.col("source").eqNullSafe(F.col("s")) & (salt == F.col("t")))
    ranked = written(ranked.withColumn("fraction", (F.col("at") - F.col("start") + 0.5) / F.col("of_source")).drop("s", "t", "at", "start", "of_source"), "ranked")
    discard(rows)
    placed = numbered(ranked, ["fraction", "source", *order], "position", "placed")
    placed = placed.withColumn("shard", F.expr(f"position * {shards} div {max(total, 1)}").cast("int"))
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("position") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source"
    )
