"""Exact dedup by deterministic block naming.

A text is cut into blocks of BLOCK bytes. The distinct blocks are sorted and get integers as names; then the names
of adjacent blocks are paired, the distinct pairs are sorted and named, and so on, until each text has one name.
Texts have the same name at the same level if and only if they are equal. A name is a value's place in one sorted order
of all distinct values (blocks by SHA-256, pairs by their two names), so names don't depend on how rows were dealt.

Whole blocks cross the network once, combined before the shuffle, so a text with very many copies costs one row for
each task. Blocks are told apart as wholes; their SHA-256 only sorts them and stands for them where they occur, and a
digest that two different blocks shared would stop the job, so no result rests on a hash. The joins of occurrences and
names are plain sort-merge joins between two exchanges, which adaptive execution splits where a name is very common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import free, numbered, utf8, written

BLOCK = 4096


def _distinct(values: DataFrame, keys: list[str]) -> DataFrame:
    return values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).drop("n")


def _collision(names: DataFrame) -> bool:
    return names.groupBy("digest").count().where("count > 1").limit(1).count() > 0


def block_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Rows (id, text_sha256, level, name, copies): one for each id and text; copies counts repeated rows.

    Null text counts as empty (one empty block). Null and repeated ids are kept: a row is known by its id and its text.
    Extra columns are not read, so their names can't clash. An empty table gives no rows.
    """
    body = utf8(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), body.alias("body"))
    n = F.greatest(F.ceil(F.length("body") / F.lit(block)), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(F.col("body"), i * block + 1, F.lit(block)))
    rows = rows.withColumn("n", n)
    blocks = _distinct(rows.select(F.explode(cut).alias("piece")), ["piece"]).select(F.sha2("piece", 256).alias("digest"))
    names = numbered(written(blocks, "blocks"), ["digest"], "name", "names")
    if _collision(names):
        raise RuntimeError("two different blocks share a SHA-256 digest")
    digests: Column = F.transform(cut, lambda b: F.sha2(b, 256))
    spread = rows.select("id", F.sha2("body", 256).alias("text_sha256"), "n", F.posexplode(digests).alias("pos", "digest"))
    level = written(
        spread.join(names, "digest").select("id", "text_sha256", "n", "pos", "name", F.lit(1).cast("bigint").alias("copies")), "level0"
    )
    # repeated rows meet here, and below where pairs are formed
    done = level.where("n = 1").groupBy("id", "text_sha256", "name").agg(F.sum("copies").alias("copies"))
    done = done.select("id", "text_sha256", F.lit(0).alias("level"), "name", "copies")
    left, depth = level.where("n > 1"), 0
    most = left.agg(F.max("n")).first()[0] or 1
    while most > 1:
        depth += 1
        pair = left.groupBy("id", "text_sha256", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("one"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("two"),
            F.sum(F.when(F.col("pos") % 2 == 0, F.col("copies"))).alias("copies"),
        )
        pair = written(pair, "pairs")
        names = numbered(written(_distinct(pair, ["one", "two"]), "distinct"), ["one", "two"], "name", "names")
        level = written(
            pair.join(names, ["one", "two"]).select("id", "text_sha256", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name", "copies"), "level"
        )
        done = done.unionByName(level.where("n = 1").select("id", "text_sha256", F.lit(depth).alias("level"), "name", "copies"))
        left, most = level.where("n > 1"), (most + 1) // 2
    return done


def _kept(names: DataFrame) -> DataFrame:
    """names with keep_id and group_size; groups are written first, so a group with very many rows is a plain skewed join."""
    groups = written(names.groupBy("level", "name").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups")
    return names.join(groups, ["level", "name"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. Of several rows with that id and text, one stays. A null id
    loses to any other; where all ids of a group are null, one of its rows stays and keep_id is null.
    """
    out = _kept(block_names(docs, id_col, text_col, block))
    one = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    return out.select("id", "keep_id", "group_size", "text_sha256", one).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows with equal id and text, one. Null text counts as empty.

    Other columns may have any names; an empty table gives no rows.
    """
    names = block_names(docs, id_col, text_col)
    kept = _kept(names).where(F.col("id").eqNullSafe(F.col("keep_id")))
    own = free(docs, "sha")
    rows = docs.withColumn(own, F.sha2(utf8(F.col(text_col)), 256))  # null and empty texts are equal
    if names.where("copies > 1").limit(1).count():
        rows = rows.dropDuplicates([id_col, own])
    kept = kept.select(F.col("id").alias("__i"), F.col("text_sha256").alias("__s")).alias("kept")
    return rows.join(kept, F.col(id_col).eqNullSafe(F.col("kept.__i")) & (F.col(own) == F.col("kept.__s")), "left_semi").drop(own)
