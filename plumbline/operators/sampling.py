"""Review samples with quotas: seeded, deterministic, the same at any number of partitions.

The order within a group is a hash of the key and the seed, so a sample can be drawn again; it is a permutation of its own,
not that of another library's generator. Ranks are limited before the shuffle where a quota is known (Spark's group limit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(key: Column, seed: int) -> Column:
    """A text whose order is a seeded shuffle; md5, so that other engines can follow it."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")).cast("binary"))


def confidence_bucket(score: Column) -> Column:
    return F.when(score < 0.3, "low").when(score < 0.5, "mid").otherwise("high")


def quotas(n: int, parts: dict[str, float]) -> dict[str, int]:
    return {k: int(round(n * p)) for k, p in parts.items()}


def stratified(rows: DataFrame, bucket: Column, parts: dict[str, float], n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows at most: each bucket's quota in shuffled order, then a backfill by bucket order from what is left."""
    order = list(parts)
    share = quotas(n, parts)
    drawn = rows.withColumn("bucket", bucket).where(F.col("bucket").isin(order)).withColumn("__draw", shuffled(F.col(key), seed))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("__draw", key))
    drawn = drawn.withColumn("__rank", rank).where(F.col("__rank") <= n)  # no bucket gives more than n
    quota = F.coalesce(*[F.when(F.col("bucket") == b, F.lit(share[b])) for b in order])
    place = F.coalesce(*[F.when(F.col("bucket") == b, F.lit(i)) for i, b in enumerate(order)])
    return (
        drawn.withColumn("__late", (F.col("__rank") > quota).cast("int"))
        .orderBy("__late", place, "__rank").limit(n).drop("__draw", "__rank", "__late")
    )


def equal_quota(rows: DataFrame, group: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """max(1, n // groups) of each group, then a backfill from the others, n rows at most."""
    drawn = rows.withColumn("__draw", shuffled(F.col(key), seed))
    drawn = drawn.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy("__draw", key))).where(F.col("__rank") <= n)
    groups = rows.select(F.count_distinct(group).alias("__groups"))
    quota = F.greatest(F.lit(1), F.expr(f"{n} div greatest(__groups, 1)"))
    drawn = drawn.crossJoin(F.broadcast(groups)).withColumn("__late", (F.col("__rank") > quota).cast("int"))
    return drawn.orderBy("__late", "__draw", key).limit(n).drop("__draw", "__rank", "__late", "__groups")


def lowest_first(rows: DataFrame, group: str, score: str, n: int, key: str, lowest: float = 0.7, seed: int = 42) -> DataFrame:
    """n of each group: a share with the lowest scores, the rest drawn from the others."""
    k = int(round(n * lowest))
    low = F.row_number().over(Window.partitionBy(group).orderBy(F.asc_nulls_last(score), key))
    ranked = rows.withColumn("__low", low)
    draw = Window.partitionBy(group).orderBy((F.col("__low") > k).cast("int"), F.when(F.col("__low") <= k, F.lpad(F.col("__low").cast("string"), 12, "0")).otherwise(shuffled(F.col(key), seed)), key)
    return ranked.withColumn("__rank", F.row_number().over(draw)).where(F.col("__rank") <= n).drop("__low", "__rank")


def disagreement_first(verdicts: DataFrame, key: str, verdict: str, n: int, seed: int = 42) -> DataFrame:
    """(key, kind) of n keys: all on which engines disagree, then agreed ones, half positive, half negative (the odd one negative).

    verdicts has a row for each key and engine; null is no opinion, and keys without an opinion are left out.
    """
    v = F.col(verdict)
    kinds = verdicts.where(v.isNotNull()).groupBy(key).agg(F.bool_or(v).alias("some"), F.bool_and(v).alias("all"))
    kind = F.when(F.col("all"), "positive").when(F.col("some"), "disagree").otherwise("negative")
    drawn = kinds.select(key, kind.alias("kind")).withColumn("__draw", F.when(F.col("kind") == "disagree", "").otherwise(shuffled(F.col(key), seed)))
    drawn = drawn.withColumn("__rank", F.row_number().over(Window.partitionBy("kind").orderBy("__draw", key))).where(F.col("__rank") <= n)
    many = drawn.agg(F.count_if(F.col("kind") == "disagree").alias("__many"))
    drawn = drawn.crossJoin(F.broadcast(many)).withColumn("__left", F.greatest(F.lit(0), F.lit(n) - F.col("__many")))
    half = F.floor(F.col("__left") / 2)
    most = F.when(F.col("kind") == "disagree", F.lit(n)).when(F.col("kind") == "positive", half).otherwise(F.col("__left") - half)
    return drawn.where(F.col("__rank") <= most).select(key, "kind")
