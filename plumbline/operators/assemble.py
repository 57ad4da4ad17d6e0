"""Master table: a base left-joined with any number of metric tables, each with its own column prefix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, keys: list[str], order: list, last: bool = False) -> DataFrame:
    """One row for each key: the first (or last) in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) if last else F.asc(c) for c in order]))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def prefixed(table: DataFrame, stem: str, key: str = "id", dropped: tuple[str, ...] = ("title", "year")) -> DataFrame:
    return table.select(key, *[F.col(f"`{c}`").alias(f"{stem}_{c}") for c in table.columns if c != key and c not in dropped])


def rollup(children: DataFrame, key: str, index: str, label: str, score: str, out: str = "summary") -> DataFrame:
    """Child rows to (key, n, 'label:score;label:score' in index order); rows without a label count but aren't listed."""
    entry = F.when(F.col(label).isNotNull(), F.struct(F.col(index).alias("i"), F.concat_ws(":", F.col(label), F.col(score).cast("string")).alias("t")))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["t"])
    return children.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array_join(listed, ";").alias(out))


def master(base: DataFrame, tables: dict[str, DataFrame], key: str = "id", order: dict[str, list] | None = None) -> DataFrame:
    """base and all tables in the order of their names; a table with repeated keys needs an order, of which the first row counts.

    All joins have one key, so Spark shuffles each table once and reuses the base's partitioning. Tables without an order
    are taken as unique by key.
    """
    order = order or {}
    ready = [prefixed(first_by(t, [key], order[n]) if n in order else t, n, key) for n, t in sorted(tables.items())]
    return reduce(lambda left, right: left.join(right, key, "left"), ready, base)


def nested_lookup(inputs: DataFrame, engine_a: DataFrame, engine_b: DataFrame, key: str = "id") -> DataFrame:
    """Each input with its row of both engines as structs a and b, null where there is none; inputs without a key go."""
    packed = lambda t, name: t.select(key, F.struct(*[c for c in t.columns if c != key]).alias(name))
    return inputs.where(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) != "").join(packed(engine_a, "a"), key, "left").join(packed(engine_b, "b"), key, "left")
