"""Quantile registers of an axis: exact linear quantiles of the whole corpus, and agreement between registers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.order import quantiles
from ..functions.ratios import ratio

NAMES = ["minimal", "restrained", "balanced", "decorated", "ornate"]
CUTS = (0.2, 0.4, 0.6, 0.8)


def edges(values: DataFrame, axis: str) -> DataFrame:
    """One row with the array `edges`: exact linear quantiles of the whole column, without a task that sees all of it."""
    return quantiles(values, axis, CUTS)


def register_index(axis: Column, edges_: Column) -> Column:
    return F.size(F.filter(edges_, lambda e: e <= axis))


def registers(values: DataFrame, axis: str, out: str = "register") -> DataFrame:
    """values with the register's name; the number of edges up to the value picks it."""
    names = F.array(*[F.lit(n) for n in NAMES])
    cut = values.crossJoin(F.broadcast(edges(values, axis)))  # one row
    return cut.withColumn(out, F.get(names, register_index(F.col(axis), F.col("edges")))).drop("edges")


def distance(a: Column, b: Column) -> Column:
    """Steps between two registers; null where one isn't a register's name."""
    names = F.array(*[F.lit(n) for n in NAMES])
    place = lambda c: F.nullif(F.array_position(names, c), F.lit(0).cast("bigint"))
    return F.abs(place(a) - place(b))


def agreement(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, and how many pairs agree, are adjacent (one step) or disagree, which exclude each other, and the rates."""
    d = distance(F.col(a), F.col(b))
    n, same, near = F.count(F.lit(1)), F.count_if(d == 0), F.count_if(d == 1)
    return pairs.agg(
        n.alias("n"), same.alias("agree"), near.alias("adjacent"), (n - same - near).alias("disagree"),
        F.round(F.coalesce(ratio(same, n), F.lit(0.0)), 6).alias("agree_rate"),
        F.round(F.coalesce(ratio(same + near, n), F.lit(0.0)), 6).alias("within_one_rate"),
    )
