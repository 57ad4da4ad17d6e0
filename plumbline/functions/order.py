"""Order statistics without a task that sees all rows of a table or of one key: running sums by ranges, exact values at ranks.

A mergeable sketch of each key brackets what is looked for; only values within the bracket are counted, by value, so
one key with most of the rows is spread over as many tasks as its values need. Counts show whether the bracket held it. Where
it didn't (sketches err with a small probability), that key is counted whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Size of a sketch (it errs by about 0.3 % of the ranks), the quantiles that are read off it, and by how many of them a bracket is wider
#: than what is looked for: 1 %.
SKETCH, STEPS, MARGIN = 1000, 200, 2
#: Keys with more rows than this are spread; up to it a key fits a task.
HOT = 200_000


def running(rows: DataFrame, order: list[str], amount: Column, out: str) -> DataFrame:
    """rows with the sum of `amount` over all rows before, in the given order (ascending, nulls first).

    Rows are dealt by ranges of all sorting columns, as many as the table needs, and sorted within each; a range starts with
    the sum of those before it. Rows that are equal in all columns fall into one range, in any order among themselves.
    """
    sort = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__at": F.monotonically_increasing_id(), "__a": amount})
    sort = written(sort, "sorted").withColumn("__part", F.shiftright("__at", 33))
    totals = sort.groupBy("__part").agg(F.sum("__a").alias("__t"))  # a row for each range
    starts = totals.select("__part", (F.sum("__t").over(Window.orderBy("__part")) - F.col("__t")).alias("__s"))
    here = F.sum("__a").over(Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__a")
    return sort.withColumn("__h", here).join(F.broadcast(starts), "__part").withColumn(out, F.col("__s") + F.col("__h")).drop("__part", "__at", "__a", "__h", "__s")


def _counted(x: DataFrame, brackets: DataFrame) -> DataFrame:
    """(__k, i, v) of the brackets (__k, i, r, lo, hi) whose rank r (from 0) lies in them."""
    inside = x.join(brackets, "__k").where("x <= hi")
    counts = inside.groupBy("__k", "i", "r", F.when(F.col("x") >= F.col("lo"), F.col("x")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    placed = running(counts, ["__k", "i", "v"], F.col("c"), "before")
    first = placed.groupBy("__k", "i").agg(F.min("before").alias("first"))
    at = F.col("before") - F.col("first")
    return placed.join(first, ["__k", "i"]).where((at <= F.col("r")) & (F.col("r") < at + F.col("c")) & F.col("v").isNotNull()).select("__k", "i", "v")


def at_ranks(rows: DataFrame, keys: list[str], column: str, ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """(keys, n, values): each key's count and its exact values at the ranks (from 0, ascending) that `ranks` makes of n.

    Null and NaN values don't count; keys without values are absent. Null keys are keys. Without keys the whole table is
    one. Ranks outside of 0 to n - 1 are moved to the nearer end.
    """
    x = rows.select(F.struct(F.lit(0).alias("_"), *keys).alias("__k"), F.col(column).cast("double").alias("x")).where("x is not null and not isnan(x)")
    n = F.count(F.lit(1))
    sketched = x.groupBy("__k").agg(n.alias("n"), F.kll_sketch_agg_double("x", F.lit(SKETCH)).alias("s"))
    wanted = F.posexplode(F.array(*[F.least(F.greatest(r.cast("bigint"), F.lit(0)), F.col("n") - 1) for r in ranks(F.col("n"))]))
    each = sketched.select("__k", "n", "s", wanted.alias("i", "r"))
    grid = F.array(*[F.lit(k / STEPS) for k in range(STEPS + 1)])
    each = each.withColumn("grid", F.kll_sketch_get_quantile_double("s", grid))
    share = F.col("r") * STEPS / F.col("n")
    low, high = F.floor(share) - MARGIN, F.ceil(share + STEPS / F.col("n")) + MARGIN
    at = lambda k: F.get("grid", F.least(F.greatest(k, F.lit(0)), F.lit(STEPS)).cast("int"))
    brackets = written(each.select("__k", "n", "i", "r", at(low).alias("lo"), at(high).alias("hi")), "brackets")
    found = written(_counted(x, brackets.drop("n")), "found")
    missed = brackets.join(found, ["__k", "i"], "left_anti")
    if not missed.isEmpty():
        whole = missed.select("__k", "i", "r", F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"))
        found = found.union(_counted(x, whole))
    values = F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"])  # as many as ranks were asked for
    sizes = brackets.where("i = 0").select("__k", "n")
    return found.groupBy("__k").agg(values.alias("values")).join(sizes, "__k").select(*[F.col(f"__k.{k}").alias(k) for k in keys], "n", "values")


def quantiles(rows: DataFrame, column: str, cuts: tuple[float, ...], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, edges): exact quantiles with linear interpolation; null and NaN values don't count. Without keys one row, whose edges are empty where there are no values."""
    pair = lambda n: [r for c in cuts for r in (F.floor(c * (n - 1)), F.floor(c * (n - 1)) + 1)]
    found = at_ranks(rows, list(keys), column, pair)

    def edge(i: int, cut: float) -> Column:
        a, b, at = F.col("values")[2 * i], F.col("values")[2 * i + 1], cut * (F.col("n") - 1)
        return a + (b - a) * (at - F.floor(at))

    edges = F.array(*[edge(i, c) for i, c in enumerate(cuts)])
    if keys:
        return found.select(*keys, edges.alias("edges"))
    return found.agg(F.coalesce(F.any_value(edges), F.array().cast("array<double>")).alias("edges"))


def hot_keys(rows: DataFrame, key: str, most: int | None = None) -> DataFrame | None:
    """The keys with more rows than HOT, or None where there are none; at most one key for each HOT rows of the table."""
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > (HOT if most is None else most)).select(key)
    found = written(found, "hot")
    return None if found.isEmpty() else found
