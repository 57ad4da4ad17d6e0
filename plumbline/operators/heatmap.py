"""Summaries of heat maps (depth, saliency) given as cells (key, y, x, value), and weighted centroids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import at_ranks, hot_keys, quantiles


def normalized(cells: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Values to [0, 1] within each key; a flat map (range under 1e-6) to zeros."""
    span = cells.groupBy(key).agg(F.min(value).alias("__least"), F.max(value).alias("__most"))
    width = F.col("__most") - F.col("__least")
    return cells.join(span, key).withColumn(value, F.when(width < 1e-6, F.lit(0.0)).otherwise((F.col(value) - F.col("__least")) / F.when(width > 0, width))).drop("__least", "__most")


def _split(cells: DataFrame, key: str, hot: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(cells of keys that fit a task, cells of the others or None)."""
    large = hot_keys(cells, key, hot)
    if large is None:
        return cells, None
    return cells.join(large, key, "left_anti"), cells.join(large, key, "left_semi")


def depth_summary(cells: DataFrame, key: str, value: str = "value", near: float = 0.7, hot: int | None = None) -> DataFrame:
    """Mean, 95th percentile (linear), population deviation and the share above `near` of normalized values.

    Maps of up to `hot` cells (order.HOT) keep their values in one task; those of larger ones are bracketed by sketches and counted in parts.
    """
    v = F.col(value)
    mean, deviation = F.round(F.avg(v), 4).alias("mean_depth"), F.round(F.stddev_pop(v), 4).alias("depth_std")
    close = F.round(F.avg((v > near).cast("double")), 4).alias("close_area_frac")
    small, large = _split(cells, key, hot)
    out = normalized(small, key, value).groupBy(key).agg(mean, F.round(F.percentile(v, 0.95), 4).alias("p95_depth"), deviation, close)
    if large is None:
        return out
    z = normalized(large, key, value)
    top = quantiles(z, value, (0.95,), (key,)).select(key, F.round(F.col("edges")[0], 4).alias("p95_depth"))
    return out.unionByName(z.groupBy(key).agg(mean, deviation, close).join(top, key, "left"))


def saliency_summary(cells: DataFrame, key: str, height: Column, width: Column, value: str = "value", hot: int | None = None) -> DataFrame:
    """Peak place (first in reading order), mass of the top tenth of cells (at least one; 0 for an empty map) and the mean.

    Maps of up to `hot` cells (order.HOT) are ranked in one task. Of larger ones the value of the last cell of the top tenth is found by
    sketches and counts; the tenth has all cells above it, and of those equal to it as many as are left.
    """
    total, v = F.sum(value), F.col(value)
    first = F.min(F.when(v.isNotNull(), F.struct((-v).alias("minus"), F.col("y"), F.col("x"))))
    peak = [F.round(first["x"] / width, 4).alias("peak_x"), F.round(first["y"] / height, 4).alias("peak_y")]
    mean = F.round(F.avg(value), 4).alias("mean_saliency")
    share = lambda top: F.round(F.when(total > 0, top / F.when(total > 0, total)).otherwise(0.0), 4).alias("top10pct_mass")
    tenth = lambda n: F.greatest(F.lit(1), F.floor(n * 0.1))
    small, large = _split(cells, key, hot)
    by_value = Window.partitionBy(key).orderBy(F.desc(value), "y", "x")
    ranked = small.withColumn("__rank", F.row_number().over(by_value)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    out = ranked.groupBy(key).agg(*peak, share(F.sum(F.when(F.col("__rank") <= tenth(F.col("__n")), v))), mean)
    if large is None:
        return out
    last = at_ranks(large, [key], value, lambda n: [n - tenth(n)]).select(key, "n", F.col("values")[0].alias("__last"))
    above = F.sum(F.when(v > F.col("__last"), v).otherwise(0.0))
    left = F.max(tenth(F.col("n"))) - F.count_if(v > F.col("__last"))
    return out.unionByName(large.join(last, key).groupBy(key).agg(*peak, share(above + left * F.max("__last")), mean))


def centroid(rows: DataFrame, key: str, x: str, y: str, weight: str) -> DataFrame:
    """(key, mass_x, mass_y, spread): weighted means and twice the weighted deviation of x; null without weight."""
    w, total = F.col(weight), F.sum(weight)
    safe = F.when(total > 0, total)
    mean_x = F.sum(F.col(x) * w) / safe
    spread = F.sum(F.col(x) * F.col(x) * w) / safe - mean_x * mean_x
    return rows.groupBy(key).agg(F.round(mean_x, 4).alias("mass_x"), F.round(F.sum(F.col(y) * w) / safe, 4).alias("mass_y"), F.round(2 * F.sqrt(F.greatest(spread, F.lit(0.0))), 4).alias("spread"))


def hue_harmony(hues: DataFrame, key: str, hue: str = "hue", bins: int = 36) -> DataFrame:
    """(key, harmony): how near the pairs of up to three strong hues (over 3 % of all) are to 30, 90, 120 or 180 degrees; -1 for fewer than two."""
    binned = hues.groupBy(key, F.floor(F.col(hue) / (360 / bins)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    ranked = binned.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), F.desc("bin")))).withColumn("__all", F.sum("n").over(Window.partitionBy(key)))
    strong = F.when((F.col("__rank") <= 3) & (F.col("n") > F.col("__all") * 0.03), F.col("bin") * (360.0 / bins))
    peaks = ranked.groupBy(key).agg(F.array_sort(F.collect_list(strong)).alias("p"))  # three entries at most
    apart = lambda i, j: F.least(F.abs(F.get("p", i) - F.get("p", j)), 360 - F.abs(F.get("p", i) - F.get("p", j)))
    off = lambda d: F.least(*[F.abs(d - a) for a in (30, 90, 120, 180)]) / 180
    three = (off(apart(0, 1)) + off(apart(0, 2)) + off(apart(1, 2))) / 3
    value = F.when(F.size("p") >= 3, 1 - three).when(F.size("p") == 2, 1 - off(apart(0, 1))).otherwise(F.lit(-1.0))
    return peaks.select(key, F.round(value, 4).alias("harmony"))


def layout_alignment(blocks: DataFrame, key: str, width: Column, height: Column) -> DataFrame:
    """(key, n_blocks, align_score): mean distance of each block's edge and middle lines to the nearest one of the other blocks.

    -1 for fewer than two blocks. The nearest other value is a neighbour in sorted order, so no pairs of blocks are made.
    """
    lines = F.array(
        *[F.struct(F.lit(n).alias("line"), (v / size).alias("at")) for n, v, size in (
            ("l", F.col("x0"), width), ("c", (F.col("x0") + F.col("x1")) / 2, width), ("r", F.col("x1"), width),
            ("t", F.col("y0"), height), ("m", (F.col("y0") + F.col("y1")) / 2, height), ("b", F.col("y1"), height))]
    )
    each = blocks.select(key, F.explode(lines).alias("e")).select(key, "e.line", "e.at")
    w = Window.partitionBy(key, "line").orderBy("at")
    near = each.withColumn("d", F.least(F.col("at") - F.lag("at").over(w), F.lead("at").over(w) - F.col("at")))
    return near.groupBy(key).agg((F.count(F.lit(1)) / 6).cast("int").alias("n_blocks"), F.round(F.coalesce(F.avg("d"), F.lit(-1.0)), 4).alias("align_score"))
