"""Greedy suppression of overlapping boxes, within sets of any number of boxes: rows in, rows out.

Boxes of a set are taken by score; one stays unless it overlaps a better one that stays. Only boxes that can overlap
are compared: each lies in the cells of a grid as coarse as its longer side and of the few next coarser grids, since two boxes
whose longer sides differ by more than the threshold allows can't overlap so much. Of a pair of boxes the cell that holds
the upper left corner of their intersection compares them, so each pair comes once and from one shuffle by (set, grid,
cell). The greedy choice itself is a fold over those boxes of a set that overlap others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import boxes as B

#: Least score, and overlap up to which both boxes stay.
MIN_SCORE, MAX_OVERLAP = 0.6, 0.3
#: Grids are no finer than this power of two.
FINEST = 20


def _cells(size: Column, at: Column, extent: Column) -> Column:
    return F.sequence(F.floor(at / size).cast("bigint"), F.floor((at + extent) / size).cast("bigint"))


def suppressed(rows: DataFrame, keys: list[str], score: str = "score", box: str = "box", min_score: float = MIN_SCORE, max_overlap: float = MAX_OVERLAP, best: int | None = None) -> DataFrame:
    """The rows that stay, with their place among the looked-at ones of their set (`place`, from 1) as a further column.

    keys name a set; box is [x, y, w, h]. Rows below min_score, with null scores or without a box of four finite numbers go;
    so do all but the `best` best of a set where a caller asks for that (all are looked at otherwise). Equal scores are taken by
    box, smaller first; rows that are equal in both are interchangeable, and of those one stays. Boxes without area overlap nothing. An empty table
    gives no rows.
    """
    if not 0 < max_overlap < 1:
        raise ValueError("max_overlap lies between 0 and 1")
    b = F.col(box)
    good = (F.col(score) >= min_score) & (F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), b)
    taken = rows.where(good).withColumn("place", F.row_number().over(order))
    if best is not None:
        taken = taken.where(F.col("place") <= best)

    # the grid of a box: cells are as long as the next power of two of its longer side
    side = F.greatest(b[2], b[3])
    level = F.least(-F.ceil(F.log2(side)), F.lit(FINEST)).cast("int")
    steps = math.ceil(-math.log2(max_overlap))
    flat = taken.where((b[2] > 0) & (b[3] > 0)).select(*keys, "place", b.alias("b"), level.alias("own"))
    grids = flat.withColumn("grid", F.explode(F.sequence(F.col("own") - steps, F.col("own"))))
    size = F.pow(F.lit(2.0), -F.col("grid"))
    placed = grids.withColumn("cx", F.explode(_cells(size, F.col("b")[0], F.col("b")[2]))).withColumn("cy", F.explode(_cells(size, F.col("b")[1], F.col("b")[3])))
    cell = [*keys, "grid", "cx", "cy"]
    left = placed.select(*[F.col(c).alias(f"__{c}") for c in cell], F.col("place").alias("p"), F.col("b").alias("pb"), F.col("own").alias("pown"))
    right = placed.select(*cell, F.col("place").alias("q"), F.col("b").alias("qb"), F.col("own").alias("qown"))
    # where the coarser of two grids is the cell's, and the cell holds the corner of the intersection
    corner = lambda k: F.floor(F.greatest(F.col("pb")[k], F.col("qb")[k]) / size).cast("bigint")
    here = (F.least("pown", "qown") == F.col("grid")) & (corner(0) == F.col("cx")) & (corner(1) == F.col("cy"))
    together = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cell]
    pairs = left.join(right, together).where((F.col("p") < F.col("q")) & here & B.overlap_more(F.col("pb"), F.col("qb"), max_overlap))

    each = pairs.groupBy(*keys, "q").agg(F.collect_list("p").alias("better"))
    sets = each.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("q", "better"))).alias("all"))
    none = F.array().cast("array<int>")
    gone = F.aggregate("all", none, lambda gone, x: F.when(F.size(F.array_except(x["better"], gone)) > 0, F.array_append(gone, x["q"])).otherwise(gone))
    out = sets.select(*[F.col(k).alias(f"__{k}") for k in keys], F.explode(gone).alias("__place"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return taken.join(out, [*same, F.col("place") == F.col("__place")], "left_anti")
