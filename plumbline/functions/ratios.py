"""Guarded ratios and confusion metrics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(condition: Column) -> Column:
    """Part of all rows for which the condition holds; null counts as not."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole; null where whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def confusion(verdict: Column, truth: Column, times: Column | None = None) -> list[Column]:
    """n, tp, fp, fn, tn, accuracy (0 without rows), precision and recall (null without a denominator); a row counts `times` times."""
    count = F.count_if if times is None else lambda holds: F.coalesce(F.sum(F.when(holds, times)), F.lit(0))
    tp, fp, fn, tn = (count(v & t) for v, t in ((verdict, truth), (verdict, ~truth), (~verdict, truth), (~verdict, ~truth)))
    n = tp + fp + fn + tn
    return [
        n.alias("n"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        F.round(F.coalesce(ratio(tp + tn, n), F.lit(0.0)), 6).alias("accuracy"),
        F.round(ratio(tp, tp + fp), 6).alias("precision"),
        F.round(ratio(tp, tp + fn), 6).alias("recall"),
    ]
