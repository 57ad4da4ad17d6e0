"""Keypoint summaries as array expressions: 17 keypoints [x, y, score] in pixels and a person box [x0, y0, x1, y1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binding import let

# Keypoint numbers (COCO order) of left and right sides, shoulders and hips.
PAIRS = ((1, 2), (3, 4), (5, 6), (7, 8), (9, 10), (11, 12), (13, 14), (15, 16))
TORSO = (5, 6, 11, 12)
CONFIDENT = 0.3


def largest(boxes: Column) -> Column:
    """The box of the primary figure: largest area, the first of equal ones."""
    area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    return F.array_max(F.transform(boxes, lambda b, i: F.struct(area(b).alias("area"), (-i).alias("minus"), b.alias("box"))))["box"]


def summary(keypoints: Column, box: Column, least: float = CONFIDENT) -> Column:
    """struct(kpt_bbox_area_frac, limb_asymmetry, mean_kpt_confidence); the first two are null under three confident points.

    Distances of left and right points from the torso's middle; without four confident torso points the middle of all confident
    ones; null asymmetry where no pair is confident.
    """
    k = lambda i: F.get(keypoints, i)
    w, h = F.greatest(box[2] - box[0], F.lit(1e-6)), F.greatest(box[3] - box[1], F.lit(1e-6))
    torso = F.lit(True)
    for i in TORSO:
        torso = torso & (k(i)[2] >= least)

    # each step is bound once for a row: named again in every pair, it would be worked out again for every pair
    def middle(sure: Column, d: int) -> Column:
        mean = F.aggregate(sure, F.lit(0.0), lambda s, p: s + p[d]) / F.when(F.size(sure) > 0, F.size(sure))
        return F.when(torso, sum((k(i)[d] for i in TORSO[1:]), k(TORSO[0])[d]) / 4).otherwise(mean)

    def away(m: Column) -> Column:
        return F.array(*[F.when(k(i)[2] >= least, F.hypot(k(i)[0] - m[0], k(i)[1] - m[1])) for pair in PAIRS for i in pair])

    def measures(sure: Column) -> Column:
        extent = lambda d: F.array_max(F.transform(sure, lambda p: p[d])) - F.array_min(F.transform(sure, lambda p: p[d]))
        far = let(F.array(middle(sure, 0), middle(sure, 1)), away)
        diffs = let(far, lambda a: F.array_compact(F.array(*[F.abs(a[2 * j] - a[2 * j + 1]) / F.greatest(w, h) for j in range(len(PAIRS))])))
        asymmetry = let(diffs, lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.when(F.size(x) > 0, F.size(x)))
        enough = F.size(sure) >= 3
        return F.struct(F.when(enough, F.round(extent(0) * extent(1) / (w * h), 4)).alias("area"), F.when(enough, F.round(asymmetry, 4)).alias("asymmetry"))

    confidence = F.aggregate(keypoints, F.lit(0.0), lambda s, p: s + p[2]) / F.when(F.size(keypoints) > 0, F.size(keypoints))
    found = let(F.filter(keypoints, lambda p: p[2] >= least), measures)
    return let(
        found,
        lambda m: F.struct(
            m["area"].alias("kpt_bbox_area_frac"), m["asymmetry"].alias("limb_asymmetry"), F.round(confidence, 3).alias("mean_kpt_confidence")
        ),
    )
