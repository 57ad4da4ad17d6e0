"""Detection boxes as arrays: parsing, geometry, filters, summaries and greedy one-to-one matching, without UDFs.

A box is [x, y, w, h] in shares of the image; a detection is struct(label, score, box).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import variants as V
from .binding import let

DETECTIONS = "array<struct<label:string,score:double,box:array<double>>>"
#: Shares of the image below and above which a detection is noise, its least score, and how many are kept.
MIN_SCORE, MIN_AREA, MAX_AREA, KEEP = 0.2, 0.002, 0.95, 3


def parse_delimited(text: Column) -> Column:
    """'x,y,w,h|x,y,w,h' to array<array<double>>; chunks without four numbers are left out."""
    chunks = F.transform(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda c: F.transform(F.split(c, ","), lambda v: v.try_cast("double")))
    return F.filter(chunks, lambda b: (F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull()))


def format_delimited(boxes: Column) -> Column:
    return F.array_join(F.transform(boxes, lambda b: F.array_join(F.transform(b, lambda v: v.cast("string")), ",")), "|")


def parse_json(text: Column) -> Column:
    """JSON list of detections, read element by element: array of struct(label, score, box).

    Null, empty and broken texts and JSON that is no list give an empty list. Elements that are no objects, boxes without four numbers and
    scores that are no numbers cost only their element. Numbers may stand in texts. A missing or empty score is 0, a missing label ''.
    """
    found = F.filter(V.items(V.parsed(text)), V.is_object)
    label, score = (lambda d: V.field(d, "label")), (lambda d: V.field(d, "score"))
    made = F.transform(
        found,
        lambda d: F.struct(
            F.when(label(d).isNull(), "").otherwise(V.text(label(d))).alias("label"),
            F.when(V.empty(score(d)), F.lit(0.0)).otherwise(V.number(score(d))).alias("score"),
            F.transform(V.items(V.field(d, "box")), V.number).alias("box"),
        ),
    )
    good = F.filter(made, lambda d: (F.size(d["box"]) == 4) & ~F.exists(d["box"], lambda v: v.isNull()) & d["score"].isNotNull())
    return F.coalesce(good, F.array()).cast(DETECTIONS)


def _both(a: Column, b: Column) -> Column:
    """Area of the intersection."""
    w = F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def overlap_more(a: Column, b: Column, share: float) -> Column:
    """Whether the intersection is more than that share of the union of two boxes with area.

    Compared as a product: the quotient may round down to the share where the product doesn't.
    """
    both = _both(a, b)
    return both > F.lit(share) * (a[2] * a[3] + b[2] * b[3] - both)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 for boxes without area, 1 at most."""
    both = _both(a, b)
    union = a[2] * a[3] + b[2] * b[3] - both
    empty = (a[2] <= 0) | (a[3] <= 0) | (b[2] <= 0) | (b[3] <= 0) | (union <= 0)
    return F.when(empty, F.lit(0.0)).otherwise(F.least(both / F.when(union > 0, union), F.lit(1.0)))


def from_corners(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, sort: bool = True) -> Column:
    """Pixel corners to a normalized box, rounded to four places; corners may come in either order where sort is set."""
    left, right = (F.least(x0, x1), F.greatest(x0, x1)) if sort else (x0, x1)
    top, bottom = (F.least(y0, y1), F.greatest(y0, y1)) if sort else (y0, y1)
    zero = F.lit(0.0)
    place = [F.greatest(left, zero) / width, F.greatest(top, zero) / height]
    extent = [F.greatest(right - left, zero) / width, F.greatest(bottom - top, zero) / height]
    return F.array(*[F.round(v, 4) for v in place + extent])


def padded_crop(box: Column, width: Column, height: Column, pad: float = 0.25) -> Column:
    """struct(x0, y0, x1, y1) in pixels of a box with padding, held within the image; the whole image where nothing is left."""
    dx, dy = box[2] * pad, box[3] * pad
    x0 = F.greatest(F.floor((box[0] - dx) * width), F.lit(0)).cast("int")
    y0 = F.greatest(F.floor((box[1] - dy) * height), F.lit(0)).cast("int")
    x1 = F.least(F.ceil((box[0] + box[2] + dx) * width), width).cast("int")
    y1 = F.least(F.ceil((box[1] + box[3] + dy) * height), height).cast("int")
    none = (x1 <= x0) | (y1 <= y0)
    zero = F.lit(0)
    parts = [F.when(none, zero).otherwise(x0), F.when(none, zero).otherwise(y0), F.when(none, width.cast("int")).otherwise(x1), F.when(none, height.cast("int")).otherwise(y1)]
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("x0", "y0", "x1", "y1"), strict=True)])


def plausible(detections: Column, min_score: float = MIN_SCORE, min_area: float = MIN_AREA, max_area: float = MAX_AREA) -> Column:
    """Detections by score and by the area of their rounded sides."""
    area = lambda d: F.round(d["box"][2], 4) * F.round(d["box"][3], 4)
    return F.filter(detections, lambda d: (d["score"] >= min_score) & (area(d) >= min_area) & (area(d) <= max_area))


def by_score(detections: Column) -> Column:
    """By score descending; equal scores keep their order."""
    placed = F.transform(detections, lambda d, i: F.struct((-d["score"]).alias("minus"), i.alias("place"), d.alias("d")))
    return F.transform(F.array_sort(placed), lambda p: p["d"])


def top(detections: Column, k: int = KEEP) -> Column:
    return F.slice(by_score(detections), 1, k)


def by_area(boxes: Column) -> Column:
    """Boxes (not detections) by area descending; equal areas keep their order."""
    placed = F.transform(boxes, lambda b, i: F.struct((-(b[2] * b[3])).alias("minus"), i.alias("place"), b.alias("b")))
    return F.transform(F.array_sort(placed), lambda p: p["b"])


def summary(detections: Column) -> Column:
    """struct(n, top_label, top_score, boxes as JSON) of detections in order of score."""
    first = F.get(detections, 0)
    return F.struct(F.size(detections).alias("n"), F.coalesce(first["label"], F.lit("")).alias("top_label"), first["score"].alias("top_score"), F.to_json(detections).alias("boxes"))


def face_summary(detections: Column) -> Column:
    """struct(n_faces, face_area, max_conf): the count, the sum of areas and the best score."""
    area = F.aggregate(detections, F.lit(0.0), lambda s, d: s + d["box"][2] * d["box"][3])
    return F.struct(F.size(detections).alias("n_faces"), F.round(area, 4).alias("face_area"), F.round(F.coalesce(F.array_max(F.transform(detections, lambda d: d["score"])), F.lit(0.0)), 4).alias("max_conf"))


PAIR = "struct<label:string,iou:double,score_a:double,score_b:double,box_a:array<double>,box_b:array<double>>"


def greedy_match(a: Column, b: Column, min_iou: float = 0.3) -> Column:
    """One-to-one pairs of equal labels: detections of a by score descending, each with its best unused one of b.

    A pair needs an overlap of at least min_iou (before rounding). Of equally good partners the last one in b is taken.
    Pairs come by their lesser score, descending; equal ones keep the order in which they were made.
    """
    # overlaps are worked out once for each two of a label, then the fold only looks at partners that are good enough
    def partners(d: Column, places: Column) -> Column:
        same = F.filter(places, lambda p: p["e"]["label"] == d["label"])
        return F.filter(F.transform(same, lambda p: F.struct(iou(d["box"], p["e"]["box"]).alias("iou"), p["place"].alias("place"))), lambda p: p["iou"] >= min_iou)

    numbered = F.transform(b, lambda e, i: F.struct(i.alias("place"), e.alias("e")))
    fits = let(numbered, lambda places: F.transform(by_score(a), lambda d: F.struct(d.alias("d"), partners(d, places).alias("fits"))))

    step_type = "struct<used:array<int>,chosen:array<struct<place:int,iou:double>>>"
    start = F.struct(F.array().alias("used"), F.array().alias("chosen")).cast(step_type)

    def step(s: Column, x: Column) -> Column:
        best = F.array_max(F.filter(x["fits"], lambda p: ~F.array_contains(s["used"], p["place"])))
        # one entry for each detection of a, null where it has no partner
        taken = lambda c: F.struct(F.when(c.isNull(), s["used"]).otherwise(F.array_append(s["used"], c["place"])).alias("used"), F.array_append(s["chosen"], F.struct(c["place"].alias("place"), c["iou"].alias("iou"))).alias("chosen")).cast(step_type)
        return let(best, taken)

    rounded = lambda box: F.transform(box, lambda v: F.round(v, 4))

    def pair(d: Column, c: Column) -> Column:
        e = F.get(b, c["place"])
        return F.struct(d["label"].alias("label"), F.round(c["iou"], 4).alias("iou"), F.round(d["score"], 3).alias("score_a"), F.round(e["score"], 3).alias("score_b"), rounded(d["box"]).alias("box_a"), rounded(e["box"]).alias("box_b"))

    def made(fits: Column) -> Column:
        both = F.arrays_zip(fits.alias("f"), F.aggregate(fits, start, step)["chosen"].alias("c"))
        return F.transform(F.filter(both, lambda z: z["c"]["place"].isNotNull()), lambda z: pair(z["f"]["d"], z["c"]).cast(PAIR))

    pairs = let(F.filter(fits, lambda x: F.size(x["fits"]) > 0), made)
    placed = F.transform(pairs, lambda p, i: F.struct((-F.least(p["score_a"], p["score_b"])).alias("minus"), i.alias("place"), p.alias("p")))
    return F.transform(F.array_sort(placed), lambda p: p["p"])


def pair_summary(pairs: Column) -> Column:
    """struct(n, top_label, top_score): the first pair's label and lesser score."""
    first = F.get(pairs, 0)
    return F.struct(F.size(pairs).alias("n"), F.coalesce(first["label"], F.lit("")).alias("top_label"), F.least(first["score_a"], first["score_b"]).alias("top_score"))


def same_label(a: Column, b: Column) -> Column:
    """1 where both top labels are there and equal, else 0."""
    return (F.coalesce(a, F.lit("")) != "").cast("int") * F.coalesce((a == b).cast("int"), F.lit(0))
