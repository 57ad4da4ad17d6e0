"""Table functions for SQL, called in lateral joins.

Rows go to Python and back pickled, many at a time: with useArrow each single call of eval would cost an Arrow batch and a data frame.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

DETECTION = "place int, label string, score double, x double, y double, w double, h double"


def _rows(text: str | None) -> list[tuple]:
    """The list's detections, element by element; what isn't one costs only itself."""
    try:
        found = json.loads(text or "")
    except ValueError:
        return []
    out = []
    for place, d in enumerate(found if isinstance(found, list) else []):
        try:
            x, y, w, h = (float(v) for v in d["box"])
            row = (place, str(d.get("label", "")), float(d.get("score") or 0.0), x, y, w, h)
        except (TypeError, ValueError, KeyError, AttributeError):
            continue
        if all(math.isfinite(v) for v in row[2:]):
            out.append(row)
    return out


@udtf(returnType=DETECTION, useArrow=False)
class Detections:
    """detections(boxes): a row for each detection of a JSON list; `place` is that in the list, from 0. No rows for null and broken texts."""

    def eval(self, boxes: str):
        yield from _rows(boxes)


def register(spark: SparkSession) -> None:
    """The functions under their SQL names: SELECT t.id, d.* FROM t, LATERAL detections(t.boxes) d."""
    spark.udtf.register("detections", Detections)
