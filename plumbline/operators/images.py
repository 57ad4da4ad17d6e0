"""From decoded images to colour metrics and palettes: pixels leave Python once, all else is columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import color
from . import palette
from .geometry import bgr_of, resized

#: What Spark's image source has decoded.
DECODED = "height > 0 and width > 0 and nChannels in (1, 3, 4)"
# The size to which images are brought before their pixels are counted.
WIDTH, HEIGHT = 96, 144


def pixels(images: DataFrame, width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    """Images (id, image) of Spark's image source to rows (id, r, g, b) in [0, 1], width * height for each; broken ones give none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                image = bgr_of(r.height, r.width, r.nChannels, r.data)
                b, g, red = (np.round(resized(image[:, :, c], height, width)).ravel() / 255 for c in range(3))
                yield pd.DataFrame({"id": r.id, "r": red, "g": g, "b": b})

    flat = images.select("id", "image.height", "image.width", "image.nChannels", "image.data").where(DECODED)
    return flat.mapInPandas(run, "id string, r double, g double, b double")


def colours(images: DataFrame) -> DataFrame:
    """One row for each image: its colour metrics, palette (hex, largest cluster first), palette_share and error.

    An image that can't be decoded has an error and nothing else. The palette is that of pixels drawn by 0.25 plus their saturation, so a large flat ground doesn't fill it.
    """
    dots = pixels(images)
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    lab = dots.select("id", *[c.alias(n) for n, c in zip("lxy", color.lab(r, g, b), strict=True)], (color.hsv(r, g, b)[1] + 0.25).alias("w"))
    hexes = F.transform("centres", lambda c: color.hex_of_lab(c[0], c[1], c[2]))
    drawn = palette.palettes(lab, "id", ["l", "x", "y"], "w").select("id", hexes.alias("palette"), F.col("shares").alias("palette_share"))
    whole = color.colour_metrics(dots, "id").join(drawn, "id", "left").withColumn("error", F.lit(None).cast("string"))
    flat = images.select("id", "image.height", "image.width", "image.nChannels")
    broken = flat.where(~F.coalesce(F.expr(DECODED), F.lit(False))).select("id", F.lit("not an image").alias("error"))
    return whole.unionByName(broken, allowMissingColumns=True)
