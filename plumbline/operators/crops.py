"""Crops of boxes out of images, handed to a provider: pixels are cut inside the tasks that read them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..sources.providers import Provider
from .geometry import bgr_of


def cut(image: np.ndarray, box: list[float], pad: float = 0.25) -> np.ndarray:
    """The part of an image (rows, columns, channels) in a box [x, y, w, h] in shares of it, widened by `pad` of the box on all sides.

    Corners are held within the image and rounded to pixels, halves to the even one. The whole image where nothing is left.
    """
    height, width = image.shape[:2]
    x, y, w, h = box
    x0, x1 = max(0.0, x - w * pad) * width, min(1.0, x + w + w * pad) * width
    y0, y1 = max(0.0, y - h * pad) * height, min(1.0, y + h + h * pad) * height
    if x1 <= x0 or y1 <= y0:
        return image
    return image[round(y0) : round(y1), round(x0) : round(x1)]


def faces(images: DataFrame, found: DataFrame, provider: Provider, boxes: str = "face_boxes", pad: float = 0.25, least: float | None = None, batch: int = 64) -> DataFrame:
    """A row for each box: id, face_idx, box as text, the provider's columns, revision, error.

    images: (id, image) of Spark's image source; found: (id, boxes as 'x,y,w,h|...'), broken parts left out. face_idx is the place in the
    text, from 0. The provider gets frames with a column `image` of RGB arrays. With `least`, a label whose score is
    below it is `uncertain`. Images without boxes and boxes without an image give no rows; an image that can't be decoded, or a crop that
    the provider fails on, gives rows with an error. Only one image's crops and one batch are held at a time.
    """
    names = [c.strip().split()[0] for c in provider.output.split(", ")]

    def one(crops: list[np.ndarray]) -> pd.DataFrame:
        out = provider.infer(pd.DataFrame({"image": pd.Series(crops, dtype=object)}))[names].reset_index(drop=True)
        return out.assign(error=None)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                texts = [",".join(f"{v:.4f}" for v in b) for b in r.boxes]
                image = bgr_of(r.height, r.width, r.nChannels, r.data)[:, :, ::-1] if r.height > 0 and r.width > 0 and r.nChannels in (1, 3, 4) else None
                for at in range(0, len(texts), batch):
                    part = r.boxes[at : at + batch]
                    if image is None:
                        out = pd.DataFrame({n: [None] * len(part) for n in names}).assign(error="not an image")
                    else:
                        crops = [cut(image, b, pad) for b in part]
                        try:
                            out = one(crops)
                        except Exception:  # find the crops that fail
                            out = []
                            for crop in crops:
                                try:
                                    out.append(one([crop]))
                                except Exception as e:
                                    out.append(pd.DataFrame({n: [None] for n in names}).assign(error=str(e)[:200]))
                            out = pd.concat(out, ignore_index=True)
                    out.insert(0, "box", texts[at : at + batch])
                    out.insert(0, "face_idx", range(at, at + len(part)))
                    out.insert(0, "id", r.id)
                    yield out.assign(revision=provider.revision)[["id", "face_idx", "box", *names, "revision", "error"]]

    listed = found.select("id", B.parse_delimited(F.col(boxes)).alias("boxes")).where(F.size("boxes") > 0)
    pixels = images.select("id", "image.height", "image.width", "image.nChannels", "image.data").join(listed, "id")
    out = pixels.mapInPandas(run, f"id string, face_idx int, box string, {provider.output}, revision string, error string")
    return out if least is None else out.withColumn("label", F.when(F.col("score") < least, "uncertain").otherwise(F.col("label")))
