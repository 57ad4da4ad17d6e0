"""Colour expressions over r, g, b columns in [0, 1], JVM-side: CIELAB, HSV, hex, hue bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# sRGB (D65) primaries to XYZ and back, white point, and the CIELAB breakpoints.
TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
FROM_XYZ = ((3.2404542, -1.5371385, -0.4985314), (-0.9692660, 1.8760108, 0.0415560), (0.0556434, -0.2040259, 1.0572252))
WHITE = (0.95047, 1.0, 1.08883)
EPSILON, KAPPA, SHIFT = 0.008856, 7.787, 16 / 116
#: Hue families in degrees, lower end in, upper end out; a band may wrap around.
BANDS = {"red": (345, 15), "warm": (15, 70), "green": (70, 170), "blue": (170, 260), "purple": (260, 345)}


def _linear(c: Column) -> Column:
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def lab(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    rgb = [_linear(c) for c in (r, g, b)]
    f = []
    for row, white in zip(TO_XYZ, WHITE, strict=True):
        t = sum((c * w for c, w in zip(rgb[1:], row[1:], strict=True)), rgb[0] * row[0]) / white
        f.append(F.when(t > EPSILON, F.cbrt(t)).otherwise(t * KAPPA + SHIFT))
    return f[1] * 116 - 16, (f[0] - f[1]) * 500, (f[1] - f[2]) * 200


def hsv(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Hue in degrees; where channels tie, blue decides over green and green over red."""
    most, least = F.greatest(r, g, b), F.least(r, g, b)
    d = most - least
    safe = F.when(d > 1e-9, d)
    hue = (
        F.when(d <= 1e-9, F.lit(0.0))
        .when(most == b, (r - g) / safe * 60 + 240)
        .when(most == g, (b - r) / safe * 60 + 120)
        .otherwise(F.pmod((g - b) / safe * 60, F.lit(360.0)))
    )
    return hue, F.when(most > 1e-9, d / F.greatest(most, F.lit(1e-9))).otherwise(0.0), most


def hex_of_lab(l: Column, a: Column, b: Column) -> Column:  # noqa: E741
    """'#rrggbb', each channel clipped and cut, not rounded."""
    fy = (l + 16) / 116
    back = lambda t: F.when(F.pow(t, F.lit(3.0)) > EPSILON, F.pow(t, F.lit(3.0))).otherwise((t - SHIFT) / KAPPA)
    xyz = [back(t) * w for t, w in zip((fy + a / 500, fy, fy - b / 200), WHITE, strict=True)]
    parts = []
    for row in FROM_XYZ:
        c = sum((x * w for x, w in zip(xyz[1:], row[1:], strict=True)), xyz[0] * row[0])
        c = F.when(c <= 0.0031308, c * 12.92).otherwise(F.pow(F.greatest(c, F.lit(0.0)), F.lit(1 / 2.4)) * 1.055 - 0.055)
        parts.append(F.lpad(F.lower(F.hex(F.floor(F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)) * 255).cast("bigint"))), 2, "0"))
    return F.concat(F.lit("#"), *parts)


def in_band(hue: Column, lo: float, hi: float) -> Column:
    return ((hue >= lo) | (hue < hi)) if lo > hi else ((hue >= lo) & (hue < hi))


def blood_red(hue: Column, saturation: Column, value: Column) -> Column:
    """Both ends of the hue range count."""
    return ((hue >= 345) | (hue <= 15)) & (saturation > 0.4) & (value > 0.15)


def colour_metrics(pixels, key: str):
    """Pixels (key, r, g, b in [0, 1]) to one row of colour metrics for each key; one shuffle of partial sums."""
    l, _, _ = lab(F.col("r"), F.col("g"), F.col("b"))  # noqa: E741
    h, s, v = hsv(F.col("r"), F.col("g"), F.col("b"))
    rows = pixels.select(key, l.alias("l"), h.alias("h"), s.alias("s"), v.alias("v"))
    grey = (F.col("v") < 0.12) | (F.col("l") < 15) | (F.col("s") < 0.15)
    share = lambda c, places=4: F.round(F.avg(c.cast("double")), places)
    bands = [share(in_band(F.col("h"), lo, hi) & ~grey).alias(f"band_{name}") for name, (lo, hi) in BANDS.items()]
    return rows.groupBy(key).agg(
        F.round(F.avg("l"), 2).alias("brightness"),
        share(F.col("l") < 20).alias("dark_share"),
        F.round(F.avg("s"), 4).alias("saturation"),
        share(blood_red(F.col("h"), F.col("s"), F.col("v"))).alias("red_share"),
        *bands,
        share(grey).alias("band_dark"),
    )
