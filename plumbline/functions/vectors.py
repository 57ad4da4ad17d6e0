"""Vector expressions over array columns, JVM-side: products, norms, prototypes, softmax and argmax."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product, accumulated in double precision from left to right."""
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(vec: Column) -> Column:
    return F.sqrt(dot(vec, vec))


def normalized(vec: Column) -> Column:
    """vec / |vec|; null for a zero vector."""
    n = norm(vec)
    return F.when(n > 0, F.transform(doubles(vec), lambda x: x / n))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(doubles(a), doubles(b), lambda x, y: x - y)


def prototypes(examples: DataFrame, label: str, vec: str) -> DataFrame:
    """(label, proto): each label's mean of unit vectors, normalized again. Partial sums per label and place come first."""
    unit = examples.select(F.col(label).alias("label"), F.posexplode(normalized(F.col(vec))).alias("place", "x"))
    mean = unit.groupBy("label", "place").agg(F.avg("x").alias("x"))
    whole = mean.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda e: e["x"]).alias("mean"))
    return whole.select("label", normalized(F.col("mean")).alias("proto"))


#: Labels of a prompt bank at most: it is a configuration table.
MOST = 4096


def bank(protos: DataFrame, most: int = MOST) -> DataFrame:
    """All prototypes as one row with one array `bank` of (label, ordinal, proto), for a broadcast.

    A prompt bank is a configuration table; one of more than `most` labels is refused rather than broadcast.
    """
    rows = protos.groupBy().agg(F.array_sort(F.collect_list(F.struct("label", "proto"))).alias("all"))
    within = F.assert_true(F.size("all") <= most, F.lit(f"more than {most} prototypes"))
    entry = lambda e, i: F.struct(e["label"].alias("label"), i.alias("ordinal"), e["proto"].alias("proto"))
    return rows.where(within.isNull()).select(F.transform("all", entry).alias("bank"))


def similarities(vec: Column, bank_: Column) -> Column:
    """Array of (sim, ordinal, label) over a bank."""
    return F.transform(bank_, lambda p: F.struct(dot(vec, p["proto"]).alias("sim"), p["ordinal"].alias("ordinal"), p["label"].alias("label")))


def best(sims: Column) -> Column:
    """The most similar entry; of ties the first in the bank."""
    return F.array_max(F.transform(sims, lambda s: F.struct(s["sim"].alias("sim"), (-s["ordinal"]).alias("minus"), s["label"].alias("label"))))


def softmax_of_best(sims: Column, temperature: float) -> Column:
    """Probability of the largest similarity under a softmax at this temperature."""
    top = F.array_max(F.transform(sims, lambda s: s["sim"]))
    total = F.aggregate(F.transform(sims, lambda s: F.exp((s["sim"] - top) * temperature)), F.lit(0.0), lambda a, x: a + x)
    return F.lit(1.0) / total


def two_way(a: Column, b: Column, temperature: float = 100.0) -> Column:
    """Softmax over two similarities: the probability of a."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp((b - a) * temperature))


def affine(vec: Column, weights: list[float], bias: float) -> Column:
    """A linear head; layers without activations collapse into one, see collapse()."""
    return dot(vec, F.array(*[F.lit(float(w)) for w in weights])) + F.lit(float(bias))


def collapse(layers: list[tuple[list[list[float]], list[float]]]) -> tuple[list[float], float]:
    """(weights, bias) of a stack of linear layers with one output and nothing between them."""
    import numpy as np

    weights, bias = None, None
    for w, b in layers:
        w, b = np.asarray(w, float), np.asarray(b, float)
        weights, bias = (w, b) if weights is None else (w @ weights, w @ bias + b)
    if weights is None or weights.shape[0] != 1:
        raise ValueError("the last layer must have one output")
    return weights[0].tolist(), float(bias[0])
