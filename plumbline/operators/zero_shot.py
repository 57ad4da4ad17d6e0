"""Zero-shot scoring of cached embeddings against prototypes: labels, axes, classes and their validation.

The bank of prototypes is one row of bounded size (see vectors.bank) next to each embedding, so scoring is a map over
the embeddings: no shuffle, no explosion into items x labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import vectors as V

TEMPERATURE = 100.0


def with_bank(items: DataFrame, protos: DataFrame) -> DataFrame:
    return items.crossJoin(F.broadcast(V.bank(protos)))  # one row


def census(items: DataFrame, protos: DataFrame, key: str, vec: str, least: float = 0.5, temperature: float = TEMPERATURE) -> DataFrame:
    """(key, label, score): the most similar label, `uncertain` where its softmax, rounded to three places, is below least."""
    sims = with_bank(items, protos).select(key, V.similarities(F.col(vec), F.col("bank")).alias("sims"))
    score = F.round(V.softmax_of_best(F.col("sims"), temperature), 3)
    best = V.best(F.col("sims"))["label"].cast("string")
    return sims.select(key, L.relabel(best, score, least).alias("label"), score.alias("score"))


def flags(label: Column, animals: list[str]) -> list[Column]:
    """is_animal and is_creature of a label, after it was downgraded."""
    return [L.within(label, animals).alias("is_animal"), (~label.isin("none", "uncertain")).alias("is_creature")]


def classify(items: DataFrame, protos: DataFrame, key: str, vec: str, truth: str | None = None) -> DataFrame:
    """(key, pred, sim_<label>..., and with a truth column true_label and agree). A missing truth never agrees."""
    names = [r["label"] for r in protos.select("label").orderBy("label").limit(V.MOST + 1).collect()]  # a configuration table
    if len(names) > V.MOST:
        raise ValueError(f"more than {V.MOST} prototypes")
    rows = with_bank(items, protos).withColumn("sims", V.similarities(F.col(vec), F.col("bank")))

    def sim(name) -> Column:
        return F.round(F.get(F.filter("sims", lambda s: s["label"] == name), 0)["sim"], 4).alias(f"sim_{name}")

    sims = [sim(n) for n in names]
    pred = V.best(F.col("sims"))["label"]
    out = [F.col(key), pred.alias("pred"), *sims]
    if truth:
        out += [F.col(truth).alias("true_label"), F.coalesce(pred == F.col(truth), F.lit(False)).alias("agree")]
    return rows.select(*out)


def axis(items: DataFrame, protos: DataFrame, key: str, vec: str, high, low) -> DataFrame:
    """(key, axis): vec . (high - low), one product with the difference of two prototypes."""
    pole = lambda name, c: protos.where(F.col("label") == name).select(F.col("proto").alias(c))
    poles = pole(high, "__high").crossJoin(pole(low, "__low")).select(V.subtract(F.col("__high"), F.col("__low")).alias("__axis"))
    return items.crossJoin(F.broadcast(poles)).select(key, V.dot(F.col(vec), F.col("__axis")).alias("axis"))


def two_way(items: DataFrame, protos: DataFrame, key: str, vec: str, a, b) -> DataFrame:
    """(key, p, flag): probability of a against b; the flag compares before rounding."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("axis") * TEMPERATURE))
    return axis(items, protos, key, vec, a, b).select(key, F.round(p, 4).alias("p"), (p > 0.5).alias("flag"))


def per_face(faces: DataFrame, protos: DataFrame, key: str, vec: str, least: float = 0.35) -> DataFrame:
    """Like census, for child rows; the raw score is compared with the threshold."""
    sims = with_bank(faces, protos).withColumn("sims", V.similarities(F.col(vec), F.col("bank")))
    score = V.softmax_of_best(F.col("sims"), TEMPERATURE)
    return sims.select(key, F.when(score >= least, V.best(F.col("sims"))["label"].cast("string")).alias("label"), F.round(score, 3).alias("score"))


def with_metadata(scored: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Inner join: rows without metadata go, repeated ids fan out."""
    return scored.join(meta, key)


def validate_sets(scored: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, label, ok) for expected (key, labels array); `uncertain` passes where none is expected."""
    ok = F.array_contains("labels", F.col("label")) | ((F.col("label") == "uncertain") & F.array_contains("labels", F.lit("none")))
    return scored.join(expected, key).select(key, "label", ok.alias("ok"))


def validate_rank(scored: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """One row: correlation of the axis with the expected rank; null for fewer than two distinct values."""
    pair = scored.join(expected, key)
    able = (F.count_distinct("axis") >= 2) & (F.count_distinct("rank") >= 2)
    return pair.agg(F.when(able, F.corr("axis", "rank")).alias("correlation"))


def validate_count(scored: DataFrame, expected: DataFrame, key: str, tolerance: int = 1) -> DataFrame:
    return scored.join(expected, key).select(key, "n", "expected", (F.abs(F.col("n") - F.col("expected")) <= tolerance).alias("ok"))
