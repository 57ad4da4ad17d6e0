"""Palettes: weighted k-means for each key, in groups of bounded size.

Each key's rows are drawn with replacement by their weights, at most SAMPLE draws, so a group is bounded before it is
collected. Clusters start from a seed of the key itself: results don't depend on order, sharding or earlier keys.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.order import running

SAMPLE = 4000
CLUSTERS = 5


def lloyd(x: np.ndarray, k: int, seed: int, starts: int = 4, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(centres, counts) of the best of several starts, largest cluster first."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    best = (np.inf, None, None)
    for _ in range(starts):
        centres = distinct[rng.choice(len(distinct), k, replace=False)].astype(float)
        for _ in range(rounds):
            near = np.argmin(((x[:, None, :] - centres[None]) ** 2).sum(2), axis=1)
            counts = np.bincount(near, minlength=k)
            sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], 1)
            moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
            if np.allclose(moved, centres):
                break
            centres = moved
        cost = float(((x - centres[near]) ** 2).sum())
        if cost < best[0]:
            best = (cost, centres, counts)
    order = np.argsort(-best[2], kind="stable")
    return best[1][order], best[2][order]


def draws(rows: DataFrame, key: str, features: list[str], weight: str, most: int = SAMPLE, seed: int = 42) -> DataFrame:
    """(key, features, times): as many draws with replacement from each key's rows as it has rows, at most `most`; likelier with more weight.

    Weights are taken in millionths and rows with equal features as one. In the order of the features each takes its
    stretch of the key's running weight; draw j is the place that md5(seed|key|j) gives on it. The running weights come from ranges of
    rows, and the line of each key is cut into `most` cells, in which draws meet stretches: no task holds a key. Rows
    without positive weight are never drawn, nor are those of a null key.
    """
    whole = F.floor(F.col(weight) * 1_000_000).cast("bigint")
    some = rows.where(whole > 0).groupBy(key, *features).agg(F.sum(whole).alias("__w"), F.count(F.lit(1)).alias("__c"))
    placed = running(some, [key, *features], F.col("__w"), "__begin")
    line = placed.groupBy(key).agg(F.min("__begin").alias("__from"), F.sum("__w").alias("__all"), F.least(F.sum("__c"), F.lit(most)).alias("__n"))
    cell = lambda at: F.expr(f"int(floor({at} / __all * {most}))")
    stretch = placed.join(line, key).withColumn("__begin", F.col("__begin") - F.col("__from")).withColumn("__end", F.col("__begin") + F.col("__w"))
    stretch = stretch.withColumn("__cell", F.explode(F.sequence(cell("__begin"), cell("(__end - 1)"))))
    number = line.select(key, "__all", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1)).alias("__j"))
    share = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.col("__j").cast("string"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    place = number.withColumn("__r", F.floor(share * F.col("__all")).cast("bigint"))
    place = place.select(F.col(key).alias("__key"), "__r", cell("__r").alias("__in"))
    met = stretch.join(place, (F.col(key) == F.col("__key")) & (F.col("__cell") == F.col("__in")) & (F.col("__begin") <= F.col("__r")) & (F.col("__r") < F.col("__end")))
    return met.groupBy(key, *features).agg(F.count(F.lit(1)).alias("times"))


def palettes(rows: DataFrame, key: str, features: list[str], weight: str, clusters: int = CLUSTERS, seed: int = 42) -> DataFrame:
    """(key, centres array<array<double>>, shares array<double>) of weighted draws with replacement, at most SAMPLE for each key."""
    kept = draws(rows, key, features, weight, SAMPLE, seed)

    def group(name: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(features)
        centres, counts = lloyd(np.repeat(f[features].to_numpy(float), f["times"].to_numpy(), axis=0), clusters, zlib.crc32(str(name[0]).encode()) ^ seed)
        return pd.DataFrame({key: [name[0]], "centres": [centres.round(4).tolist()], "shares": [(counts / counts.sum()).round(3).tolist()]})

    kind = rows.schema[key].dataType.simpleString()
    return kept.groupBy(key).applyInPandas(group, f"{key} {kind}, centres array<array<double>>, shares array<double>")
