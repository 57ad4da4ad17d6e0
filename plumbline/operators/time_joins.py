"""As-of and interval joins over time, by bucketed equi-joins and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """Each left row with the columns of the last right row of its key at or before its time; one shuffle of the union.

    right has the columns as r_<name>. Of right rows with one time the last by those columns counts.
    """
    kinds = dict(right.dtypes)
    a = left.withColumn("__side", F.lit(1)).withColumn("__right", F.lit(None).cast("struct<" + ",".join(f"{c}:{kinds[c]}" for c in columns) + ">"))
    missing = {c: F.lit(None).cast(t) for c, t in left.dtypes if c not in (key, ts)}
    b = right.select(key, ts, F.struct(*columns).alias("__right")).withColumns(missing).withColumn("__side", F.lit(0))
    w = Window.partitionBy(key).orderBy(ts, "__side", "__right").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("__seen", F.last("__right", ignorenulls=True).over(w))
    return both.where("__side = 1").select(*left.columns, *[F.col(f"__seen.{c}").alias(f"r_{c}") for c in columns])


def within(left: DataFrame, right: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """Pairs of one key with right.ts in (left.ts - seconds, left.ts]; times are bucketed, each right row goes to two buckets."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    bucket = lambda c: F.floor(micros(c) / F.lit(seconds * 1_000_000))
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns], bucket(ts).alias("__b"))
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns], F.explode(F.array(bucket(ts), bucket(ts) + 1)).alias("__b"))
    apart = micros(f"l_{ts}") - micros(f"r_{ts}")
    return a.join(b, (a[f"l_{key}"] == b[f"r_{key}"]) & (a["__b"] == b["__b"])).where((apart >= 0) & (apart < seconds * 1_000_000)).drop(a["__b"]).drop(b["__b"])
