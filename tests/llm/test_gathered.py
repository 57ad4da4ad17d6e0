"""What comes out of a shuffle of many partitions is gathered without mixing groups or losing rows."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm._spark import components, gathered, written


@pytest.fixture
def many_partitions(spark):
    most = 32 * spark.sparkContext.defaultParallelism
    mine = {"spark.sql.shuffle.partitions": str(most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in mine}
    for k, v in mine.items():
        spark.conf.set(k, v)
    yield most
    for k, v in before.items():
        spark.conf.set(k, v)


def _misplaced(batches):
    """Keys that come back after another one, and values out of order within a key."""
    seen, last, bad, rows = set(), None, 0, 0
    for batch in batches:
        for k, v in zip(batch.column("k").to_pylist(), batch.column("v").to_pylist(), strict=True):
            if last is None or k != last[0]:
                bad += k in seen
                seen.add(k)
            else:
                bad += v < last[1]
            last, rows = (k, v), rows + 1
    yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([bad])], ["rows", "bad"])


def test_groups_stay_whole_and_in_order(spark, many_partitions):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 997).alias("k"), F.xxhash64("id").alias("v"))
    dealt = rows.repartition("k").sortWithinPartitions("k", "v")
    for share in (4, 8):
        fewer = gathered(dealt, share)
        assert fewer.rdd.getNumPartitions() == many_partitions // share
        found = fewer.mapInArrow(_misplaced, "rows long, bad long").collect()
        assert sum(r.rows for r in found) == 20_000
        assert all(r.bad == 0 for r in found)


def test_few_partitions_and_empty_tables_stay(spark):
    few = spark.range(10).repartition(2)
    assert gathered(few).rdd.getNumPartitions() == 2
    assert written(spark.range(0), "none", light=True).count() == 0


def test_components_over_many_partitions(spark, many_partitions):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 140)] + [(0, rng.randrange(200, 260)) for _ in range(60)] + [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(90)]
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = components(spark.createDataFrame(links, "a long, b long"))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {(r.id, r.root) for r in found.collect()} == {(x, root(x)) for x in linked}
