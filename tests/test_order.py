"""Order statistics by ranges and sketches: against numpy, with keys that are spread."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import order
from plumbline.operators import heatmap


@pytest.fixture(scope="module")
def rows():
    """A third of all rows belongs to one key; ties, nulls and NaN among the values; a null key."""
    r = random.Random(11)
    value = lambda: r.choice([r.random(), r.random(), round(r.random(), 1), 0.5, None, math.nan])
    return [(1, value()) for _ in range(4000)] + [(r.choice([2, 3, None, 4]), value()) for _ in range(8000)] + [(5, None), (6, 0.25)]


def by_key(rows):
    out = {}
    for k, v in rows:
        if v is not None and not math.isnan(v):
            out.setdefault(k, []).append(v)
    return {k: np.sort(v) for k, v in out.items()}


@pytest.mark.parametrize("margin", [2, -80])
def test_at_ranks(spark, rows, monkeypatch, margin):
    """Also where the brackets miss what is looked for, so that keys are counted whole."""
    monkeypatch.setattr(order, "MARGIN", margin)
    frame = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: (r.n, r["values"]) for r in order.at_ranks(frame, ["k"], "v", lambda n: [F.lit(0), F.floor(n / 2), n - 1, n + 5]).collect()}
    assert got == {k: (len(v), [v[0], v[len(v) // 2], v[-1], v[-1]]) for k, v in by_key(rows).items()}


def test_quantiles(spark, rows):
    frame = spark.createDataFrame(rows, "k int, v double")
    cuts = (0.0, 0.2, 0.95, 1.0)
    got = {r.k: r.edges for r in order.quantiles(frame, "v", cuts, ("k",)).collect()}
    for k, v in by_key(rows).items():
        assert got[k] == pytest.approx(np.quantile(v, cuts))
    whole = order.quantiles(frame, "v", cuts).first().edges
    assert whole == pytest.approx(np.quantile(np.concatenate(list(by_key(rows).values())), cuts))
    assert order.quantiles(frame.limit(0), "v", cuts).first().edges == []


def test_running(spark):
    r = random.Random(12)
    rows = [(r.choice([None, "a", "b", "Z", "é"]), r.randint(0, 5), i, r.randint(0, 9)) for i in range(500)]
    got = {x.i: x.before for x in order.running(spark.createDataFrame(rows, "s string, n int, i int, a int"), ["s", "n", "i"], F.col("a"), "before").collect()}
    total, want = 0, {}
    for s, n, i, a in sorted(rows, key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1], x[2])):
        want[i], total = total, total + a
    assert got == want


def test_large_maps_are_spread(spark):
    """The same summaries whether a map fits a task or is counted in parts."""
    r = random.Random(13)
    cells = [(k, y, x, r.choice([r.random(), 0.5, 1.0])) for k in (1, 2, 3) for y in range(30) for x in range(7 * k)] + [(4, 0, 0, 0.0), (5, 0, 0, 2.0), (5, 0, 1, 2.0)]
    frame = spark.createDataFrame(cells, "k int, y int, x int, value double")
    for of in (heatmap.depth_summary, lambda c, k, hot: heatmap.saliency_summary(c, k, F.lit(30), F.lit(21), hot=hot)):
        rows = [{r.k: tuple(r[c] for c in sorted(r.asDict())) for r in of(frame, "k", hot=hot).collect()} for hot in (10**6, 300, 0)]
        assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 5
