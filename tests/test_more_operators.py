"""Component trees, crops, weighted draws, patterns of opinions and bitmaps: against plain Python."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from plumbline.operators import crops, evaluate, palette
from plumbline.operators import geometry as G
from plumbline.sources import bitmaps, tables

# ---- component tree ----


def thresholded(grey):
    """Boxes by thresholds at all levels."""
    height, width = grey.shape
    found = set()
    for tone in (grey.astype(int), 255 - grey.astype(int)):
        for level in range(256):
            mask = tone <= level
            if not mask.any() or mask.all():
                continue
            label, n = G.components(mask)
            box, area = G.boxes_of(label, n)
            wide, n_wide = G.components(tone <= level + G.STEP)
            parent = np.zeros(n, int)
            parent[label[mask]] = wide[mask]
            grown = np.bincount(wide[wide >= 0], minlength=n_wide)[parent]
            core = np.bincount(label[mask & (tone <= level - G.STEP)], minlength=n)
            w, h = box[:, 2] - box[:, 0], box[:, 3] - box[:, 1]
            fit = (area >= G.REGION[0]) & (area <= G.REGION[1]) & (grown - core < G.CHANGE * area) & (w / np.maximum(h, 1) > 0.1) & (w / np.maximum(h, 1) < 12)
            found |= set(map(tuple, box[fit & (h >= 4) & (h <= height * 0.12) & (w < width * 0.9)].tolist()))
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_regions_are_those_of_all_thresholds(seed):
    rng = np.random.default_rng(seed)
    grey = rng.normal(128, 3 + 10 * (seed % 2), (90, 60))
    for _ in range(25):
        y, x, h, w = rng.integers(0, 80), rng.integers(0, 50), rng.integers(3, 10), rng.integers(3, 9)
        grey[y : y + h, x : x + w] += rng.choice([-100, -60, -20, 20, 60, 100])
    grey = np.clip(grey, 0, 255).round().astype(np.uint8)
    assert [tuple(b) for b in G.text_boxes(grey).tolist()] == thresholded(grey)
    assert seed or len(thresholded(grey)) > 5


def test_regions_of_flat_and_tiny_pictures():
    for grey in (np.zeros((5, 5)), np.full((1, 1), 255), np.arange(256).reshape(16, 16)):
        assert [tuple(b) for b in G.text_boxes(grey.astype(np.uint8)).tolist()] == thresholded(grey)


# ---- crops ----


class Sizes:
    name, revision, output = "sizes", "7", "label string, score double, width int, height int"

    def infer(self, batch: pd.DataFrame) -> pd.DataFrame:
        if any(i.shape[1] == 13 for i in batch["image"]):
            raise RuntimeError("thirteen")
        return pd.DataFrame([{"label": f"red {int(i[..., 0].mean())}", "score": i.shape[1] / 100, "width": i.shape[1], "height": i.shape[0]} for i in batch["image"]])


def test_cut():
    image = np.arange(40 * 80 * 3).reshape(40, 80, 3)
    assert crops.cut(image, [0.25, 0.25, 0.5, 0.5], 0).shape == (20, 40, 3)
    assert crops.cut(image, [0.25, 0.25, 0.5, 0.5]).shape == (30, 60, 3)
    assert crops.cut(image, [-1.0, 0.0, 0.1, 0.1]) is image  # nothing of it is left
    assert crops.cut(image, [0.9, 0.9, 0.5, 0.5]).shape == (9, 18, 3)  # corners at 0.775, held at 1
    assert (crops.cut(image, [0.5, 0.5, 0.5, 0.5], 0) == image[20:, 40:]).all()


def test_faces(spark):
    image = np.zeros((40, 80, 3), np.uint8)
    image[:, :40, 2] = 200  # blue, green, red: the left half is red
    kind = "id string, image struct<height:int,width:int,nChannels:int,data:binary>"
    images = spark.createDataFrame([("a", (40, 80, 3, bytearray(image.tobytes()))), ("b", (-1, -1, -1, bytearray())), ("c", (40, 80, 3, bytearray(image.tobytes())))], kind)
    found = spark.createDataFrame([("a", "0,0,0.5,1|broken|0.5,0,0.5,1|0,0,0.1625,1"), ("b", "0,0,1,1"), ("c", ""), ("d", "0,0,1,1")], "id string, face_boxes string")
    rows = crops.faces(images, found, Sizes(), pad=0.0, least=0.4, batch=2).orderBy("id", "face_idx").collect()
    got = [(r.id, r.face_idx, r.box, r.label, r.width, r.error) for r in rows]
    assert got == [
        ("a", 0, "0.0000,0.0000,0.5000,1.0000", "red 200", 40, None), ("a", 1, "0.5000,0.0000,0.5000,1.0000", "red 0", 40, None),
        ("a", 2, "0.0000,0.0000,0.1625,1.0000", None, None, "thirteen"), ("b", 0, "0.0000,0.0000,1.0000,1.0000", None, None, "not an image"),
    ]
    assert {r.revision for r in rows} == {"7"}
    assert {r.label for r in crops.faces(images, found, Sizes(), pad=0.0, least=0.5).where("error is null").collect()} == {"uncertain"}


# ---- draws ----


def test_draws_against_a_plain_wheel(spark):
    r = random.Random(3)
    rows = [(k, r.choice([0.5, r.random()]), round(r.random(), 1), r.choice([0.0, 1.0, 2.5, None, 0.25])) for k in [1] * 300 + [2] * 20 + [3]] + [(4, 0.1, 0.1, 0.0)]
    for most in (50, 4000):
        got = {(x.k, x.a, x.b): x.times for x in palette.draws(spark.createDataFrame(rows, "k int, a double, b double, w double"), "k", ["a", "b"], "w", most).collect()}
        want = Counter()
        for k in {x[0] for x in rows}:
            weight, n = Counter(), 0
            for _, a, b, w in (x for x in rows if x[0] == k and x[3] and x[3] > 0):
                weight[a, b] += int(w * 1_000_000)
                n += 1
            line = sorted(weight)
            edges, total = np.cumsum([weight[x] for x in line]), weight.total()
            for j in range(min(n, most)):
                place = int(int(hashlib.md5(f"42|{k}|{j}".encode()).hexdigest()[:8], 16) / 4294967296.0 * total)
                want[(k, *line[int(np.searchsorted(edges, place, "right"))])] += 1
        assert got == want


# ---- opinions ----


def test_combinations_of_eight_engines(spark):
    r = random.Random(4)
    names = [f"e{i}" for i in range(8)]
    rows = [(*[r.choice([True, False, None, True]) for _ in names], r.choice([True, False, None])) for _ in range(400)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} boolean" for n in names) + ", truth boolean")
    got = {(x.engines, x.rule): (x.n, x.tp, x.fp, x.fn, x.tn) for x in evaluate.combination_scores(frame, names, "truth").collect()}
    want = {}
    for k in range(2, 9):
        for subset in combinations(range(8), k):
            seen = [([x[i] for i in subset], x[8]) for x in rows if x[8] is not None and all(x[i] is not None for i in subset)]
            for rule, how in (("any", any), ("all", all)):
                c = Counter((how(v), t) for v, t in seen)
                if seen:
                    want["+".join(names[i] for i in subset), rule] = (len(seen), c[True, True], c[True, False], c[False, True], c[False, False])
    assert got == want


# ---- bitmaps ----


@pytest.mark.parametrize("most", [bitmaps.MOST, 2])
def test_wanted_is_the_semi_join(spark, most):
    r = random.Random(5)
    numbers = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 10**9, -1, -32768, None] + [r.randint(-200_000, 200_000) for _ in range(500)]
    ids = [r.choice(numbers) for _ in range(200)] + [None, 10**12]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, n long")
    got = bitmaps.wanted(rows, spark.createDataFrame([(x,) for x in ids], "w long"), "n", "w", most)
    assert sorted(x.i for x in got.collect()) == [i for i, n in enumerate(numbers) if n is not None and n in ids]
    assert got.columns == ["i", "n"]
    assert bitmaps.wanted(rows, spark.createDataFrame([], "w long"), "n", "w").count() == 0


def test_titles_of_odd_keys(spark, tmp_path):
    (tmp_path / "b.tsv").write_text("tconst\tgenres\ntt1\ta\ntt01\tb\nx\tc\ntt2\td\ny\te\n")
    wanted = spark.createDataFrame([("tt01",), ("x",), ("tt3",), (None,)], "tconst string")
    assert sorted(r.genres for r in tables.wanted_titles(spark, f"{tmp_path}/b.tsv", wanted).collect()) == ["b", "c"]
