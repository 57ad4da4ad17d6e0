"""Expressions against hand-made values: boxes, labels, colours, vectors, poses, maps, registers."""

import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import boxes as B
from plumbline.functions import color as C
from plumbline.functions import labels as L
from plumbline.functions import ratios as R
from plumbline.functions import vectors as V
from plumbline.operators import evaluate, geometry, heatmap, palette, pose, registers


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def box(*v):
    return F.array(*[F.lit(float(x)) for x in v])


def det(label, score, *v):
    return F.struct(F.lit(label).alias("label"), F.lit(float(score)).alias("score"), box(*v).alias("box"))


def test_iou(spark):
    unit = box(0, 0, 1, 1)
    assert value(spark, B.iou(unit, unit)) == 1.0
    assert value(spark, B.iou(box(0, 0, 0.1, 0.1), box(0.5, 0.5, 0.1, 0.1))) == 0.0
    assert 0.1 < value(spark, B.iou(unit, box(0.5, 0.5, 1, 1))) < 0.5
    assert value(spark, B.iou(box(0, 0, 0, 1), unit)) == 0.0


def greedy(a, b, least):
    """The same rule, written over Python lists."""

    def iou(p, q):
        w = max(min(p[0] + p[2], q[0] + q[2]) - max(p[0], q[0]), 0)
        h = max(min(p[1] + p[3], q[1] + q[3]) - max(p[1], q[1]), 0)
        u = p[2] * p[3] + q[2] * q[3] - w * h
        return min(w * h / u, 1) if u > 0 else 0

    used, out = set(), []
    for k in sorted(range(len(a)), key=lambda k: -a[k][1]):
        best = max(((iou(a[k][2], q[2]), i) for i, q in enumerate(b) if i not in used and q[0] == a[k][0] and iou(a[k][2], q[2]) >= least), default=None)
        if best:
            used.add(best[1])
            out.append((k, best[1]))
    return out


def test_greedy_match_against_lists(spark):
    import random

    r = random.Random(4)
    cases = []
    for _ in range(150):
        side = lambda: [(r.choice("xy"), r.choice((0.5, 0.6)), [r.randint(0, 3) / 10, r.randint(0, 3) / 10, r.randint(1, 4) / 10, r.randint(1, 4) / 10]) for _ in range(r.randint(0, 3))]
        cases.append((side(), side()))
    kind = B.DETECTIONS
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], f"i int, a {kind}, b {kind}")
    got = {x["i"]: x["p"] for x in frame.select("i", B.greedy_match(F.col("a"), F.col("b"), 0.3).alias("p")).collect()}
    for i, (a, b) in enumerate(cases):
        want = greedy(a, b, 0.3)
        assert sorted((tuple(p["box_a"]), tuple(p["box_b"])) for p in got[i]) == sorted((tuple(a[k][2]), tuple(b[m][2])) for k, m in want)
        lesser = [min(p["score_a"], p["score_b"]) for p in got[i]]
        assert lesser == sorted(lesser, reverse=True)


def test_pairs_need_one_label_and_use_a_partner_once(spark):
    one, two = F.array(det("cat", 0.9, 0, 0, 0.5, 0.5), det("cat", 0.8, 0.01, 0, 0.5, 0.5)), F.array(det("cat", 0.4, 0, 0, 0.5, 0.5))
    p = value(spark, B.greedy_match(one, two))
    assert len(p) == 1 and p[0]["score_a"] == 0.9
    s = value(spark, B.pair_summary(B.greedy_match(one, two)))
    assert (s["n"], s["top_label"], s["top_score"]) == (1, "cat", 0.4)
    assert value(spark, B.greedy_match(F.array(det("dog", 0.9, 0, 0, 0.5, 0.5)), two)) == []
    for a, b, want in (("cat", "cat", 1), ("cat", "dog", 0), ("", "", 0), ("cat", "", 0)):
        assert value(spark, B.same_label(F.lit(a), F.lit(b))) == want


def test_box_parsing_and_filters(spark):
    assert value(spark, B.parse_delimited(F.lit("1,2,3,4|x,2,3,4|1,2|5,6,7,8"))) == [[1, 2, 3, 4], [5, 6, 7, 8]]
    assert value(spark, B.parse_delimited(F.lit(None).cast("string"))) == []
    for bad in ("", "nope", "{}", "[]", '[{"label": "a", "box": [1, 2]}]'):
        assert value(spark, B.parse_json(F.lit(bad))) == []
    assert value(spark, B.parse_json(F.lit('[{"label": "a", "box": [0.1, 0.2, 0.3, 0.4]}]')))[0]["score"] == 0.0
    every = F.array(det("a", 0.5, 0, 0, 0.1, 0.1), det("b", 0.1, 0, 0, 0.1, 0.1), det("c", 0.9, 0, 0, 0.01, 0.01), det("d", 0.9, 0, 0, 0.99, 0.99))
    assert [d["label"] for d in value(spark, B.plausible(every))] == ["a"]
    many = F.array(*[det(str(i), s, 0, 0, 0.1, 0.1) for i, s in enumerate((0.3, 0.9, 0.9, 0.5, 0.2))])
    assert [d["label"] for d in value(spark, B.top(many))] == ["1", "2", "3"]
    s = value(spark, B.summary(B.top(F.array().cast(B.DETECTIONS))))
    assert (s["n"], s["top_label"], s["top_score"], s["boxes"]) == (0, "", None, "[]")
    b = value(spark, B.from_corners(*[F.lit(float(x)) for x in (50, 80, 10, 20, 100, 100)]))
    assert b == [0.1, 0.2, 0.4, 0.6]
    crop = value(spark, B.padded_crop(box(0.9, 0.9, 0.2, 0.2), F.lit(100), F.lit(50)))
    assert (crop["x1"], crop["y1"]) == (100, 50)
    whole = value(spark, B.padded_crop(box(2, 2, 0, 0), F.lit(100), F.lit(50)))
    assert tuple(whole) == (0, 0, 100, 50)


def test_labels(spark):
    tags = F.lit("underwater:0.9|water:0.2")
    assert value(spark, L.confidence_of(tags, "water")) == 0.9
    assert value(spark, L.confidence_of(tags, "water", anchored=True)) == 0.2
    assert value(spark, L.confidence_of(tags, "fire")) == 0.0
    assert value(spark, L.confidence_of(F.lit(None).cast("string"), "fire")) is None
    for given, want in (("0.5", 0.5), ("7", 1.0), ("-1", 0.0), ("x", 0.0), ("", 0.0), (None, 0.0)):
        assert value(spark, L.score01(F.lit(given).cast("string"))) == want
    for given, want in (("2.9", 2), ("-3", 0), ("x", 0), (None, 0)):
        assert value(spark, L.whole_count(F.lit(given).cast("string"))) == want
    assert value(spark, L.enumerated(F.lit(" Poster "), ["poster"])) == "poster"
    assert value(spark, L.enumerated(F.lit(None).cast("string"), ["poster"])) == "uncertain"
    assert value(spark, L.unfenced(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'
    assert value(spark, L.matched_phrase(F.lit("big black cat"), ["dog", "cat", "black cat"])) == "cat"
    assert value(spark, L.matched_phrase(F.lit("black cat"), ["dog", "cat", "black cat"])) == "black cat"
    assert value(spark, L.matched_phrase(F.lit(""), ["dog"])) is None
    assert value(spark, L.caption(F.array(F.lit(" A "), F.lit("b")))) == "a. b."
    assert value(spark, L.caption_lookup(F.array(F.lit(" A "), F.lit("b")))) == {"a": " A ", "b": "b"}
    assert value(spark, L.join_list(F.array(F.lit(" a"), F.lit(" "), F.lit("b")))) == "a|b"
    for given, want in (("uncertain", "none"), (" none ", "none"), ("vampire", "vampire"), ("", "")):
        assert value(spark, L.comparable(F.lit(given))) == want
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("conf")) for n, c in (("", "0.99"), ("Gun", "0.5"), ("Axe", "0.5"), ("Bad", "x"))])
    top = value(spark, L.top_entry(entries))
    assert (top["name"], top["conf"]) == ("Gun", 0.5)
    assert value(spark, L.encode_confidences(entries)) == "Gun:0.50|Axe:0.50|Bad:x"
    scored = F.transform(entries, lambda e: F.struct(e["name"].alias("name"), F.coalesce(e["conf"].try_cast("double"), F.lit(0.0)).alias("conf")))
    assert value(spark, L.vocabulary_max(scored, ["gun", "knife"])) == 0.5
    assert value(spark, L.vocabulary_max(scored, ["knife"])) == 0.0
    assert value(spark, L.relabel(F.lit("cat"), F.lit(0.4996), 0.5)) == "cat"  # rounds to 0.5
    assert value(spark, L.relabel(F.lit("cat"), F.lit(0.4996), 0.5, None)) == "uncertain"
    assert value(spark, L.year(F.lit("1984.0"))) == 1984 and value(spark, L.year(F.lit(""))) is None


def test_colours(spark):
    rgb = lambda r, g, b: [F.lit(x / 255) for x in (r, g, b)]
    assert abs(value(spark, C.lab(*rgb(0, 0, 0))[0])) < 1e-6
    assert abs(value(spark, C.lab(*rgb(255, 255, 255))[0]) - 100) < 1e-3
    for want, c in ((0, (255, 0, 0)), (120, (0, 255, 0)), (240, (0, 0, 255))):
        assert value(spark, C.hsv(*rgb(*c))[0]) == want
    assert value(spark, C.hsv(*rgb(90, 90, 90))[1]) == 0
    back = value(spark, C.hex_of_lab(*C.lab(*rgb(255, 0, 0))))
    assert int(back[1:3], 16) >= 253 and int(back[3:5], 16) <= 3 and int(back[5:7], 16) <= 3
    solid = spark.range(50).select(F.lit("p").alias("id"), *[x.alias(n) for n, x in zip("rgb", rgb(200, 20, 20), strict=True)])
    row = C.colour_metrics(solid, "id").first()
    assert row["red_share"] > 0.8 and abs(sum(row[c] for c in row.asDict() if c.startswith("band_")) - 1) < 1e-6


def test_vectors(spark):
    v = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    assert value(spark, V.dot(v(1, 0), V.subtract(v(1, 0), v(0, 1)))) > 0
    assert value(spark, V.normalized(v(0, 0))) is None
    protos = V.prototypes(spark.createDataFrame([("a", [3.0, 4.0]), ("a", [0.0, 5.0])], "label string, vec array<double>"), "label", "vec")
    assert abs(math.hypot(*protos.first()["proto"]) - 1) < 1e-9
    sims = F.array(*[F.struct(F.lit(float(s)).alias("sim"), F.lit(i).alias("ordinal"), F.lit(n).alias("label")) for i, (s, n) in enumerate(((0.9, "x"), (0.9, "y"), (0.1, "z")))])
    assert value(spark, V.best(sims))["label"] == "x"
    assert value(spark, V.softmax_of_best(F.slice(sims, 2, 2), 100.0)) > 0.99
    assert V.collapse([([[1, 0], [0, 1]], [1, 1]), ([[2, 3]], [4])]) == ([2.0, 3.0], 9.0)


def test_confusion(spark):
    def scores(*cells):
        data = [(v, t) for (v, t), n in zip(((True, True), (True, False), (False, True), (False, False)), cells, strict=True) for _ in range(n)]
        return spark.createDataFrame(data, "v boolean, t boolean").agg(*R.confusion(F.col("v"), F.col("t"))).first()

    assert tuple(scores(5, 0, 0, 5))[5:] == (1.0, 1.0, 1.0)
    assert scores(0, 5, 5, 0)["accuracy"] == 0.0
    assert scores(0, 0, 3, 7)["precision"] is None
    assert scores(1, 1, 0, 2)["accuracy"] == 0.75


def test_verdicts(spark):
    here, gone = F.lit(True), F.lit(False)
    s = lambda x: F.lit(x).cast("string")
    assert tuple(value(spark, evaluate.flag_verdict(s("True"), s("0.8"), here))) == (True, 0.8)
    assert value(spark, evaluate.flag_verdict(s("True"), s("0.8"), gone)) is None
    assert tuple(value(spark, evaluate.count_verdict(s("2"), s("0.55"), here))) == (True, 0.55)
    assert tuple(value(spark, evaluate.count_verdict(s("0"), s(""), here))) == (False, 0.0)
    assert value(spark, evaluate.count_verdict(s("many"), s("1"), here)) is None
    assert value(spark, evaluate.score_verdict(s(""), here)) is None
    assert tuple(value(spark, evaluate.tag_verdict(s("water:0.8|fire:0.3"), "fire", here))) == (False, 0.3)
    assert tuple(value(spark, evaluate.tag_verdict(s(None), "fire", here))) == (False, 0.0)
    assert [value(spark, evaluate.human_label(s(x))) for x in ("si", "no", "no_seguro", "", None)] == [True, False, None, None, None]


def test_pose(spark):
    points = [[50.0, 10.0, 0.9]] + [[60.0 if k % 2 else 40.0, 20.0 + k * 4, 0.9] for k in range(1, 17)]
    level = [p[:] for p in points]
    for a, b in pose.PAIRS:
        level[b][1] = level[a][1]
    raised = [p[:] for p in level]
    raised[9] = [90.0, 0.0, 0.9]
    weak = [[*p[:2], 0.1] for p in points]
    frame = spark.createDataFrame([(0, level), (1, raised), (2, weak)], "i int, k array<array<double>>")
    got = {r["i"]: r["s"] for r in frame.select("i", pose.summary(F.col("k"), box(0, 0, 100, 100)).alias("s")).collect()}
    assert got[0]["limb_asymmetry"] < 0.05 < got[1]["limb_asymmetry"]
    assert got[2]["limb_asymmetry"] is None and got[2]["kpt_bbox_area_frac"] is None and got[2]["mean_kpt_confidence"] == 0.1


def test_maps(spark):
    cells = [("hot", y, x, 1.0 if (y, x) == (3, 7) else 0.0) for y in range(10) for x in range(10)]
    cells += [("flat", y, x, 1.0) for y in range(10) for x in range(10)] + [("none", y, x, 0.0) for y in range(10) for x in range(10)]
    frame = spark.createDataFrame(cells, "id string, y int, x int, value double")
    got = {r["id"]: r for r in heatmap.saliency_summary(frame, "id", F.lit(10.0), F.lit(10.0)).collect()}
    assert (got["hot"]["peak_x"], got["hot"]["peak_y"], got["hot"]["top10pct_mass"]) == (0.7, 0.3, 1.0)
    assert abs(got["flat"]["top10pct_mass"] - 0.1) < 1e-9 and got["none"]["top10pct_mass"] == 0.0
    depth = {r["id"]: r for r in heatmap.depth_summary(frame, "id").collect()}
    assert depth["flat"]["mean_depth"] == 0.0


def test_registers(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(20)], "x double")
    got = [r["register"] for r in registers.registers(frame, "x").orderBy("x").collect()]
    assert got[0] == "minimal" and got[-1] == "ornate" and set(got) == set(registers.NAMES)
    assert value(spark, registers.distance(F.lit("minimal"), F.lit("unknown"))) is None


def test_geometry():
    import numpy as np

    flat = np.full((144, 96), 120, np.uint8)
    half = flat.copy()
    half[:, :48] = 0
    square = np.zeros((144, 96), np.uint8)
    square[52:92, 28:68] = 255
    assert geometry.composition(flat)["symmetry"] == 1 and geometry.composition(flat)["neg_space"] == 1
    assert geometry.composition(half)["symmetry"] < 0.9
    middle = geometry.composition(square)
    assert abs(middle["mass_x"] - 0.5) < 0.02 and abs(middle["mass_y"] - 0.5) < 0.02
    assert geometry.thirds_distance((0, 0, 2 / 3 * 96, 2 / 3 * 144), 96, 144) == pytest.approx(0, abs=1e-9)


def test_palette_is_stable(spark):
    import numpy as np

    r = np.random.default_rng(1)
    rows = [("k", *(c + r.normal(0, 0.01, 3)).tolist(), 1.0) for c in ([0, 0, 0], [1, 1, 1], [5, 5, 5]) for _ in range(40)]
    frame = spark.createDataFrame(rows, "id string, l double, a double, b double, w double")
    one = palette.palettes(frame, "id", ["l", "a", "b"], "w", clusters=3).first()
    two = palette.palettes(frame.repartition(3), "id", ["l", "a", "b"], "w", clusters=3).first()
    assert one == two and abs(sum(one["shares"]) - 1) < 0.01 and len(one["centres"]) == 3


def test_quantiles_and_positions(spark):
    import numpy as np

    from plumbline.functions import order

    r = np.random.default_rng(3)
    for values in ([1.0], [2.0, 1.0], [5.0] * 9 + [7.0], r.normal(size=5000).tolist(), r.integers(0, 6, 3000).astype(float).tolist()):
        frame = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
        got = order.quantiles(frame, "x", (0.0, 0.2, 0.5, 0.95, 1.0)).first()["edges"]
        assert got == pytest.approx(np.quantile(values, (0.0, 0.2, 0.5, 0.95, 1.0)).tolist())
    words = [f"w{int(k):04d}" for k in r.permutation(700)]
    frame = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "w string, k int")
    got = order.running(frame, ["w"], F.lit(1), "p").collect()
    assert {x["w"]: x["p"] for x in got} == {w: i for i, w in enumerate(sorted(words))}
