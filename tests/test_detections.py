"""Answers of unreliable shape, suppression of boxes: against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import boxes as B
from plumbline.functions import variants as V
from plumbline.operators import suppression
from plumbline.sources import responses


def overlap(a, b):
    w = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
    h = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    union = a[2] * a[3] + b[2] * b[3] - both
    return 0 if min(a[2], a[3], b[2], b[3]) <= 0 or union <= 0 else min(both / union, 1)


# ---- JSON ----


def naive_boxes(text):
    """Element by element; a broken one costs only itself."""
    try:
        rows = json.loads(text or "")
    except ValueError:
        return []
    out = []
    for r in rows if isinstance(rows, list) else []:
        if not isinstance(r, dict) or not isinstance(r.get("box"), list) or len(r["box"]) != 4:
            continue
        try:
            out.append((str(r.get("label", "")), float(r.get("score") or 0.0), [float(v) for v in r["box"]]))
        except (TypeError, ValueError):
            continue
    return out


def test_boxes_element_by_element(spark):
    r = random.Random(1)
    atoms = [1, 0, 0.25, "0.5", " 2 ", "high", "", None, True, False, [], {}, [1, 2], {"a": 1}, "1d"]
    texts = ["", "nope", "[1] x", "12", '"s"', '{"label": "a"}', "[", "[]", "null", '[{"box": [1, 2, 3, 4]}], 5', '[{"box": [1,2,3,4]},5,"x"]', None]
    for _ in range(400):
        rows = []
        for _ in range(r.randint(0, 5)):
            row = {"label": r.choice(["gun", 3, "é|:", "", None, True]), "score": r.choice(atoms), "box": r.choice([[r.choice([0.1, "0.2", 3, 4]) for _ in range(r.choice([4, 4, 4, 3]))], [r.choice(atoms) for _ in range(4)], "box", None])}
            rows.append(r.choice([{k: v for k, v in row.items() if r.random() < 0.9}] * 4 + atoms))
        texts.append(json.dumps(rows))
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {x.id: [(d.label, d.score, d.box) for d in x.d] for x in frame.select("id", B.parse_json(F.col("t")).alias("d")).collect()}
    assert got == {i: naive_boxes(t) for i, t in enumerate(texts)}


def test_scene_fields_cost_only_themselves(spark):
    texts = {
        1: {"mood": "calm", "labels": [{"name": "Axe", "conf": "0.5"}, 7, {"conf": 1}, "plain"], "weapon": "0.4", "face_count": "2.9"},
        2: {"mood": [" a ", "", None, 2], "labels": "as text", "weapon": [1], "monster": True, "face_count": -3, "poster_qa_verdict": " POSTER "},
        3: {"mood": 5, "fear_labels": [{"name": "Night", "confidence": 0.25}, {"name": "Fog", "conf": "low"}, {"name": "Mist", "conf": None}], "labels": {"a": 1}, "person": 7},
        4: {"mood": {}, "labels": [{"name": "x", "conf": "?"}, {"name": "y", "conf": 0}], "credits_text": 12, "description": "a\nb "},
    }
    rows = [(k, json.dumps(v)) for k, v in texts.items()] + [(5, "[1]"), (6, "sorry"), (7, "```json\n{}\n```"), (8, None)]
    got = {x.id: x.asDict() for x in responses.scene_service(spark.createDataFrame(rows, "id int, t string"), "t").collect()}
    want = {
        1: {"mood": "calm", "labels": "Axe:0.50|7|plain", "top_label": "Axe", "top_label_conf": 0.5, "weapon": 0.4, "face_count": 2},
        2: {"mood": "a|None|2", "labels": "as text", "top_label": "", "weapon": 0.0, "monster": 1.0, "face_count": 0, "qa_verdict": "poster"},
        3: {"mood": "5", "fear_labels": "Night:0.25|Fog:low|Mist:None", "labels": "", "person": 1.0, "qa_verdict": "uncertain"},
        4: {"mood": "", "labels": "x:?|y:0.00", "top_label": "x", "top_label_conf": 0.0, "credits_text": "12", "description": "a b"},
    }
    for k, v in want.items():
        assert {c: got[k][c] for c in v} == v and got[k]["error"] is None
    assert [got[k]["error"] is None for k in (5, 6, 7, 8)] == [False, False, True, False]


def test_variant_kinds(spark):
    values = ["null", "true", "0", "0.0", '""', '"0"', "[]", "{}", "[0]", '{"a": 0}', "12", '" 1e2 "', '"nan"', '"x"']
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, t string").withColumn("v", V.parsed(F.col("t")))
    got = {r.t: tuple(r)[2:] for r in frame.select("id", "t", V.empty(F.col("v")), V.number(F.col("v")), V.text(F.col("v"))).collect()}
    for t in values:
        v = json.loads(t)
        assert got[t][0] == (not v), t
        assert got[t][2] == (json.dumps(v).replace(" ", "") if isinstance(v, (list, dict)) else "0" if v == 0 and v is not False else str(v)), t
    assert [got[t][1] for t in ("true", '"0"', '" 1e2 "', '"nan"', "[0]", "null")] == [1.0, 0.0, 100.0, None, None, None]


# ---- suppression ----


def naive_kept(rows, least, most, best):
    out = []
    for key in {r[0] for r in rows}:
        some = sorted([r for r in rows if r[0] == key and r[2] is not None and r[2] >= least and r[3] is not None and len(r[3]) == 4 and all(v is not None and abs(v) < 1e300 for v in r[3])], key=lambda r: (-r[2], r[3]))[:best]
        kept = []
        for place, r in enumerate(some, 1):
            if all(overlap(r[3], k[1]) <= most for k in kept):
                kept.append((place, r[3]))
        out += [(key, p, tuple(b)) for p, b in kept]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("most", "best"), [(0.3, 5000), (0.3, 12), (0.05, 5000), (0.9, 5000)])
def test_suppression_against_all_pairs(spark, most, best):
    """Boxes of very different sizes, off the picture, without area, null, repeated; null keys."""
    r = random.Random(7)
    rows = []
    for i in range(700):
        side = 2.0 ** r.uniform(-9, 1)
        box = [r.uniform(-0.5, 1), r.uniform(-0.5, 1), side * r.uniform(0.2, 1), side * r.uniform(0.2, 1)]
        if rows and r.random() < 0.3 and rows[-1][3] and len(rows[-1][3]) == 4:
            box = [(v or 0) + r.uniform(-0.02, 0.02) * side for v in rows[-1][3]]
        box = r.choice([box] * 12 + [None, [1.0], [0.1, 0.1, 0.0, 0.2], [0.1, None, 0.2, 0.2], [0.1, 0.1, float("inf"), 1.0], [0.25, 0.25, 0.5, 0.5]])
        rows.append((r.choice([1, 2, 3, None]), i, r.choice([None, r.random(), 0.6, 0.75]), box))
    frame = spark.createDataFrame(rows, "k int, i int, score double, box array<double>")
    kept = suppression.suppressed(frame, ["k"], max_overlap=most, best=best)
    assert sorted(((x.k, x.place, tuple(x.box)) for x in kept.collect()), key=repr) == naive_kept(rows, 0.6, most, best)
    assert suppression.suppressed(frame.limit(0), ["k"]).count() == 0
