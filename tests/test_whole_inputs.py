"""Queries over whole inputs: nothing is left out before an operator sees it."""

import random
from collections import Counter, defaultdict

import pandas as pd
import pytest

from plumbline import queries as engine


def test_containment_reads_all_events(spark, data):
    events = pd.read_parquet(f"{data}/events.parquet")
    users = defaultdict(Counter)
    for user, kind in zip(events["user_id"], events["event_type"], strict=True):
        users[user][kind] += 1
    targets = {"click", "purchase", "error"}
    scored = [(set(c) & targets, max((k, t) for t, k in c.items())[1]) for c in users.values() if set(c) & targets]
    run = lambda name: engine.queries()[name](spark, data).collect()
    assert {r["label"]: (r["n"], r["precision"]) for r in run("containment_precision")} == {
        p: (n, round(sum(q == p and q in t for t, q in scored) / n, 6)) for p, n in Counter(q for _, q in scored).items()
    }
    pairs = Counter((label, q) for t, q in scored for label in t)
    assert {(r["label"], r["pred"]): r["n"] for r in run("containment_breakdown")} == pairs
    whole = {label: [(t, q) for t, q in scored if label in t] for label in targets}
    assert {r["label"]: (r["n"], r["strict_recall"], r["lenient_recall"]) for r in run("containment_recall")} == {
        label: (len(x), round(sum(q == label for _, q in x) / len(x), 6), round(sum(q in t for t, q in x) / len(x), 6)) for label, x in whole.items() if x
    }


def _overlap(a, b):
    w, h = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    both = max(w, 0.0) * max(h, 0.0)
    return min(both / (a[2] * a[3] + b[2] * b[3] - both), 1.0)


def test_boxes_of_all_lines(spark, tmp_path):
    # one side of up to eight lines, the best scores last
    r = random.Random(4)
    lines = [(o, k, r.choice("OF"), float(r.randint(1, 50)), r.randint(0, 10) / 100, r.randint(0, 8) / 100, 9000.0 * (k + 1) + r.randint(0, 8000)) for o in range(60) for k in range(r.randint(1, 16))]
    names = ["l_orderkey", "l_linenumber", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    pd.DataFrame(lines, columns=names).to_parquet(tmp_path / "lineitem.parquet")
    sides = defaultdict(lambda: ([], []))
    for o, k, label, quantity, discount, tax, price in lines:
        sides[o][k % 2].append((label, price / 100000, [quantity / 100, discount * 4, 0.3 + tax, 0.2 + discount]))
    run = lambda name: {x[0]: tuple(x)[1:] for x in engine.queries()[name](spark, str(tmp_path)).collect()}
    close = lambda want: {k: tuple(pytest.approx(v, abs=1.01e-4) if isinstance(v, float) else v for v in x) for k, x in want.items()}
    faces, best, matched, flat = {}, {}, {}, defaultdict(list)
    for o, (even, odd) in sides.items():
        if odd:
            faces[o] = (len(odd), sum(b[2] * b[3] for _, _, b in odd), max(s for _, s, _ in odd))
        for label, s, _ in odd:
            flat[label].append(s)
        good = sorted((d for d in odd if d[1] >= 0.2 and 0.002 <= round(d[2][2], 4) * round(d[2][3], 4) <= 0.1), key=lambda d: -d[1])
        if good:
            best[o] = (min(2, len(good)), good[0][0], good[0][1])
        used, pairs = set(), []
        for label, s, box in sorted(odd, key=lambda d: -d[1]):
            fit = [(_overlap(box, e[2]), i) for i, e in enumerate(even) if e[0] == label and i not in used and _overlap(box, e[2]) >= 0.3]
            if fit:
                v, i = max(fit)
                used.add(i)
                pairs.append((round(v, 4), min(round(s, 3), round(even[i][1], 3))))
        if pairs:
            matched[o] = (len(pairs), sum(v for v, _ in pairs), max(s for _, s in pairs))
    assert max(n for n, _, _ in faces.values()) > 3 and max(n for n, _, _ in matched.values()) > 3
    assert run("face_summary") == close(faces)
    assert run("top_k_filter") == close(best)
    assert run("box_iou_agreement") == close(matched)
    assert run("detection_explode") == close({label: (len(x), sum(x) / len(x)) for label, x in flat.items()})


def test_genres_of_all_labels(spark, data):
    out = engine.queries()["genre_argmax_agree"](spark, data).toPandas()
    labels = set(pd.read_parquet(f"{data}/embeddings.parquet")["label"])
    assert {f"sim_{k}" for k in labels} <= set(out.columns)
    agreeing = out[out["agree"]]
    assert len(labels) == 10 and set(agreeing["true_label"]) - {0, 1, 2, 3} and (agreeing["pred"] == agreeing["true_label"]).all()
