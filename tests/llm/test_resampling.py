"""Importance resampling against counts in plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from plumbline.llm import resampling
from plumbline.llm._words import LOWER, flat

SCHEMA = "doc_id long, text string"


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    out = []
    for i, w in enumerate(words):
        out.append(zlib.crc32(w.encode()) % 10000)
        if i + 1 < len(words):
            out.append(zlib.crc32(f"{w} {words[i + 1]}".encode()) % 10000)
    return out, len(words)


def wanted(docs, target):
    """Rows (doc_id, n_features, weight, score, rank)."""
    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, f, _ in found for b in f), Counter(b for x in target for b in features(x)[0])
    a, b = s.total(), t.total()
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (a + 10000) / ((s[k] + 1) * (b + 10000))))
    rows = []
    for i, f, n in found:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    enough = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(enough[: 25 * len(enough) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in rows)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    out = ["".join(r.choice("abcZé日 \n.0_😀" + "a" * 5 + " " * 3) for _ in range(r.randint(0, 300))) for _ in range(250)]
    return out + [None, "", "x" * 100 + " " + "y" * 60 + " b", "a", "...", "the  The\x00the", "ab " * 2000]


@pytest.mark.parametrize("piece", [None, 64])
def test_streams(texts, monkeypatch, piece):
    """Buckets of all words and pairs, also where long documents are taken in parts."""
    if piece:
        monkeypatch.setattr(resampling, "SLICE", piece)
    data, offsets = flat(pa.array(texts))
    both, at, words = (resampling._long_slice if piece else resampling.stream)(LOWER[data], offsets, 10000)
    for i, t in enumerate(texts):
        want, n = features(t)
        assert both[at[i] : at[i + 1]].tolist() == want and words[i] == n


def test_against_counts(spark, texts):
    """Null and repeated ids, null and empty texts, repeated rows, other columns."""
    rows = [(None if i % 40 == 1 else i // 2, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 2
    target = [texts[k] for k in range(0, 60, 3)] + [None, ""]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", rank string, at long")
    got = resampling.resample(docs.repartition(3), spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string"))
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.select(*names).collect()) == wanted(rows, target)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    docs = [(1, "a " * 30), (2, "b " * 30), (3, "c"), (4, "d " * 20), (5, "e " * 21)]
    assert resampling.resample(none, none).count() == 0
    got = resampling.resample(spark.createDataFrame(docs, SCHEMA), none)
    assert Counter(tuple(r) for r in got.collect()) == wanted(docs, [])
    with pytest.raises(ValueError):
        resampling.streams(none, buckets=70_000)
