"""Toxicity, exact dedup, language model, sharding, PII: brute force, held-out accuracy and edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import exact_dedup, jaccard, lm, pii, sharding, toxicity
from plumbline.llm import queries as Q
from plumbline.llm._spark import components, extended, ship, table
from plumbline.llm._words import words
from plumbline.llm.elias_fano import EliasFano

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, level int, root long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    ship(spark)
    r = random.Random(3)
    word = lambda: "".join(r.choice("etaoin") for _ in range(r.randint(1, 7)))
    long = " ".join(word() for _ in range(30000))
    base = [" ".join(word() for _ in range(40)) for _ in range(6)]
    rows = [(i, t, "en", "a", len(t), "x", i, 1) for i, t in enumerate(base)]
    rows += [(10, base[0], None, None, None, None, None, None), (11, base[0], "en", "a", 1, "y", 1, 2), (11, base[0], "en", "a", 1, "y", 1, 2)]
    rows += [(None, "alone", None, "b", 5, None, None, None), (None, None, None, None, None, None, None, None), (12, "", "en", "b", 0, "z", 1, 1), (13, None, "en", "b", None, "z", 1, 1)]
    rows += [(14, long, "en", "c", len(long), "z", 1, 1), (15, long + " end", "en", "c", 1, "z", 1, 1), (16, long, "en", "c", 1, "z", 1, 1), (17, " \n\t ", "en", "c", 1, "z", 1, 1), (18, base[1] + " more", "en", "c", 1, "z", 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_follow_the_contract():
    texts = ["A bÉ\x0bC\x1cd e", "", "  x ", "日本 語"]
    data, starts, ends, first = words(pa.array(texts))
    got = [[data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(first, first[1:], strict=False)]
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) for t in texts]


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(r.randint(100, 160), r.randint(100, 160)) for _ in range(50)] + [(200, k) for k in range(201, 260)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {x["id"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if any(a != b and x in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    # the same from links that come in three parts, the last one empty
    parts = [spark.createDataFrame(e, "a long, b long") for e in (edges[::3], edges[1::3] + edges[2::3], [])]
    root = components(parts[0])
    for part in parts[1:]:
        root = extended(root, part)
    assert sorted((x["id"], x["root"]) for x in root.collect()) == sorted(got.items())
    assert extended(components(parts[2]), parts[2]).count() == 0


# ---- 1 toxicity ----


def test_toxicity_learns_and_knows_misspellings():
    r = random.Random(5)
    bad, plain = ["worthless", "moronic"], ["".join(r.choice("aeioulnst") for _ in range(r.randint(2, 6))) for _ in range(300)]
    make = lambda toxic: " ".join([r.choice(plain) for _ in range(40)] + ([r.choice(bad) for _ in range(2)] if toxic else []))
    labels = [i % 5 == 0 for i in range(800)]
    model = toxicity.fit([make(y) for y in labels], [int(y) for y in labels])
    test = [i % 2 == 0 for i in range(200)]
    got = model.scores(pa.array([make(y) for y in test])) >= 0.5
    assert (got == np.array(test)).mean() > 0.95
    clean, wrong = model.scores(pa.array([" ".join(plain[:40]), " ".join(plain[:40]) + " worthles worthlesss moronicc"]))
    assert wrong > clean


def test_toxicity_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(6)] + [(None, 1, 1), (3, 1, None), (77, None, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd, labels)
    got = toxicity.score(odd, model).toPandas()
    assert len(got) == odd.count() and got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    for r in got.itertuples():
        assert r.held_out == (r.doc_id == r.doc_id and zlib.crc32(str(int(r.doc_id)).encode()) % 4 == 2)
    empty = toxicity.score(none, toxicity.train(none, labels.limit(0)))
    assert empty.count() == 0
    assert toxicity.score(odd, model, keep="toxic").columns == [*odd.columns, "toxic"]
    with pytest.raises(ValueError, match="of its own"):
        toxicity.score(odd, model, keep="LEVEL")


def test_toxicity_on_held_out_rows(spark, data):
    folder = data.replace("0.001", "0.1")
    got = Q.op1_toxicity(spark, folder).where("held_out").join(table(spark, folder, "labels"), "doc_id").toPandas()
    hit = ((got["predicted"] == 1) & (got["toxic"] == 1)).sum()
    assert hit / got["predicted"].sum() > 0.6 and hit / got["toxic"].sum() > 0.6


# ---- 2 Jaccard ----


def brute_components(texts: list[tuple]) -> list[tuple]:
    sets = []
    for i, t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    links = [sum(a != b and bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for b in range(len(sets))) for a in range(len(sets))]
    least = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted([(i, len(sets[k]), least.get(find(k)) if sets[k] else i, links[k]) for k, (i, _) in enumerate(texts)], key=repr)


def near_copies(seed: int, n: int = 160) -> list[tuple]:
    r = random.Random(seed)
    word = lambda: "".join(r.choice("etaoin") for _ in range(r.randint(2, 6)))
    passage = " ".join(word() for _ in range(60))
    original = [" ".join(word() for _ in range(120)) for _ in range(6)]
    out = []
    for i in range(n):
        w = original[i % 6 if i % 3 else 0].split()
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = word()
        out.append((i, " ".join(w)))
        out.append((1000 + i, passage + " " + " ".join(word() for _ in range(r.randint(5, 60)))))
    return out


@pytest.mark.parametrize("limits", [{}, {"GROUP": 3, "OFTEN": 4, "CELL": 16, "BLOCK": 4, "COMMON": 40, "MEMBERS": 12, "SHINGLES": 900, "HOT": 3}])
def test_jaccard_loses_no_link(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(jaccard, k, v)
    rows = near_copies(7)
    ship(spark)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_components(rows)


def test_jaccard_odd_rows(spark, odd, none):
    got = sorted([tuple(r) for r in jaccard.near_duplicates(odd).collect()], key=repr)
    assert got == brute_components([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert jaccard.near_duplicates(none).count() == 0


def test_trie_prunes_nothing_that_links():
    r = np.random.default_rng(2)
    base = np.sort(r.choice(10**6, 80, replace=False)).astype(np.uint64)
    sets = []
    for _ in range(60):
        s = set(base.tolist())
        s -= set(r.choice(base, r.integers(0, 20), replace=False).tolist())
        s |= set(r.choice(10**6, r.integers(0, 20), replace=False).tolist())
        sets.append(np.array(sorted(s), np.uint64))
    sets += [sets[0], sets[0][:3], sets[0][:-1]]
    trie = jaccard.Trie(sets)
    for probe in sets:
        p = set(probe.tolist())
        want = {(k, len(p & set(s.tolist()))) for k, s in enumerate(sets) if 100 * len(p & set(s.tolist())) >= 75 * len(p | set(s.tolist()))}
        assert set(trie.search(probe)) == want


def test_one_walk_with_many_probes():
    r = np.random.default_rng(8)
    base = np.sort(r.choice(10**6, 60, replace=False)).astype(np.uint64)
    make = lambda: np.unique(np.r_[r.choice(base, r.integers(40, 60), replace=False), r.integers(0, 10**6, r.integers(1, 14)).astype(np.uint64)])
    left, right = [make() for _ in range(40)], [make() for _ in range(50)]
    a, b = r.integers(1, 9, 40), r.integers(1, 9, 50)
    link = np.array([[100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y)) for y in right] for x in left])
    assert 0 < link.sum() < link.size
    to_probe, to_set = jaccard.Trie(right).links(left, a, b)
    assert (to_probe == link @ b).all() and (to_set == a @ link).all()


def test_sketches_never_exceed_the_difference():
    r = np.random.default_rng(4)
    for _ in range(50):
        a, b = (np.unique(r.integers(0, 4000, r.integers(1, 2000)).astype(np.uint64) * np.uint64(7919)) for _ in range(2))
        x, y = jaccard._sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        short = min(len(x), len(y))
        one, two = (jaccard._folded(pa.array([z], pa.binary()), short) for z in (x, y))
        assert np.bitwise_count(one ^ two).sum() <= len(np.setxor1d(a, b))


def test_an_ngram_of_many_classes_is_not_held():
    """Groups that go on over batches: up to GROUP classes give pairs, larger ones pass through, none twice or lost."""
    rows = [(g, c, (20 << 32), 0) for g, size in ((1, 3), (2, 500), (3, 1), (4, jaccard.GROUP), (5, jaccard.GROUP + 1), (6, 2)) for c in range(size)]
    rows += [(7, c, (20 << 32), 1 + c % 5) for c in range(4)]
    columns = [list(c) for c in zip(*rows, strict=True)]
    for step in (7, 64, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + step], t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)], ["ngram", "cid", "place", "salt"]) for i in range(0, len(rows), step)]
        got = [r for b in jaccard._candidates(iter(batches)) for r in b.to_pylist()]
        pairs = {(r["a"], r["b"]) for r in got if r["a"] is not None}
        assert pairs == {(a, b) for b in range(jaccard.GROUP) for a in range(b)}
        assert {(r["ngram"], r["cid"]) for r in got if r["ngram"] is not None} == {(g, c) for g, c, _, salt in rows if g in (2, 5) or salt}


# ---- 3 PII ----


def test_pii_surrogates(spark):
    text = "Dear Mr. Smith and Mrs. Ann Jones, Mr. Smith has joe.x@mail.example.com, JOE.X@MAIL.EXAMPLE.COM, +44 20 7946 0958, 10.0.0.1, 4111111111111111, 123-45-6789, " + "0f" * 20
    rows = spark.createDataFrame([(1, text, 5), (1, text, 5), (2, None, 1), (3, "", 1), (4, "plain words 12 and 3.4.5, v1.2", 1), (None, "г-жа Иванова: 10.0.0.1", 1)], "doc_id long, text string, pos long")
    got = {r["doc_id"]: r for r in pii.replace(rows, kinds="kinds").collect()}
    new = got[1]["text"]
    assert got[1]["kinds"] == ["person", "person", "person", "email", "email", "phone", "ip", "card", "ssn", "secret"] and got[1]["pos"] == 5
    for private in ("Smith", "Jones", "joe.x", "7946", "10.0.0.1", "4111111111111111", "123-45-6789", "0f0f"):
        assert private not in new
    m = re.fullmatch(r"Dear Mr\. (\w+) and Mrs\. (\w+) (\w+), Mr\. (\w+) has (\S+), (\S+), \+44 (\d\d) (\d{4}) (\d{4}), ([\d.]+), (\d{16}), (\d{3}-\d\d-\d{4}), ([0-9a-f]{40})", new)
    assert m and m[1] == m[4] and m[2] in pii.GIVEN["latin", "f"] and m[5].upper() == m[6] and m[5].endswith(".com")
    assert sum(int(d) if k % 2 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(m[11])) % 10 == 0
    assert got[2]["text"] is None and got[3]["text"] == "" and got[4]["text"] == "plain words 12 and 3.4.5, v1.2" and got[4]["kinds"] == []
    assert m[10] in got[None]["text"] and "Иванова" not in got[None]["text"]
    assert pii.replace(rows).count() == 6 and pii.replace(rows.limit(0)).count() == 0


def test_pii_keeps_entities_apart(spark):
    ips = [f"10.{a}.{b}.7" for a in range(10) for b in range(30)]
    names = [f"Herr Karl{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400)]
    rows = spark.createDataFrame([(i, f"x {ip} y") for i, ip in enumerate(ips)] + [(1000 + i, f"{n} sagt") for i, n in enumerate(names)], "doc_id long, text string")
    got = [r["text"] for r in pii.replace(rows).collect()]
    assert len(set(got)) == len(got) and not any(ip in t for t in got for ip in ips[:5])


def test_pii_against_known_places(spark):
    """Random texts of known pieces: only entities change, each to its kind's form, the same everywhere and no two alike."""
    r = random.Random(11)
    digit, letter = (lambda n: "".join(r.choice("0123456789") for _ in range(n))), (lambda n: "".join(r.choice("abcdefghijk") for _ in range(n)))
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    iban = lambda b: f"DE{98 - int(b + '131400') % 97:02d}{b}"
    make = {
        "email": (lambda: f"{letter(4)}.{letter(3)}@{letter(5)}.example.org", r"\S+@\S+\.org"),
        "phone": (lambda: f"+49 {digit(3)} {digit(4)} {digit(4)}", r"\+49 \d{3} \d{4} \d{4}"),
        "ssn": (lambda: f"{digit(3)} {digit(2)} {digit(4)}", r"\d{3} \d\d \d{4}"),
        "ip": (lambda: ".".join(str(r.randint(1, 254)) for _ in range(4)), r"\d+\.\d+\.\d+\.\d+"),
        "ipv6": (lambda: f"fe80::{hexes(4)}:{hexes(3)}:1", r"[0-9a-f]{4}::[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]"),
        "secret": (lambda: hexes(40), "[0-9a-f]{40}"),
        "key": (lambda: "sk_live_" + letter(20), "sk_live_[a-z]{20}"),
        "iban": (lambda: iban(digit(18)), r"DE\d{20}"),
        "person": (lambda: f"Frau {letter(5).capitalize()} {letter(7).capitalize()}", r"Frau \w+ \w+"),
    }
    have = [(k, f()) for k, (f, _) in make.items() for _ in range(12)]
    fill = ["plain", "words,", "12", "3.4.5", "a-b", "(x)", "Über", "2024-10-11", "1,234.50"]
    texts = []
    for i in range(120):
        pieces = []
        for _ in range(r.randint(0, 9)):
            pieces += [(None, r.choice(fill))] * r.randint(1, 3) + [(None, "and"), r.choice(have), (None, "so")]
        texts.append((i, pieces))
    rows = spark.createDataFrame([(i, " ".join(x for _, x in p)) for i, p in texts] + [(500, None), (501, ""), (502, "nothing")], "doc_id long, text string")
    got = {x["doc_id"]: (x["text"], x["kinds"]) for x in pii.replace(rows, key="k", kinds="kinds").collect()}
    assert got[500] == (None, []) and got[501] == ("", []) and got[502] == ("nothing", [])
    new: dict = {}
    for i, p in texts:
        m = re.fullmatch(" ".join(f"({make[k][1]})" if k else re.escape(x) for k, x in p), got[i][0])
        assert m and got[i][1] == [k for k, _ in p if k]
        for entity, surrogate in zip([x for x in p if x[0]], m.groups(), strict=True):
            assert new.setdefault(entity, surrogate) == surrogate
    assert len(set(new.values())) == len(new) and not set(new.values()) & {x for _, x in have}
    assert all(iban(v[4:]) == v for (k, _), v in new.items() if k == "iban")
    # the same with the same key, and not with another one
    assert sorted(x["text"] or "" for x in pii.replace(rows, key="k").collect()) == sorted(t or "" for t, _ in got.values())
    assert {x["doc_id"]: x["text"] for x in pii.replace(rows, key="other").collect()} != {i: t for i, (t, _) in got.items()}


def test_pii_names_and_hostile_texts(spark):
    deep = "x@" + "a." * 100_000 + "com"
    rows = [(1, "Mr. Smith and Mr. John Smith, Mrs. Smith"), (2, deep), (3, "x@a.b@c.d " * 200_000), (4, "9" * 3_000_000), (5, "Mr. " * 300_000), (6, "a:" * 500_000 + "1"), (7, "+1 " * 500_000), (8, "Dr. " + "Ab" * 500_000)]
    got = {r["doc_id"]: r["text"] for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    m = re.fullmatch(r"Mr\. (\w+) and Mr\. (\w+) (\w+), Mrs\. (\w+)", got[1])
    assert m and m[1] == m[3] == m[4] != "Smith" and m[2] in pii.GIVEN["latin", "m"]
    assert got[2] == deep and got[4] == "9" * 3_000_000


def test_pii_columns_with_clashing_names(spark):
    rows = spark.createDataFrame([(1, "a@b.com", 1, 2, 3, 4, 5, 6)], "doc_id long, text string, sha int, may int, new int, kinds int, pos int, _sha int")
    got = pii.replace(rows)
    assert got.columns == rows.columns and [tuple(r)[2:] for r in got.collect()] == [(1, 2, 3, 4, 5, 6)]


# ---- 4 exact dedup ----


@pytest.mark.parametrize("block", [7, exact_dedup.BLOCK])
def test_exact_dedup(odd, none, block):
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    if block == 7:
        odd = odd.where("coalesce(length(text), 0) < 1000")
        rows = [r for r in rows if len(r[1]) < 1000]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = exact_dedup.exact_duplicates(odd, block=block).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert sum(r["kept"] for r in got) == len(groups)
    assert exact_dedup.exact_duplicates(none).count() == 0
    if block != 7:
        kept = exact_dedup.keep_one(odd)
        assert kept.count() == len(groups) and kept.columns == odd.columns
        again = odd.unionByName(odd).unionByName(odd.withColumn("text", F.nullif("text", F.lit(""))))
        assert exact_dedup.keep_one(again).count() == len(groups)


def test_names_of_blocks_do_not_follow_partitions(spark):
    rows = [(i, "ab" * (i % 40)) for i in range(200)]
    names = [sorted(tuple(r) for r in exact_dedup.block_names(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), block=8).collect()) for n in (1, 7)]
    assert names[0] == names[1] and len({r[2:4] for r in names[0]}) == 40


# ---- 5 language model ----


def test_elias_fano():
    r = np.random.default_rng(1)
    for n, top in ((1, 5), (10, 10), (1000, 5000), (3000, 10**12), (2000, 500), (0, 1)):
        v = np.sort(r.integers(0, top, n)).astype(np.uint64)
        e = EliasFano.of(v)
        assert (e.access(np.arange(n)) == v).all()
        x = np.r_[r.integers(0, top + 10, 500).astype(np.uint64), v]
        place, equal = e.successor(x)
        assert (place == np.searchsorted(v, x)).all() and (equal == np.isin(x, v)).all()


def test_lm_against_counts(spark, odd, none, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 3000)
    monkeypatch.setattr(lm, "SHARD_WORDS", 200)
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    end = b"\0"
    tokens = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()), end]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    train = [tokens(t) for i, t in rows if not held(i)]
    one = collections.Counter(w for t in train for w in t)
    two = collections.Counter(p for t in train for p in zip([end, *t[:-1]], t, strict=True))
    total, distinct = sum(one.values()), len(one)
    kept = collections.Counter()
    for (a, _), n in two.items():
        kept[a] += (n - lm.DISCOUNT) * (n >= lm.PRUNE)
    base = lambda w: (one[w] + 0.5) / (total + 0.5 * (distinct + 1))

    def p(a, w):
        return base(w) * (1 - kept[a] / one[a] if one[a] else 1) + ((two[a, w] - lm.DISCOUNT) / one[a] if two[a, w] >= lm.PRUNE else 0)

    want = []
    for i, t in rows:
        t = tokens(t)
        want.append((i, held(i), len(t), sum(one[w] > 0 for w in t), total, sum(math.log10(base(w)) for w in t), sum(math.log10(p(a, w)) for a, w in zip([end, *t[:-1]], t, strict=True))))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in lm.held_out_scores(odd).collect()]
    order = lambda r: (repr(r[0]), r[2], r[5])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=2e-3)
    # probabilities over all words and an unknown one sum to 1
    for a in (end, next(w for (_, w), n in two.items() if n > 1), b"never seen"):
        assert sum(p(a, w) for w in one) + base(b"never seen") * (1 - kept[a] / one[a] if one[a] else 1) == pytest.approx(1)
    assert lm.held_out_scores(none).count() == 0


def test_lm_with_very_many_word_shards(spark, monkeypatch):
    """The same scores whether words lie in one shard or in over a thousand; numbers find their shards among 2,000."""
    edges = np.sort(np.random.default_rng(1).integers(0, 5000, 2000))
    numbers = np.arange(-1, 5002)
    assert lm._part_of(edges, numbers).tolist() == [int((edges <= n).sum()) for n in numbers.tolist()]
    ship(spark)
    r = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join(f"w{r.randrange(1200)}" for _ in range(120))) for i in range(40)], "doc_id long, text string")
    few = {x.doc_id: x.score for x in lm.score(docs, lm.train(docs)).collect()}
    monkeypatch.setattr(lm, "SHARD_WORDS", 1)
    many = lm.train(docs)
    assert many.bits >= 10
    assert {x.doc_id: x.score for x in lm.score(docs, many).collect()} == pytest.approx(few)


def test_lm_beats_the_base_on_held_out_rows(spark, data):
    got = Q.op5_lm(spark, data.replace("0.001", "0.01")).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0]


# ---- 6 sharding ----


def brute_shards(rows: list[tuple], shards: int) -> list[tuple]:
    """(doc_id, source, size, crc, draw) to (doc_id, size, crc, shard, slot): ranks in each source, fractions, one order, equal cuts."""
    first = lambda *x: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in x)  # noqa: E731  nulls come first
    by_source = collections.defaultdict(list)
    for i, source, size, crc, draw in rows:
        by_source[source].append((draw, i, crc, size))
    every = []
    for source, own in by_source.items():
        own.sort(key=lambda x: first(*x))
        every += [((k + 0.5) / len(own), source, *x) for k, x in enumerate(own)]
    every.sort(key=lambda x: (x[0], first(x[1]), first(*x[2:])))
    shard = [k * shards // len(every) for k in range(len(every))]
    return [(i, size, crc, shard[k], k - shard.index(shard[k])) for k, (_, _, _, i, crc, size) in enumerate(every)]


def test_sharding(odd, none, spark, data):
    one_each = spark.createDataFrame([(i, "t" * (i % 5), f"s{i}", 1, 2, 3) for i in range(300)], "doc_id long, text string, source string, draw int, at int, position int")
    for docs, shards in ((odd, 3), (odd, 40), (one_each, 7), (table(spark, data, "documents"), 8)):
        got = sharding.shard(docs, shards).toPandas()
        draw = F.xxhash64(F.lit(17), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
        rows = [(r["doc_id"], r["source"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()), r["d"]) for r in docs.select("doc_id", "source", "text", draw.alias("d")).collect()]
        clean = lambda r: tuple(None if x != x else x for x in r)
        assert sorted(map(clean, got[["doc_id", "size", "text_crc32", "shard", "slot"]].itertuples(index=False)), key=repr) == sorted(map(clean, pd_rows(brute_shards(rows, shards))), key=repr)
        sizes = got["shard"].value_counts()
        sizes = [int(sizes.get(k, 0)) for k in range(shards)]
        assert max(sizes) - min(sizes) <= 1
    # each shard holds the mixture
    mix = got.groupby(["shard", got["source"].fillna("")]).size().unstack(fill_value=0)
    assert (mix.max() - mix.min()).max() <= 3
    assert sharding.shard(none).count() == 0


def pd_rows(rows: list[tuple]) -> list[tuple]:
    """Ids as pandas gives them: floats where one is null."""
    return [(float(r[0]) if r[0] is not None and any(x[0] is None for x in rows) else r[0], *r[1:]) for r in rows]
