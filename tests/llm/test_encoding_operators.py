"""Packing, neighbours, WARC, SentencePiece: against the libraries, brute force and round trips."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import neighbours, packing, sentencepiece_bpe, warc
from plumbline.llm._spark import ship, table

ODD = ["", " ", "a", "  a", "a  b ", "a\nb\tc", "　x", "ａ", "é é", "é x́", "<s>", "<0x41>", "<unk>", "a\x00b", "▁▁ ▁x", "▁", "   " * 9 + "xx", "日本語のテキストです。", "😀😀 a😀", "abababab ababab", " \n \n", "don't it's we'RE ,'s 's", "x…, 12a3 é,b×c", "İstanbul ΣΑΣ ς", "<|endoftext|> x<|startoftext|>y"]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(1)
    letters = "abcdeé ▁  thionr\n😀日本.,!1234'''ß×—…"
    out = ODD + ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    out += ["".join(r.choice(["th", "in", "an", "ab", "▁", " ", "ing", "er"]) for _ in range(r.randint(300, 900))) for _ in range(8)]
    return out + ["a" * 4000, " " * 2500, "ab" * 700, "".join(r.choice("abcinterhosdl") for _ in range(900)), "lorem ipsum dolor " * 9000]


# ---- 10 SentencePiece ----


def test_sentencepiece_is_the_library(texts):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    want = library.encode(texts)
    assert sentencepiece_bpe.encode(texts) == want
    assert [sentencepiece_bpe.decode(x) for x in want] == [library.decode(x) for x in want]
    r = random.Random(2)
    for _ in range(300):  # ids that no text gives, broken UTF-8 among them
        ids = [r.choice((r.randrange(3, 32000), r.randrange(3, 259))) for _ in range(r.randint(1, 6))]
        assert sentencepiece_bpe.decode(ids) == library.decode(ids)


def test_sentencepiece_rows(spark, texts):
    from sentencepiece import SentencePieceProcessor

    ship(spark)
    library = SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    rows = [(i if i % 50 else None, t, "clash") for i, t in enumerate(texts)] + [(7, None, None), (7, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = collections.Counter(tuple(r) for r in sentencepiece_bpe.encoded(frame).collect())
    want = collections.Counter()
    for i, t, _ in rows:
        ids = library.encode(t or "")
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())] += 1
    assert got == want
    assert sentencepiece_bpe.encoded(frame.limit(0)).count() == 0


# ---- 7 packing ----


def test_tokens_are_the_library(texts):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    want = [np.array(x.ids, "<u4").tobytes() for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert packing.encoder(path).ids(pa.array([*texts, None])) == [*want, b""]


class Counted:
    """A tokenizer, or its model, that notes what it is given."""

    def __init__(self, inner, seen):
        self.inner, self.seen = inner, seen

    def encode_batch_fast(self, texts, **options):
        self.seen += texts
        return self.inner.encode_batch_fast(texts, **options)

    def tokenize(self, word):
        self.seen.append(word)
        return self.inner.tokenize(word)


def test_common_words_are_encoded_once(monkeypatch):
    """However many rare words a worker meets; only these are forgotten."""
    monkeypatch.setattr(packing, "REMEMBERED", 200)
    e, seen = packing.Encoder(packing.default_tokenizer()), []
    e.tokenizer = Counted(e.tokenizer, seen)
    if hasattr(e, "model"):
        e.model = Counted(e.model, seen)
    rare = lambda k, i: "q" + chr(97 + k) + chr(97 + i // 26) + chr(97 + i % 26)
    for k in range(20):
        e.ids(pa.array(["the cat " + " ".join(rare(k, i) for i in range(50))]))
    assert seen.count("the") == seen.count("cat") == 1 and len(seen) == 2 + 20 * 50
    assert len(e.known) + len(e.older) <= 200 + 52


def test_plain_words_need_the_model_only():
    e, seen = packing.Encoder(packing.default_tokenizer()), []
    e.tokenizer = Counted(e.tokenizer, seen)
    e.ids(pa.array(["The Übergröße, 12 <b>été</b> don't e\u0301 \u4e2d " + "x" * 300]))
    assert sorted(seen) == sorted(["don't", "e\u0301", "\u4e2d", "x" * 300])


def test_tokens_of_capitals_and_marks_are_the_library():
    """H with a line below has no composed form, h with one has."""
    from tokenizers import Tokenizer

    path, r = packing.default_tokenizer(), np.random.default_rng(11)
    texts = ["H\u0331 T\u0308 J\u030c W\u030a Y\u030a", "\u00c9T\u00c9 \u00df\u00de\u00ff \u00d7\u00f7"]
    some = list("abHTXYZ '.<>|-01 \n\u00e9\u00c9\u00df\u00c0\u00de\u00ff\u00d7\u0331\u0301\u0308\u030c\u0130\u03a3\u4e2d\x00\x1c\x85\x7f\u00bd")
    texts += ["".join(r.choice(some, int(n))) for n in r.integers(0, 40, 2000)]
    want = [np.array(x.ids, "<u4").tobytes() for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert packing.Encoder(path).ids(pa.array(texts)) == want


def packed(frame):
    got = packing.pack(frame).toPandas().sort_values(["sequence_id", "offset"])
    before = got.groupby("sequence_id")["length"].cumsum() - got["length"]
    assert (before == got["offset"]).all() and (got.groupby("sequence_id")["length"].sum() <= packing.CAPACITY).all()
    return got


def test_packing(spark, data):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    docs = table(spark, data, "documents").select("doc_id", "text")
    extra = spark.createDataFrame([(5000, None, 1), (5001, "", 1), (None, "a b", 1), (None, "a b", 1)], "doc_id long, text string, bin int")
    got = packed(docs.unionByName(extra, allowMissingColumns=True))
    assert len(got[got["doc_id"].isna()]) == 2
    whole = {r["doc_id"]: np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4") for r in docs.unionByName(extra.drop("bin")).collect()}
    for i, g in got[got["doc_id"].notna()].sort_values("piece").groupby("doc_id"):
        ids = whole[i]
        assert list(g["start"]) == list(range(0, len(ids), packing.CAPACITY)) and list(g["piece"]) == list(range(len(g))) and g["length"].sum() == len(ids)
        for r in g.to_dict("records"):
            assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    bound = -(-int(got["length"].sum()) // packing.CAPACITY)
    assert got["sequence_id"].nunique() <= bound * 1.01 + 2
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_in_blocks(spark, data, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 32)
    docs = table(spark, data, "documents")
    got = packed(docs)
    assert len(got) == len(got.drop_duplicates(["doc_id", "piece"])) and set(got["doc_id"]) == {r["doc_id"] for r in docs.collect()}


def test_crossover_keeps_all_items():
    r = np.random.default_rng(3)
    sizes = sorted((int(x) for x in r.integers(1, 1000, 200)), reverse=True)
    a, b = packing.best_fit(sizes, 2048, range(200)), packing.best_fit(sizes, 2048, r.permutation(200))
    for child in (packing.crossover(a, b, r), packing.mutate(b, r)):
        assert sorted(i for items in child.items for i in items) == list(range(200))
        assert all(sum(sizes[i] for i in items) == f <= 2048 for items, f in zip(child.items, child.fill, strict=True))
    best = packing.evolve(sizes, [], (1,), 2048)[0]
    assert max(best) + 1 <= len(a.items)


# ---- 9 WARC ----


def test_warc(spark, data, monkeypatch):
    ship(spark)
    pages = table(spark, data, "pages")
    big = "x" * (3 * warc.CHUNK + 5)
    extra = [(None, "u", None), (None, "u", None), (9001, None, big), (9002, "v", big), (9001, None, big), (9003, "w", ""), (9004, "a b\nc", "é"), (9005, "u" * 70000, "z")]
    pages = pages.unionByName(spark.createDataFrame(extra, "page_id long, url string, html string"))
    path = warc.write_records(pages)
    got = warc.read_records(spark, path).toPandas()
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    assert len(got) == len(rows)
    first = {}
    for i, h in rows:
        if i is not None:
            first[h] = min(i, first.get(h, i))
    body = dict(rows)
    responses = collections.Counter()
    for r in got.to_dict("records"):
        i = None if r["page_id"] != r["page_id"] else int(r["page_id"])
        h = body[i]
        assert r["payload_bytes"] == len(h) and r["payload_digest"] == base64.b32encode(hashlib.sha1(h).digest()).decode()
        responses[h] += r["record_type"] == "response"
        if r["record_type"] == "response":
            assert i == first[h] and r["refers_to"] != r["refers_to"]
        else:
            assert r["refers_to"] == first[h]
    assert all(responses[h] == 1 for _, h in rows)
    # the rows of a record, joined, are a record in WARC format
    chunks = spark.read.parquet(path).where("page_id = 9001 and chunks > 1").orderBy("chunk_no").collect()
    raw = b"".join(bytes(c["data"]) for c in chunks)
    head, block = raw.split(b"\r\n\r\n", 1)
    length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    assert head.startswith(b"WARC/1.1\r\n") and block[length:] == b"\r\n\r\n" and block[:length].endswith(big.encode())
    small = warc.read_records(spark, warc.write_records(pages, min_bytes=10)).where("payload_bytes < 10").toPandas()
    assert (small["record_type"] == "response").all()
    assert warc.read_records(spark, warc.write_records(pages.limit(0))).count() == 0


def test_warc_finds_damage(spark):
    ship(spark)
    path = warc.write_records(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"))
    from pyspark.sql import functions as F

    broken = spark.read.parquet(path).withColumn("data", F.regexp_replace(F.col("data").cast("string"), "abc", "abd").cast("binary"))
    broken.write.parquet(path + "-broken")
    with pytest.raises(Exception, match="digest fails"):
        warc.read_records(spark, path + "-broken").collect()


@pytest.mark.parametrize("lost", [[0], [1], [3], [2, 3], [0, 1, 2, 3]])
def test_warc_misses_rows(spark, lost):
    """Rows of one record are gone: the first, one in the middle, the last ones. Where all are, the other records are read."""
    ship(spark)
    pages = spark.createDataFrame([(i, "u", f"{i}" * (warc.CHUNK * 7 // 2)) for i in range(1, 9)], "page_id long, url string, html string")
    kept = spark.read.schema(warc.ROWS).parquet(warc.write_records(pages)).collect()
    schema = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int32()), ("chunks", pa.int32()), ("payload_sha1", pa.string()), ("data", pa.binary())])
    for page in (1, 4, 8):  # at the begin, in the middle and at the end of the rows
        rows = sorted((r.record_id, r.chunk_no, r.chunks, r.payload_sha1, bytes(r.data)) for r in kept if r.page_id != page or r.chunk_no not in lost)
        batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 5], strict=True), schema, strict=True)], schema=schema) for i in range(0, len(rows), 5)]
        if len(lost) == 4:
            assert sum(b.num_rows for b in warc._records(iter(batches))) == 7
        else:
            with pytest.raises(ValueError, match="missing|out of order|not the start|begins twice"):
                list(warc._records(iter(batches)))


# ---- 8 neighbours ----


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == len(rows[0][1]) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float)):
            good.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for i, q in good.items():
        if i % every == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in good.items() if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def test_neighbours_rows_and_ties(spark):
    ship(spark)
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=8)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(200, None), (201, [0.0] * 8), (202, [float("nan")] + [1.0] * 7), (203, [None] + [1.0] * 7), (None, [1.0] * 8), (205, [float("inf")] + [1.0] * 7), rows[5], (260, [30.0] * 8), (280, [1.0] * 7), (300, [])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = collections.defaultdict(list)
    for x in neighbours.nearest(frame).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    want = brute(rows, 20, 20)
    assert set(got) == set(want)
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]])
    few = neighbours.nearest(frame.where("vec_id < 7 or vec_id = 20")).collect()
    assert sum(x["query_id"] == 20 for x in few) == 7
    assert neighbours.nearest(frame.limit(0)).count() == 0


def test_equal_products_of_different_vectors(spark, monkeypatch):
    """One product for all pairs with the query: the smallest ids come, in one block and in many."""
    ship(spark)
    rng = np.random.default_rng(5)
    rows = [(0, [1.0, 0.0, 0.0, 0.0])] + [(int(i), [0.3, *(rng.normal(size=3) / 7).tolist()]) for i in rng.permutation(np.arange(1, 400))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for block in (neighbours.BLOCK, 50):
        monkeypatch.setattr(neighbours, "BLOCK", block)
        monkeypatch.setattr(neighbours, "LEAF", 1000)
        got = neighbours.nearest(frame, k=20, every=1000).orderBy("rank").collect()
        assert [(r.rank, r.vec_id, r.score) for r in got] == [(i, i, 0.3) for i in range(1, 21)]


def test_neighbours_recall(spark, data):
    frame = table(spark, data.replace("0.001", "0.1"), "embeddings")
    want = brute([(r["vec_id"], r["embedding"]) for r in frame.collect()], 20, 20)
    got = collections.defaultdict(set)
    for x in neighbours.nearest(frame).collect():
        got[x["query_id"]].add(x["vec_id"])
    recall = np.mean([len(got[q] & {j for j, _ in near}) / len(near) for q, near in want.items()])
    assert set(got) == set(want) and recall >= 0.9


def test_tree_visits_all_leaves_best_first():
    r = np.random.default_rng(2)
    x = r.normal(size=(2000, 16))
    tree = neighbours.fit(x, 10, float(np.linalg.norm(x, axis=1).max()))
    walks = [list(w) for w in tree.order(tree.extend(x[:20], query=True))]
    assert all(sorted(w) == list(range(len(tree.leaf_of))) for w in walks) and 1 <= tree.visits <= len(tree.leaf_of)
