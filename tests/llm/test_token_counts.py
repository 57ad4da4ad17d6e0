"""Token counts against the library."""

import random
from collections import Counter

import pytest

from plumbline.llm import token_counts
from plumbline.llm._spark import table

ODD = [
    None, "", " ", "a", "  a", "a  b ", "a\nb\tc", "　x", "ａ", "é é", "<s>", "<0x41>", "<unk>", "</s> x", "a\x00b", "▁▁ ▁x", "▁", "   " * 9 + "xx", "日本語のテキストです。", "😀😀 a😀", " \n \n", "\n", "\n\nab \n",
    "\tx\n y", "x\r\n\x0by", "<|endoftext|> x<|startoftext|>y", "a" * 3000, " " * 3000 + "b", "\n" * 700, "lorem ipsum dolor " * 9000,
]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=token_counts.default_model())


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    return ODD + ["".join(r.choice("abcdeé ▁  thionr\n\t😀日本.,!1234'''ß×—…") for _ in range(r.randint(0, 80))) for _ in range(800)]


def check(frame, rows, library, **more):
    got = Counter(tuple(r) for r in token_counts.counted(frame, **more).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())
    n = [len(library.encode(t or "")) for _, t in rows]
    assert got == Counter((i, len((t or "").encode()), k, k > 4096) for (i, t), k in zip(rows, n, strict=True))


@pytest.mark.parametrize("common", [0, 50, token_counts.COMMON])
def test_is_the_library(spark, texts, library, common):
    """All pre-tokens joined, some of them, none; null and repeated ids, repeated rows, clashing columns."""
    rows = [(None if i % 30 == 2 else i // 2, t) for i, t in enumerate(texts)] + [(5, texts[5])] * 2
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row long, pretoken string")
    check(frame.repartition(3), rows, library, common=common)


def test_windows_and_slices(spark, texts, library, monkeypatch):
    cut = token_counts.splitter(token_counts.default_model())
    monkeypatch.setattr(token_counts, "WINDOW", 7)
    for t in texts:
        whole = [p for w in cut.split(t or "") for p in w]
        assert "".join(whole) == ("▁" + t.replace(" ", "▁") if t else "")
        assert sum(cut.count(whole)) == len(library.encode(t or ""))


def test_table_and_empty(spark, data, library):
    docs = table(spark, data, "documents")
    check(docs, [tuple(r) for r in docs.select("doc_id", "text").collect()], library, common=1000)
    assert token_counts.counted(docs.limit(0)).count() == 0


def test_each_pretoken_once(spark):
    docs = spark.createDataFrame([(1, "ab ab cd"), (2, "ab\ncd")], "doc_id long, text string")
    rows = {r.pretoken: r.uses for r in token_counts.pretokens(docs, token_counts.default_model()).collect()}
    assert rows == {"▁ab": 3, "▁cd": 1, "\ncd": 1}


def test_common_bound(spark):
    known = spark.createDataFrame([(str(k), 1 + k % 7, 1) for k in range(300)], "pretoken string, uses long, n long")
    for common in (0, 10, 50, 299, 300):
        least = token_counts._least_uses(known, common)
        assert known.where(f"uses >= {least}").count() <= common
    assert token_counts._least_uses(known, 300) == 1
