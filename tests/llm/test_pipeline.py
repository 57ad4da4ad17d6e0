"""The pipeline's rows against the stages done one by one in plain Python."""

import re

import pytest

import corpus_pipeline
from plumbline.llm import pii, toxicity
from plumbline.llm._spark import table, written

from .test_text_operators import brute_components


@pytest.fixture(scope="module")
def stages(spark, data):
    docs, out = table(spark, data, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((docs, written(stage(spark, docs, data), "stage")))
        docs = out[-1][1]
    return out


def test_stages(spark, data, stages):
    columns = table(spark, data, "documents").columns
    text = lambda d: {r["doc_id"]: r["text"] for r in d.collect()}
    for docs, kept in stages[:-1]:
        assert kept.columns == columns
    (raw, calm), (_, unique), (_, distinct), (_, private), (_, pieces) = stages
    # toxicity: what the model calls toxic goes, all else stays
    model = toxicity.train(raw, table(spark, data, "labels"))
    gone = {r["doc_id"] for r in toxicity.score(raw, model).where("predicted = 1").collect()}
    assert set(text(calm)) == set(text(raw)) - gone
    # exact dedup: the largest id of each text
    last = {}
    for i, t in sorted(text(calm).items()):
        last[t] = i
    assert set(text(unique)) == set(last.values())
    # near copies: the smallest id of each component
    assert set(text(distinct)) == {i for i, _, c, _ in brute_components(list(text(unique).items())) if i == c}
    # PII: all documents, nothing private left
    before, after = text(distinct), text(private)
    assert set(before) == set(after)
    mail = re.compile(r"[\w.]+@[\w.]+\w")
    for i, t in before.items():
        assert not set(mail.findall(t)) & set(mail.findall(after[i]))
        if not re.search(r"[0-9@]", t) and not any(w in t for w in pii.FEMALE + pii.MALE):
            assert after[i] == t
    assert all(r["n_chars"] == len(r["text"]) for r in private.collect())
    assert {r["doc_id"] for r in pieces.collect()} == set(after)


def test_run_is_the_stages(spark, data, stages):
    got = corpus_pipeline.run(spark, data)
    pieces = lambda d: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in d.collect())
    assert pieces(got) == pieces(stages[-1][1])


def test_odd_rows_go_through_every_stage(spark, data):
    """Null and repeated ids, null and empty texts, repeated rows, ties, clashing columns and no n_chars: each stage's defined result."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    near = base + " more"
    rows = [(1, base, 0), (1, base, 1), (1, near, 2), (None, near + " still", 3), (None, "quite another text by itself, alone", 4), (2, None, 5), (2, "", 6), (3, " \n", 7), (7, "mail joe@example.com or Mr. Smith", 8), (7, "mail joe@example.com or Mr. Smith", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").selectExpr("*", "'x' as sha", "1 as toxic", "2 as __toxic", "3 as may", "4 as new", "5 as kinds", "6 as component_id", "7 as at")
    named = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "exact dedup", "n-gram Jaccard join", "PII"):
        out = named[name](spark, docs, data)
        assert out.columns == docs.columns
        assert named[name](spark, docs.limit(0), data).count() == 0
    assert named["toxicity"](spark, docs, data).count() == len(rows)
    # equal texts (null is empty): one row of each, with the largest id
    kept = named["exact dedup"](spark, docs, data).collect()
    assert sorted((r["text"] or "", r["doc_id"] or 0) for r in kept) == sorted({(t or "", i or 0) for i, t, _ in rows})
    # similar texts: one row with the smallest id, null ids last; texts without words all stay
    left = named["n-gram Jaccard join"](spark, docs, data).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left if not (r["text"] or "").startswith("one")) == [(0, rows[4][1]), (2, ""), (2, ""), (3, " \n"), (7, rows[8][1])]
    assert [r["doc_id"] for r in left if (r["text"] or "").startswith("one")] == [1]
    new = {r["row"]: r["text"] for r in named["PII"](spark, docs, data).collect()}
    assert len(new) == 9 and new[5] is None and new[6] == "" and "joe" not in new[8] and "Smith" not in new[8] and new[0] == base
    pieces = named["best-fit packing"](spark, docs, data).collect()
    assert len(pieces) == len(rows) and len({r["sequence_id"] for r in pieces}) == 1
