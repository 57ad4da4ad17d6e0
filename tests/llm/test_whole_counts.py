"""The language model counts all pairs of its training rows."""

import pytest

from plumbline.llm import lm


def test_pairs_seen_once_are_kept(spark):
    docs = spark.createDataFrame([(1, "red fox runs"), (2, "blue fox sleeps")], "doc_id long, text string")
    model = lm.train(docs)
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame([(1, "red fox"), (2, "fox red")], "doc_id long, text string"), model).collect()}
    # same words and base score; only the first has a pair (red fox) that training has, once
    assert got[1]["base_score"] == pytest.approx(got[2]["base_score"])
    assert got[1]["score"] > got[2]["score"] + 0.3
