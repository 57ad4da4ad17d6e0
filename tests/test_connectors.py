"""Concurrent appends, NPZ caches, table functions and reviews on a stream."""

import json
import threading

import numpy as np
import pandas as pd
import pytest

from plumbline.functions import udtf
from plumbline.functions import boxes as B
from plumbline.sources import appends, npz
from plumbline.streaming import reviews

# ---- appends ----


def test_two_writers_leave_one_row_an_id(spark, tmp_path, monkeypatch):
    """Both have written their batches before either claims its commit: the second drops what the first one has."""
    path, ready, claim = f"{tmp_path}/t", threading.Barrier(2), appends._claim
    waited = threading.local()

    def slow(*args):
        if not getattr(waited, "done", False):
            waited.done = True
            ready.wait(timeout=60)
        return claim(*args)

    monkeypatch.setattr(appends, "_claim", slow)
    commits = {}

    def run(name, ids):
        commits[name] = appends.append_once(spark.createDataFrame([(str(i), name) for i in ids], "id string, v string"), path)

    threads = [threading.Thread(target=run, args=x) for x in (("a", range(60)), ("b", range(30, 90)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(timeout=120)
    assert sorted(commits.values()) == [0, 1]
    won = min(commits, key=commits.get)
    rows = {r.id: r.v for r in appends.first_written(spark, path).collect()}
    assert appends.first_written(spark, path).count() == 90 and len(rows) == 90
    assert all(rows[str(i)] == won for i in range(30, 60))


def test_equal_ids_of_one_append(spark, tmp_path):
    """The first by the order, ids compared without blanks, rows without ids all and each time; later columns."""
    path = f"{tmp_path}/t"
    rows = [("1", 3, "c"), (" 1", 2, "b"), ("1", 2, "a"), (None, 1, "x"), ("", 1, "x"), (None, 1, "x")]
    appends.append_once(spark.createDataFrame(rows, "id string, n int, v string"), path, order=("n",))
    got = sorted(tuple(r) for r in appends.first_written(spark, path).fillna("-", ["id"]).collect())
    assert got == [("", 1, "x"), (" 1", 2, "b"), ("-", 1, "x"), ("-", 1, "x")]
    more = spark.createDataFrame([("1 ", 0, "z", True), ("2", 0, "z", True), (None, 1, "x", False)], "id string, n int, v string, late boolean")
    assert appends.append_once(more, path) == 1
    got = appends.first_written(spark, path)
    assert got.count() == 6 and got.where("id = '2' and late").count() == 1 and got.where("late is null").count() == 4


def test_unnamed_batches_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        appends.first_written(spark, path)
    appends.append_once(spark.createDataFrame([(1,)], "id long"), path)
    spark.createDataFrame([(2,)], "id long").write.parquet(f"{path}/{appends.BATCHES}/lost")
    assert [r.id for r in appends.first_written(spark, path).collect()] == [1]


# ---- NPZ ----


def test_npz_round_trip(spark, tmp_path):
    spark.dataSource.register(npz.NpzDataSource)
    rows = [(i, [i / 4, -1.5, float(i)]) for i in range(250)]
    frame = spark.createDataFrame(rows, npz.SCHEMA).repartition(3)
    path = f"{tmp_path}/cache"
    frame.write.format("npz").option("rows", 40).mode("append").save(path)
    back = spark.read.format("npz").load(path)
    assert sorted(tuple(r) for r in back.collect()) == rows
    assert back.rdd.getNumPartitions() == len(list((tmp_path / "cache").iterdir())) >= 7  # a partition a file, no drafts
    assert sorted(tuple(r) for r in npz.read_npz(spark, path).collect()) == rows
    spark.createDataFrame([(7, [1.0, 2.0])], npz.SCHEMA).write.format("npz").mode("overwrite").save(path)
    assert [tuple(r) for r in spark.read.format("npz").load(path).collect()] == [(7, [1.0, 2.0])]


def test_npz_of_other_tools_and_broken_rows(spark, tmp_path):
    spark.dataSource.register(npz.NpzDataSource)
    np.savez_compressed(tmp_path / "a.npz", ids=np.array([3, 1]), vecs=np.array([[0.5, 1.0], [2.0, 3.0]]))
    np.savez(tmp_path / "b.npz", ids=np.array([], np.int64), vecs=np.array([]))
    assert sorted(tuple(r) for r in spark.read.format("npz").load(str(tmp_path)).collect()) == [(1, [2.0, 3.0]), (3, [0.5, 1.0])]
    path = f"{tmp_path}/out"
    for bad in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, None)], [(None, [1.0])]):
        with pytest.raises(Exception, match="same length"):
            spark.createDataFrame(bad, npz.SCHEMA).coalesce(1).write.format("npz").mode("append").save(path)
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").glob("**/*.npz"))


# ---- table functions ----


def test_detections_in_sql(spark):
    texts = ['[{"label": "a", "score": "0.5", "box": [1, "2", 3, 4]}, 5, {"label": 3, "box": [1, 2, 3, 4]}, {"box": [1, 2]}]', None, "nope", "{}", "[]", json.dumps([{"label": "x", "score": "high", "box": [1, 2, 3, 4]}])]
    spark.createDataFrame(list(enumerate(texts)), "id int, boxes string").createOrReplaceTempView("answers")
    udtf.register(spark)
    got = [tuple(r) for r in spark.sql("SELECT a.id, d.* FROM answers a, LATERAL detections(a.boxes) d ORDER BY id, place").collect()]
    assert got == [(0, 0, "a", 0.5, 1.0, 2.0, 3.0, 4.0), (0, 2, "3", 0.0, 1.0, 2.0, 3.0, 4.0)]
    same = spark.table("answers").select("id", B.parse_json(spark.table("answers").boxes).alias("d")).selectExpr("id", "inline(d)").count()
    assert same == len(got)


# ---- reviews ----


class Flaky:
    """Fails for ids whose file isn't there yet."""

    name, revision, output = "flaky", "1", "verdict string"

    def __init__(self, folder):
        self.folder = folder

    def infer(self, batch: pd.DataFrame) -> pd.DataFrame:
        import os

        i = int(batch["id"].iloc[0])
        if not os.path.exists(f"{self.folder}/{i}"):
            raise RuntimeError(f"no answer for {i}")
        return pd.DataFrame({"verdict": [f"{batch['text'].iloc[0]}!"]})


def test_errors_are_tried_again_and_ok_never(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", reviews.STORE)
    source, answers = tmp_path / "in", tmp_path / "answers"
    source.mkdir(), answers.mkdir()

    def run(name, rows):
        """A start of the stream over what has arrived, from its checkpoint; the tries of this start."""
        (source / f"{name}.json").write_text("\n".join(json.dumps({"id": i, "text": t}) for i, t in rows))
        frame = spark.readStream.schema("id long, text string").json(str(source))
        out = reviews.reviewed(frame, Flaky(str(answers)), wait_ms=1, most=3)
        before = done() if (tmp_path / "out").exists() else []
        q = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(once=True).start()
        assert q.awaitTermination(120) and q.exception() is None
        after = done()
        return sorted(x for x in after if x not in before)

    def done():
        return [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("id", "verdict", "status", "tries").collect()]

    try:
        (answers / "1").touch()
        first = run("a", [(1, "x"), (2, "y"), (1, "again")])
        assert (1, "x!", "ok", 1) in first and (2, None, "error", 1) in first
        (answers / "2").touch(), (answers / "3").touch()
        second = run("b", [(1, "x"), (3, "z")])  # 2 doesn't arrive again: its time has come
        assert {x[:3] for x in second if x[2] == "ok"} == {(2, "y!", "ok"), (3, "z!", "ok")} and all(x[0] != 1 for x in second)
        assert run("c", [(1, "x"), (2, "y"), (3, "z")]) == []
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
