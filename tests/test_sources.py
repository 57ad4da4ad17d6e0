"""Files, control, plans, providers, responses and streams."""

import json
from functools import reduce

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators import assemble, sampling, time_joins
from plumbline.plans.rules import SIGNALS
from plumbline.operators.evaluate import decide
from plumbline.session import ship
from plumbline.sources import providers, responses, tables
from plumbline.streaming import incremental


def test_csv_round_trip(spark, tmp_path):
    text = 'id,title,year,symmetry,thirds_dist,n_blocks,align_score\n1,"A ""quoted"", title",1990,0.5,-1,2,-1\n2,,x,,0.25,3.0,0.1\n'
    (tmp_path / "g.csv").write_text(text)
    rows = tables.read_table(spark, f"{tmp_path}/g.csv", "geometric_composition").orderBy("id").collect()
    assert rows[0]["title"] == 'A "quoted", title' and rows[0]["thirds_dist"] is None and rows[0]["align_score"] is None
    assert rows[1]["thirds_dist"] == 0.25 and rows[1]["n_blocks"] == 3 and rows[1]["symmetry"] is None and rows[1]["harmony"] is None
    tables.write_csv(tables.read_table(spark, f"{tmp_path}/g.csv", "geometric_composition"), f"{tmp_path}/out", "geometric_composition", 1)
    again = tables.read_csv(spark, f"{tmp_path}/out").orderBy("id").collect()
    assert again[0]["thirds_dist"] == "-1.0" and tables.header(spark, f"{tmp_path}/g.csv")[0] == "id"
    assert list(tables.listed(spark, str(tmp_path), skip=("nothing",))) == ["g"]
    with pytest.raises(FileNotFoundError):
        tables.base_path(spark, str(tmp_path))


def test_resume_shards_and_appends(spark, tmp_path):
    rows = spark.createDataFrame([("1", "p"), ("2", ""), ("3", "p"), ("4", None)], "id string, poster_path string")
    done = spark.createDataFrame([("1",)], "id string")
    assert [r["id"] for r in tables.pending(rows, done).collect()] == ["3"]
    six = tables.with_position(spark.range(6), ["id"])
    assert [r["id"] for r in tables.shard(six, 0, 2).orderBy("id").collect()] == [0, 2, 4]
    assert tables.shard(six, 0, 1).count() == 6
    with pytest.raises(ValueError):
        tables.shard(six, 2, 2)
    path = f"{tmp_path}/once"
    tables.append_once(spark.createDataFrame([("1", "a"), ("2", "a")], "id string, v string"), path)
    tables.append_once(spark.createDataFrame([("2", "b"), ("3", "b")], "id string, v string"), path)
    assert {r["id"]: r["v"] for r in tables.first_written(spark, path).collect()} == {"1": "a", "2": "a", "3": "b"}


def test_gz_titles_and_pins(spark, tmp_path):
    import gzip
    import hashlib

    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write("tconst\ttitleType\tgenres\ntt1\tmovie\tHorror,Drama\ntt2\tshort\t\\N\n")
    got = tables.wanted_titles(spark, f"{tmp_path}/b.tsv.gz", spark.createDataFrame([("tt1",), ("tt2",)], "tconst string")).withColumn("g", tables.genre_list(F.col("genres"))).orderBy("tconst").collect()
    assert [r["g"] for r in got] == [["Horror", "Drama"], []]
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.bin").write_bytes(b"x")
    (tmp_path / "w/b.bin").write_bytes(b"y")
    pins = spark.createDataFrame([("a.bin", hashlib.sha256(b"x").hexdigest()), ("b.bin", "0")], "name string, sha256 string")
    assert {r["name"]: r["ok"] for r in tables.verified_files(spark, f"{tmp_path}/w", pins).collect()} == {"a.bin": True, "b.bin": False}
    right = [("a.bin", hashlib.sha256(b"x").hexdigest()), ("b.bin", hashlib.sha256(b"y").hexdigest().upper())]
    tables.require_pins(spark, f"{tmp_path}/w", spark.createDataFrame(right, "name string, sha256 string"))
    for bad, why in ((right[:1], "b.bin .not pinned"), ([right[0], ("b.bin", "0")], "b.bin .another digest"), ([*right, ("c.bin", "0")], "c.bin .missing")):
        with pytest.raises(ValueError, match=why):
            tables.require_pins(spark, f"{tmp_path}/w", spark.createDataFrame(bad, "name string, sha256 string"))


def test_built_makes_what_is_missing(spark, tmp_path):
    made: list[str] = []

    def target(name, *needs, force=False):
        def make():
            made.append(name)
            return reduce(lambda a, b: a.union(b), [target(n) for n in needs], spark.createDataFrame([(name,)], "name string"))

        return tables.built(spark, f"{tmp_path}/{name}", make, force)

    assert {r["name"] for r in target("master", "a", "b").collect()} == {"master", "a", "b"} and made == ["master", "a", "b"]
    assert target("master", "a", "b").count() == 3 and len(made) == 3
    assert target("a", force=True).count() == 1 and made[3:] == ["a"]
    # a table without its marker is made again
    (tmp_path / "b" / "_SUCCESS").unlink()
    assert target("b").count() == 1 and made[4:] == ["b"]


def test_rules(spark):
    wide = spark.createDataFrame([(True, False), (None, True)], "detector boolean, describer boolean")
    rows = decide(wide, SIGNALS).collect()
    assert rows[0]["weapon"] is True and rows[0]["animal"] is False and rows[1]["weapon"] is True


def test_disagreements_come_first(spark):
    data = [("1", "x", True), ("1", "y", True), ("2", "x", False), ("2", "y", False), ("3", "x", True), ("3", "y", False), ("4", "x", False), ("4", "y", True), ("5", "x", None)]
    got = sampling.disagreement_first(spark.createDataFrame(data, "id string, engine string, verdict boolean"), "id", "verdict", 4)
    assert {r["id"]: r["kind"] for r in got.collect()} == {"1": "positive", "2": "negative", "3": "disagree", "4": "disagree"}


def test_stratified_backfills(spark):
    rows = spark.createDataFrame([(i, 0.1 if i < 50 else 0.9) for i in range(60)], "id int, score double")
    got = sampling.stratified(rows, sampling.confidence_bucket(F.col("score")), {"low": 0.6, "mid": 0.25, "high": 0.15}, 20, "id").collect()
    assert len(got) == 20 and sum(r["bucket"] == "low" for r in got) >= 10


def test_master_keeps_first_rows(spark):
    base = spark.createDataFrame([("1",), ("2",)], "id string")
    metric = spark.createDataFrame([("1", "t", 5, 1), ("1", "t", 6, 0)], "id string, title string, v int, pos int")
    got = assemble.master(base, {"m": metric}, order={"m": ["pos"]}).orderBy("id").collect()
    assert got[0].asDict() == {"id": "1", "m_v": 6, "m_pos": 0} and got[1]["m_v"] is None
    faces = spark.createDataFrame([("1", 1, "calm", 0.5), ("1", 0, None, 0.1)], "id string, face_idx int, label string, score double")
    assert tuple(assemble.rollup(faces, "id", "face_idx", "label", "score").first()) == ("1", 2, "calm:0.5")


@pytest.fixture
def embedder():
    """A provider of unit vectors drawn from a hash of the row's content."""

    class HashEmbedder:
        name, revision, output = "hash", "1", "vec array<float>"

        def infer(self, batch):
            import zlib

            import numpy as np
            import pandas as pd

            draw = lambda x: np.random.default_rng(zlib.crc32(x.encode())).normal(size=8)
            return pd.DataFrame({"vec": [(v / np.linalg.norm(v)).tolist() for v in map(draw, batch["content"])]})

    return HashEmbedder()


def test_providers(spark, embedder):
    ship(spark)
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "id string, content string")
    got = {r["id"]: r for r in providers.run(rows, embedder).collect()}
    assert got["a"]["vec"] == got["c"]["vec"] != got["b"]["vec"] and got["a"]["revision"] == "1" and got["a"]["error"] is None
    assert abs(sum(x * x for x in got["a"]["vec"]) - 1) < 1e-5


def test_broken_rows_become_errors(spark, embedder):
    ship(spark)
    rows = spark.createDataFrame([("a", "x")], "id string, wrong string")
    row = providers.run(rows, embedder).first()
    assert row["vec"] is None and row["error"]


def test_responses(spark):
    labels = {"Labels": [{"Name": "Gun", "Confidence": 90, "Instances": [{"Confidence": 80, "BoundingBox": {"Left": 0.1, "Top": 0.2, "Width": 0.3, "Height": 0.4}}]}, {"Name": "Cat", "Confidence": 60}], "ImageProperties": {"Quality": {"Brightness": 50.123}, "DominantColors": [{"HexCode": "#fff", "PixelPercent": 33.33}]}}
    small = {"BoundingBox": {"Left": 0, "Top": 0, "Width": 0.1, "Height": 0.1}}
    large = {"BoundingBox": {"Left": 0, "Top": 0, "Width": 0.5, "Height": 0.5}, "Emotions": [{"Type": "CALM", "Confidence": 10}, {"Type": "FEAR", "Confidence": 88.8}], "Gender": {"Value": "Female"}, "AgeRange": {"Low": 20, "High": 30}}
    rows = spark.createDataFrame([("1", json.dumps(labels), json.dumps({"FaceDetails": [small, large]})), ("2", "{}", "{}")], "id string, l string, f string")
    got = {r["id"]: r for r in responses.label_service(rows, "l", "f", {"weapon": ["gun"], "animal": ["cat", "dog"]}).collect()}
    one, two = got["1"], got["2"]
    assert (one["labels"], one["top"], one["top_conf"], one["weapon"], one["animal"], one["n_boxes"]) == ("Gun:0.90|Cat:0.60", "Gun", 0.9, 0.9, 0.6, 1)
    assert (one["n_faces"], one["emotion"], one["gender"], one["age_lo"], one["bright"], one["colors"]) == (2, "FEAR:0.89", "Female", 20, 50.12, "#fff:33.3")
    assert (two["labels"], two["top"], two["weapon"], two["n_faces"], two["emotion"], two["label_boxes"]) == ("", "", 0.0, 0, "", "")
    scene = '```json\n{"credits_text": "a\\nb ", "mood": ["dark", " "], "fear_labels": [{"name": "fire", "conf": 0.456}], "labels": [{"name": "x", "conf": 0.2}, {"name": "y", "confidence": 0.9}], "weapon": 1.5, "face_count": "2.7", "poster_qa_verdict": "Poster"}\n```'
    rows = spark.createDataFrame([("1", scene), ("2", "no json")], "id string, t string")
    got = {r["id"]: r for r in responses.scene_service(rows, "t").collect()}
    one, two = got["1"], got["2"]
    assert (one["credits_text"], one["mood"], one["fear_labels"], one["top_label"], one["weapon"], one["face_count"], one["qa_verdict"], one["error"]) == ("a b", "dark", "fire:0.46", "y", 1.0, 2, "poster", None)
    assert two["error"] and two["qa_verdict"] == "uncertain" and two["weapon"] == 0.0


def test_stream_appends_new_ids_once(spark, tmp_path):
    schema = StructType.fromDDL("id string, v string")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.csv").write_text("id,v\n1,a\n1,b\n2,a\n")
    run = lambda: incremental.append_new(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/ck", "id").awaitTermination(120)
    run()
    (tmp_path / "in/2.csv").write_text("id,v\n2,c\n3,c\n")
    run()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r["id"] for r in got) == ["1", "2", "3"]


def test_as_of_takes_the_last_one(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 3, 30), ("a", 5, 50), ("a", 6, 60)], "k string, t int, v int")
    got = {(r["k"], r["t"]): r["r_v"] for r in time_joins.as_of(left, right, "k", "t", ["v"]).collect()}
    assert got == {("a", 5): 50, ("a", 1): None, ("b", 5): None}


def test_pins_of_providers(spark, embedder):
    from plumbline.sources import providers

    ship(spark)
    rows = spark.createDataFrame([("1", "x")], "id string, content string")
    assert providers.run(rows, embedder, pins={embedder.name: embedder.revision}).count() == 1
    for pins in ({}, {embedder.name: "main"}, {embedder.name: "another"}):
        with pytest.raises(ValueError, match=embedder.name):
            providers.run(rows, embedder, pins=pins)
