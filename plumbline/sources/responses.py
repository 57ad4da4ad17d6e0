"""Recorded responses of label and scene services to flat rows, by JSON and array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import variants as V

_BOX = "struct<Left:double,Top:double,Width:double,Height:double>"
LABELS = (
    f"struct<Labels:array<struct<Name:string,Confidence:double,Instances:array<struct<Confidence:double,BoundingBox:{_BOX}>>>>,"
    "ImageProperties:struct<Quality:struct<Brightness:double,Sharpness:double,Contrast:double>,"
    "DominantColors:array<struct<HexCode:string,PixelPercent:double>>>>"
)
FACES = (
    f"struct<FaceDetails:array<struct<BoundingBox:{_BOX},Emotions:array<struct<Type:string,Confidence:double>>,"
    "Gender:struct<Value:string>,AgeRange:struct<Low:int,High:int>>>>"
)
# Fixed value: the verdicts that a scene review may give.
VERDICTS = ["poster", "not_poster", "uncertain"]


def _box(b: Column) -> Column:
    return F.transform(F.array(b["Left"], b["Top"], b["Width"], b["Height"]), lambda v: F.round(F.coalesce(v, F.lit(0.0)), 4))


def label_service(rows: DataFrame, labels: str, faces: str, vocabularies: dict[str, list[str]], key: str = "id") -> DataFrame:
    """JSON texts of label and face responses to one flat row for each key; vocabularies: flag -> lower-case label names.

    A label's boxes are those of its instances. The largest face speaks for the picture. Missing parts give 0, '' or null ages.
    """
    r = rows.select(key, F.from_json(labels, LABELS).alias("l"), F.from_json(faces, FACES).alias("f"))
    none = lambda kind: F.array().cast(kind)
    found = F.coalesce(F.col("l.Labels"), none(f"array<struct<Name:string,Confidence:double,Instances:array<struct<Confidence:double,BoundingBox:{_BOX}>>>>"))
    r = r.withColumn("found", found).withColumn("named", F.transform("found", lambda x: F.struct(x["Name"].alias("name"), (x["Confidence"] / 100).alias("conf"))))
    instances = lambda x: F.filter(F.coalesce(x["Instances"], none(f"array<struct<Confidence:double,BoundingBox:{_BOX}>>")), lambda i: i["BoundingBox"].isNotNull())
    boxes = F.flatten(F.transform("found", lambda x: F.transform(instances(x), lambda i: F.struct(x["Name"].alias("label"), F.round(F.coalesce(i["Confidence"], x["Confidence"]) / 100, 4).alias("score"), _box(i["BoundingBox"]).alias("box")))))
    area = lambda f: f["BoundingBox"]["Width"] * f["BoundingBox"]["Height"]
    sized = F.transform(F.col("f.FaceDetails"), lambda f, i: F.struct((-area(f)).alias("minus"), i.alias("place"), f.alias("f")))
    r = r.withColumn("boxes", boxes).withColumn("faces", F.transform(F.array_sort(sized), lambda x: x["f"]))
    first = F.get("faces", 0)
    mood = F.get(F.array_sort(F.transform(first["Emotions"], lambda e, i: F.struct((-e["Confidence"]).alias("minus"), i.alias("place"), e["Type"].alias("type")))), 0)
    quality = lambda c: F.round(F.coalesce(F.col(f"l.ImageProperties.Quality.{c}"), F.lit(0.0)), 2)
    colours = F.slice(F.coalesce(F.col("l.ImageProperties.DominantColors"), none("array<struct<HexCode:string,PixelPercent:double>>")), 1, 5)
    confident = lambda e: F.concat(e["name"], F.lit(":"), F.format_string("%.2f", e["conf"]))
    return r.select(
        key,
        F.array_join(F.transform(F.slice("named", 1, 10), confident), "|").alias("labels"),
        F.coalesce(F.get("named", 0)["name"], F.lit("")).alias("top"),
        F.round(F.coalesce(F.get("named", 0)["conf"], F.lit(0.0)), 4).alias("top_conf"),
        *[L.vocabulary_max(F.col("named"), v).alias(flag) for flag, v in vocabularies.items()],
        F.size("boxes").alias("n_boxes"),
        F.when(F.size("boxes") > 0, F.to_json("boxes")).otherwise("").alias("label_boxes"),
        quality("Brightness").alias("bright"), quality("Sharpness").alias("sharp"), quality("Contrast").alias("contrast"),
        F.array_join(F.transform(colours, lambda c: F.concat(F.coalesce(c["HexCode"], F.lit("")), F.lit(":"), F.round(F.coalesce(c["PixelPercent"], F.lit(0.0)), 1).cast("string"))), "|").alias("colors"),
        F.coalesce(F.nullif(F.size("faces"), F.lit(-1)), F.lit(0)).alias("n_faces"),
        F.coalesce(F.concat(mood["type"], F.lit(":"), F.format_string("%.2f", -mood["minus"] / 100)), F.lit("")).alias("emotion"),
        F.coalesce(first["Gender"]["Value"], F.lit("")).alias("gender"),
        first["AgeRange"]["Low"].alias("age_lo"), first["AgeRange"]["High"].alias("age_hi"),
        F.coalesce(F.array_join(F.transform("faces", lambda f: F.array_join(F.transform(_box(f["BoundingBox"]), lambda v: v.cast("string")), ",")), "|"), F.lit("")).alias("face_boxes"),
    )


def _listed(value: Column) -> Column:
    """'a|b' of a list's entries that aren't blank, or one value as text."""
    many = F.array_join(F.filter(F.transform(V.items(value), lambda x: F.trim(V.text(x))), lambda x: x != ""), "|")
    return F.when(V.empty(value), "").when(V.is_list(value), many).otherwise(F.trim(V.text(value)))


def _entry(value: Column) -> Column:
    """struct(name, conf) of an object, conf as it came, from `conf` or else `confidence`."""
    conf = F.coalesce(V.field(value, "conf"), V.field(value, "confidence"))
    return F.struct(F.trim(F.when(V.empty(V.field(value, "name")), "").otherwise(V.text(V.field(value, "name")))).alias("name"), conf.alias("conf"))


def _confidences(value: Column) -> Column:
    """'name:0.90|...' of a list of objects; entries of other kinds as text, objects without a name left out; a text as it is."""
    sure = lambda c: F.when(V.number(c).isNull(), F.coalesce(V.text(c), F.lit(""))).otherwise(F.format_string("%.2f", V.number(c)))
    told = lambda e: F.when(e["name"] != "", F.concat(e["name"], F.lit(":"), sure(e["conf"])))
    many = F.array_join(F.transform(V.items(value), lambda x: F.when(V.is_object(x), told(_entry(x))).otherwise(V.text(x))), "|")
    return F.when(V.empty(value), "").when(V.is_list(value), many).when(V.is_string(value), V.text(value)).otherwise("")


def _most_confident(value: Column) -> Column:
    """struct(name, conf) of a list's most confident named object, the first of equal ones; conf is 0 where it is no number."""
    entries = F.transform(F.filter(V.items(value), V.is_object), _entry)
    return L.top_entry(F.coalesce(F.transform(entries, lambda e: F.struct(e["name"].alias("name"), V.number(e["conf"]).cast("string").alias("conf"))), F.array().cast("array<struct<name:string,conf:string>>")))


def scene_service(rows: DataFrame, text: str, key: str = "id") -> DataFrame:
    """A scene description's text (JSON, maybe fenced) to one flat row for each key; a text that is no JSON object gives an error.

    Fields are read one by one, so a field or an entry of another kind than expected costs only itself: scores and counts
    may be texts, `mood` may be one value, lists may hold texts beside objects. Missing and unusable parts give '' or 0.
    """
    r = rows.select(key, V.parsed(L.unfenced(F.col(text))).alias("s"))
    broken = ~V.is_object(F.col("s"))
    of = lambda name: V.field(F.col("s"), name)
    plain = lambda name: F.when(V.empty(of(name)), "").otherwise(V.text(of(name)))
    number = lambda name: V.number(of(name))
    top = _most_confident(of("labels"))
    return r.select(
        key,
        L.cleaned(plain("credits_text"), 500).alias("credits_text"), L.cleaned(plain("other_text"), 500).alias("other_text"),
        _listed(of("mood")).alias("mood"), _confidences(of("fear_labels")).alias("fear_labels"),
        *[L.score01(number(c)).alias(c) for c in ("weapon", "monster", "person", "animal")],
        L.whole_count(number("face_count")).alias("face_count"),
        L.enumerated(plain("poster_qa_verdict"), VERDICTS).alias("qa_verdict"), L.cleaned(plain("poster_qa_reason"), 300).alias("qa_reason"),
        _confidences(of("labels")).alias("labels"), top["name"].alias("top_label"), top["conf"].alias("top_label_conf"),
        L.cleaned(plain("description"), 400).alias("description"),
        F.when(broken, "not a JSON object").alias("error"),
    )
