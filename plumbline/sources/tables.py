"""Reading and writing metric tables: typed CSV, directories, resumable appends, shards."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, StringType, StructType

from .. import schemas
from ..functions.order import running
from ..session import new_path  # noqa: F401  (used as tables.new_path)
from . import bitmaps
from .appends import append_once, first_written  # noqa: F401  (used as tables.append_once and tables.first_written)

CSV = {"header": "true", "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """A CSV file with quotes doubled, as texts (or with the schema); unused columns aren't parsed."""
    rows = (spark.read.schema(schema) if schema else spark.read).options(**CSV).csv(path)
    return rows.select(*columns) if columns else rows


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line alone."""
    return spark.read.options(header="true", escape='"').csv(path).columns


def typed(column: Column, kind: DataType) -> Column:
    """A CSV cell as its type: broken numbers are null, lists are JSON, booleans come as True/False or 1/0."""
    if isinstance(kind, StringType):
        return column
    if isinstance(kind, ArrayType):
        return F.from_json(column, kind)
    if isinstance(kind, BooleanType):
        t = F.lower(F.trim(column))
        return F.when(t.isin("true", "1"), True).when(t.isin("false", "0"), False)
    if kind.simpleString() in ("int", "bigint"):
        return column.try_cast("double").cast(kind)
    return column.try_cast(kind)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A metric table from CSV in its declared types, sentinels as nulls. Columns that the file lacks are null."""
    there = header(spark, path)
    rows = read_csv(spark, path)
    sentinels = schemas.SENTINELS.get(table, [])
    out = []
    for f in schemas.schema(table):
        c = typed(F.col(f"`{f.name}`"), f.dataType) if f.name in there else F.lit(None).cast(f.dataType)
        out.append((F.when(c != -1, c) if f.name in sentinels else c).alias(f.name))
    return rows.select(*out)


def write_csv(rows: DataFrame, path: str, table: str | None = None, files: int | None = None) -> None:
    """CSV as other tools read it: arrays as JSON, booleans as True/False, sentinels put back."""
    sentinels = schemas.SENTINELS.get(table or "", [])
    out = []
    for f in rows.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, BooleanType):
            c = F.initcap(c.cast("string"))
        if f.name in sentinels:
            c = F.coalesce(c, F.lit(-1))
        out.append(c.alias(f.name))
    ready = rows.select(*out)
    (ready.coalesce(files) if files else ready).write.mode("overwrite").options(header="true", escape='"', quoteAll="false").csv(path)


def last_by_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of several rows of an id the last one by `order` counts, of equal ones that with the largest other columns; the rest go before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("__r")).select(key, "__r.*")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system that Spark reaches."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def listed(spark: SparkSession, folder: str, skip: tuple[str, ...] = ()) -> dict[str, str]:
    """CSV files of a folder by stem, in the order of their names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    names = sorted(s.getPath().toString() for s in found if s.getPath().getName().endswith(".csv"))
    stems = {n.rsplit("/", 1)[1].removesuffix(".csv"): n for n in names}
    return {k: v for k, v in stems.items() if k not in skip}


def base_path(spark: SparkSession, folder: str, names: tuple[str, ...] = ("validated_corpus.csv", "metrics_input.csv")) -> str:
    """The first of the base files that is there."""
    for n in names:
        if exists(spark, f"{folder}/{n}"):
            return f"{folder}/{n}"
    raise FileNotFoundError(f"{folder} has none of {', '.join(names)}")


def wanted_titles(spark: SparkSession, path: str, wanted: DataFrame, key: str = "tconst") -> DataFrame:
    """Rows of a gzipped TSV whose key is wanted: columns by header, '\\N' is null.

    Keys are texts with a number ('tt0012345'). Bitmaps of the numbers drop nearly all rows in the tasks that read them; what is
    left is joined by the whole keys.
    """
    rows = spark.read.options(header="true", sep="\t", nullValue="\\N", quote="").csv(path)
    number = lambda c: F.regexp_extract(c, r"^\D*(\d{1,18})$", 1).try_cast("bigint")
    keys = wanted.select(key).distinct()
    numbered = rows.withColumn("__n", number(F.col(key)))
    near = bitmaps.wanted(numbered, keys.select(number(F.col(key)).alias("__n")), "__n").drop("__n")
    odd = numbered.where("__n is null").drop("__n").join(keys.where(number(F.col(key)).isNull()), key, "left_semi")
    return near.join(keys, key, "left_semi").union(odd)


def genre_list(genres: Column) -> Column:
    return F.coalesce(F.split(genres, ","), F.array().cast("array<string>"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded images (id, image); Spark decodes on the JVM."""
    return spark.read.format("image").option("dropInvalid", "false").load(folder).select(F.regexp_extract("image.origin", r"([^/]+)\.[^./]+$", 1).alias("id"), "image")


def verified_files(spark: SparkSession, folder: str, pins: DataFrame) -> DataFrame:
    """(name, ok) of files against pinned SHA-256 digests (name, sha256); files without a pin aren't ok."""
    found = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.sha2("content", 256).alias("found"))
    return found.join(pins, "name", "left").select("name", F.coalesce(F.col("found") == F.lower("sha256"), F.lit(False)).alias("ok"))


def require_pins(spark: SparkSession, folder: str, pins: DataFrame) -> None:
    """Refuses a folder of weights: a file whose digest isn't its pin, a file without a pin, and a pinned file that is missing."""
    checked = verified_files(spark, folder, pins)
    lost = pins.join(checked, "name", "left_anti").select("name", F.lit("missing").alias("why"))
    wrong = checked.where(~F.col("ok")).join(pins, "name", "left").select("name", F.when(F.col("sha256").isNull(), "not pinned").otherwise("another digest").alias("why"))
    bad = wrong.union(lost).orderBy("name").limit(20).collect()
    if bad:
        raise ValueError(f"{folder} is refused: " + ", ".join(f"{r.name} ({r.why})" for r in bad))


# ---- control ----


def pending(rows: DataFrame, done: DataFrame, key: str = "id", path: str | None = "poster_path") -> DataFrame:
    """Rows with a path that aren't done."""
    if path:
        rows = rows.where(F.coalesce(F.col(path), F.lit("")) != "")
    return rows.join(done.select(key).distinct(), key, "left_anti")


def pending_reviews(rows: DataFrame, reviews: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a review that went well."""
    return rows.join(reviews.where("status = 'ok'").select(*keys).distinct(), keys, "left_anti")


def with_position(rows: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Global positions from 0 in the given order, counted by ranges and then within them; no task sorts everything."""
    return running(rows, order, F.lit(1), name)


def shard(rows: DataFrame, index: int, count: int, position: str = "position") -> DataFrame:
    """Every count-th row from index on; the whole for a count of 1 or less."""
    if count <= 1:
        return rows
    if not 0 <= index < count:
        raise ValueError(f"shard {index} of {count}")
    return rows.where(F.col(position) % count == index)


def with_errors(result: Column, error: Column, most: int = 200) -> Column:
    """Errors as data: struct(result, error), the error's text cut."""
    return F.struct(result.alias("result"), F.substring(error, 1, most).alias("error"))


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def built(spark: SparkSession, path: str, make: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The table at path, made and written first where it is missing (or with force). make() may call built() for what it needs.

    A table counts as there once its _SUCCESS marker is, so one whose writer was lost is made again.
    """
    marker = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if force or not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
