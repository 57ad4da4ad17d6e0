"""Appends that several writers may do at once: an id is in the table once, and the writer that commits first wins.

A table is a folder of batches and a log. A batch is written where no reader looks; then the writer claims the log's next entry, which
names the batch and appears whole or not at all, for one writer only. A writer whose entry was taken drops from its
batch the ids that were committed meanwhile and claims the next one. Lost writers leave batches that nothing names.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG, BATCHES = "log", "batches"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def committed(spark: SparkSession, path: str) -> list[str]:
    """The batches' folders in the order of their commits: one for each append that was ever done."""
    fs, log = _fs(spark, f"{path}/{LOG}")
    if not fs.exists(log):
        return []
    entries = sorted(s.getPath().getName() for s in fs.listStatus(log) if not s.getPath().getName().startswith("."))
    if not entries:
        return []
    rows = spark.read.text([f"{path}/{LOG}/{e}" for e in entries]).select(F.regexp_extract("_metadata.file_name", "(.+)", 1).alias("entry"), "value").collect()
    return [f"{path}/{BATCHES}/{value}" for _, value in sorted(tuple(r) for r in rows)]


def _claim(spark: SparkSession, path: str, version: int, batch: str) -> bool:
    """Whether the log's entry is ours. On mounted file systems a link is made, which fails where there is one; on others the store's
    own rename has to fail where there is a target, as that of HDFS does.
    """
    fs, log = _fs(spark, f"{path}/{LOG}")
    fs.mkdirs(log)
    entry, draft = f"{path}/{LOG}/{version:012d}", f"{path}/{LOG}/.{uuid.uuid4().hex}"
    out = fs.create(_fs(spark, draft)[1], False)
    out.write(bytearray(batch.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            local = lambda p: urlparse(p).path
            try:
                os.link(local(draft), local(entry))
            except FileExistsError:
                return False
            return True
        return fs.rename(_fs(spark, draft)[1], _fs(spark, entry)[1])
    finally:
        fs.delete(_fs(spark, draft)[1], False)


def append_once(rows: DataFrame, path: str, key: str = "id", order: tuple[str, ...] = ()) -> int:
    """Appends rows whose ids the table hasn't, one for each id; returns the number of the commit, from 0.

    Ids are compared as trimmed texts. Of rows with the same id in one append the first by `order` stays, ties and no order by the
    smallest of all other columns. Rows without an id (null or blank) are no repeats of each other: all are appended, each time.
    """
    spark = rows.sparkSession
    name = F.trim(F.col(key).cast("string"))
    blank = F.coalesce(name, F.lit("")) == ""
    rest = [c for c in rows.columns if c not in order]
    one = rows.where(~blank).groupBy(name.alias("__id")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order, *rest)).alias("__r")).select("__r.*")
    todo, seen = one.unionByName(rows.where(blank)), 0
    while True:
        log = committed(spark, path)
        if log[seen:]:
            known = spark.read.parquet(*log[seen:]).select(name.alias("__id"))
            todo = todo.join(known, name == F.col("__id"), "left_anti")
        batch = uuid.uuid4().hex
        todo.write.parquet(f"{path}/{BATCHES}/{batch}")
        if _claim(spark, path, len(log), batch):
            return len(log)
        # what was written has to be checked against the newer commits only
        todo, seen = spark.read.schema(rows.schema).parquet(f"{path}/{BATCHES}/{batch}"), len(log)


def first_written(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """The table's rows: each id as the writer that committed first had it. Columns that a batch lacks are null."""
    log = committed(spark, path)
    if not log:
        raise FileNotFoundError(f"{path} has no committed batch")
    return spark.read.option("mergeSchema", "true").parquet(*log)
