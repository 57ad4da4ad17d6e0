"""Code for the executors, and tables in the folder that they share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package's code to the executors, once for each application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{top.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, f"{top.name}/{file.relative_to(top)}")
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing has used, below spark.checkpoint.dir; where that is unset, a folder of one machine, in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not shared and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"{(shared or 'file://' + tempfile.mkdtemp(prefix='plumbline-')).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: df as a Parquet table in the shared folder, read again with its own schema."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
