"""Embedding caches in NPZ files (an array `ids`, an array `vecs` with a row for each id) as a Python data source.

    spark.dataSource.register(NpzDataSource)
    spark.read.format("npz").load(folder)                  # id long, vec array<float>
    rows.write.format("npz").mode("append").save(folder)

A file is a partition. Tasks write files that readers don't see; the commit of all tasks gives them their names. The
folder has to be mounted on all machines, as NPZ is read by place; `read_npz` reads files of any store that Spark reaches.
"""

from __future__ import annotations

import io
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "id long, vec array<float>"
#: Rows of a file that is written.
ROWS = 65_536


def _mounted(path: str) -> str:
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{path}: NPZ files are read and written on mounted file systems; see read_npz")
    return url.path


def _batch(file) -> pa.RecordBatch:
    """The file's rows. No pickled objects are read."""
    with np.load(file, allow_pickle=False) as found:
        ids, vecs = found["ids"].astype(np.int64), np.ascontiguousarray(found["vecs"], np.float32)
    if vecs.ndim != 2 and len(ids) or len(ids) != len(vecs):
        raise ValueError(f"{len(ids)} ids, vectors of shape {vecs.shape}")
    width = vecs.shape[1] if vecs.ndim == 2 else 0
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * width, pa.int32()), pa.array(vecs.reshape(-1)))
    return pa.RecordBatch.from_arrays([pa.array(ids), lists], ["id", "vec"])


class NpzReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        files = [self.folder] if self.folder.endswith(".npz") else sorted(f"{self.folder}/{n}" for n in os.listdir(self.folder) if n.endswith(".npz") and n[0] not in "._")
        return [InputPartition(f) for f in files]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is not None and partition.value is not None:
            yield _batch(partition.value)


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class NpzWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool, rows: int):
        self.folder, self.overwrite, self.rows = folder, overwrite, rows
        self.drafts = f"{folder}/_drafts-{uuid.uuid4().hex}"

    def _save(self, batches: list[pa.RecordBatch]) -> str:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, lists = table.column("id"), table.column("vec").combine_chunks()
        vecs = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
        if ids.null_count or lists.null_count or np.unique(np.diff(lists.offsets.to_numpy())).size > 1:
            raise ValueError("NPZ caches hold an id and a vector of the same length in each row")
        name = f"part-{uuid.uuid4().hex}.npz"
        os.makedirs(self.drafts, exist_ok=True)
        np.savez_compressed(f"{self.drafts}/{name}", ids=ids.to_numpy(), vecs=vecs.reshape(table.num_rows, -1))
        return name

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        out, held = Written(), []
        for batch in iterator:
            at = 0
            while at < batch.num_rows:  # a file has so many rows at most
                part = batch.slice(at, self.rows - sum(b.num_rows for b in held))
                held.append(part)
                at += part.num_rows
                if sum(b.num_rows for b in held) >= self.rows:
                    out.files.append(self._save(held))
                    held = []
        if any(b.num_rows for b in held):
            out.files.append(self._save(held))
        return out

    def commit(self, messages: list[Written | None]) -> None:
        """Files of tasks that were done twice have no message and go with the drafts."""
        os.makedirs(self.folder, exist_ok=True)
        old = [n for n in os.listdir(self.folder) if n.endswith(".npz")] if self.overwrite else []
        for name in (n for m in messages if m for n in m.files):
            os.rename(f"{self.drafts}/{name}", f"{self.folder}/{name}")
        for name in old:
            os.unlink(f"{self.folder}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.drafts, ignore_errors=True)


class NpzDataSource(DataSource):
    """Options: path; rows (of a written file)."""

    @classmethod
    def name(cls) -> str:
        return "npz"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> NpzReader:
        return NpzReader(_mounted(self.options["path"]).rstrip("/"))

    def writer(self, schema: StructType, overwrite: bool) -> NpzWriter:
        if [f.name for f in schema] != ["id", "vec"]:
            raise ValueError("rows to write have the columns id and vec")
        return NpzWriter(_mounted(self.options["path"]).rstrip("/"), overwrite, int(self.options.get("rows", ROWS)))


def read_npz(spark: SparkSession, path: str) -> DataFrame:
    """NPZ files of any store: Spark reads the files' bytes, a file a row, and tasks take them apart."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                yield _batch(io.BytesIO(content.as_buffer()))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select(F.col("content"))
    return files.mapInArrow(rows, SCHEMA)
