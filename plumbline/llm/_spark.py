"""Session helpers shared by the operators: the shared folder and written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a folder of our own, but on one machine only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir has to name a folder that the driver and all executors share (master {master})")
        found = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def mounted(path: str) -> str:
    """The path as open() takes it. Memory-mapped files need a mounted shared folder (NFS, FUSE or one host)."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{path}: memory-mapped files need spark.checkpoint.dir on a mounted file system")
    return url.path


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def gathered(df: DataFrame, share: int = 8) -> DataFrame:
    """df in 1 / share of the session's shuffle partitions, three for each core at least, without a shuffle.

    For what comes out of a shuffle: a task takes its partitions one after another, each whole and in its order, so memory
    is that of one partition still, but far fewer Python workers are fed and far fewer small files committed. Fewer
    partitions than that stay as they are.
    """
    spark = df.sparkSession
    return df.coalesce(max(int(spark.conf.get("spark.sql.shuffle.partitions")) // share, 3 * spark.sparkContext.defaultParallelism))


def written(df: DataFrame, name: str, light: bool = False) -> DataFrame:
    """Cuts the lineage: df as a Parquet table in the shared folder, read again with its own schema. light: see gathered()."""
    path = fresh(df.sparkSession, name)
    (gathered(df) if light else df).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


@contextmanager
def small_batches(spark: SparkSession, most: int = 8 << 20) -> Iterator[None]:
    """What runs within feeds Python in Arrow batches of that many bytes at most, a single longer row apart.

    Wide rows (whole sets) would otherwise come 10,000 at once, held by the JVM and by the worker. The session's own setting comes back at last.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again: what came of them is written itself."""
    for t in tables:
        if path := _paths.pop(t, None):
            spark = t.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until df has no such column (case doesn't count)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8(col) -> F.Column:
    """Bytes of a text; null counts as empty."""
    return F.coalesce(col, F.lit("")).cast("binary")


def numbered(df: DataFrame, keys: list[str], name: str, table_name: str) -> DataFrame:
    """df with the place of each row, from 0, in the order of keys, as a written table.

    Rows are dealt by ranges of all keys, sorted within each, and counted; a range's rows start where those before it
    end. Only the number of rows of each range is brought together. Rows that are equal in all keys fall into one range.
    """
    sort = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()), table_name)
    part, inside = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = sort.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))  # a row for each range
    starts = sizes.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__start"))
    return sort.withColumn("__part", part).join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + inside).drop("__at", "__part", "__start")


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (id, root), root the smallest id that is reached.

    Each round every node tells its root to its neighbours and then jumps to its root's root, so the
    number of rounds follows the logarithm of the longest chain. A node with many links is pre-aggregated
    (min) before the shuffle. Nodes without links are absent. Empty links give no rows.
    """
    pairs = links.select("a", "b").where("a <> b")
    both = written(pairs.union(pairs.select("b", "a")).distinct(), "links", light=True)
    if both.isEmpty():
        return both.select(F.col("a").alias("id"), F.col("b").alias("root"))
    label = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels", light=True)
    held = [label]
    while True:
        heard = both.join(label.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("heard"))
        near = label.join(heard, "id").select("id", F.col("root").alias("old"), F.least("root", "heard").alias("near"))
        # what a root's members have heard reaches the root too, so whole trees hook at once
        hooks = near.groupBy(F.col("old").alias("id")).agg(F.min("near").alias("hook"))
        near = written(near.join(hooks, "id", "left").select("id", "old", F.least("near", F.coalesce("hook", "near")).alias("near")), "near", light=True)
        jump = near.select(F.col("id").alias("near"), F.col("near").alias("far"))
        after = written(near.join(jump, "near", "left").select("id", F.least("near", F.coalesce("far", "near")).alias("root"), "old"), "labels", light=True)
        changed = after.where("root <> old").limit(1).count()
        discard(near, *held)
        label, held = after.select("id", "root"), [after]
        if not changed:
            discard(both)
            return label


def extended(root: DataFrame, links: DataFrame) -> DataFrame:
    """The components root (id, root) with further links (a, b): only roots that links connect are labelled again.

    The same rows as components() of all links. Without further links root itself.
    """
    if links.isEmpty():
        return root
    of = lambda c: root.select(F.col("id").alias(c), F.col("root").alias(f"{c}_root"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    moved = components(between.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    known = root.join(moved.select(F.col("id").alias("root"), F.col("root").alias("to")), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    return written(known.unionByName(moved.join(root.select("id"), "id", "left_anti")), "roots", light=True)
