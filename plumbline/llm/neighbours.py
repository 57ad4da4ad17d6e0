"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded sample of the distinct vectors (SAMPLE rows), every row is indexed: it goes down to the
nearest child at each node. A query walks the tree through a priority queue of nodes by their distance and visits the
leaves in that order. How many it visits is calibrated on the sample: leaves are added until the neighbours found reach
TARGET of the true ones, which brute force over the sample gives; a query goes on where its leaves hold too few rows.
Largest inner products are nearest neighbours after each row gets one more component, sqrt(M^2 - |x|^2).

Equal vectors are one class with its smallest ids, as many as an answer can use, so a vector with very many copies costs
no more than another one. SHELF leaves are searched together, in blocks of about BLOCK classes; a task holds one block
at a time and the queries that visit it pass by in small batches, so memory doesn't follow the table. The number of
leaves is the sample's: leaves grow with the table, and with them what a query reads.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import written

SAMPLE = 20_000
BRANCH = 16
LEAF = 48
TARGET = 0.985
CALIBRATION = 256
#: Leaves that one task searches together, and classes of them at most, roughly.
SHELF = 32
BLOCK = 16_384


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Assignment of rows to at most k clusters, by Lloyd's rounds."""
    centres = x[rng.choice(len(x), k, replace=False)]
    near = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1) - 2 * (x @ centres.T), axis=1)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return near


@dataclass
class Tree:
    #: rows: nodes; a leaf has no children
    centres: np.ndarray
    children: list[list[int]]
    leaf_of: dict[int, int] = field(default_factory=dict)
    visits: int = 1
    norm: float = 1.0

    def __post_init__(self):
        self.leaf_of = {n: k for k, n in enumerate(n for n, c in enumerate(self.children) if not c)}

    def extend(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm**2 - (x**2).sum(1), 0))
        return np.c_[x, extra]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, going down to the nearest child."""
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf_of[node]
                continue
            c = self.centres[self.children[node]]
            near = np.argmin((c**2).sum(1) - 2 * (x[rows] @ c.T), axis=1)
            todo += [(child, rows[near == k]) for k, child in enumerate(self.children[node]) if (near == k).any()]
        return out

    def order(self, x: np.ndarray) -> Iterator[Iterator[int]]:
        """For each row, its leaves, best bin first."""
        away = (self.centres**2).sum(1) - 2 * (x @ self.centres.T)
        for d in away:
            yield self._walk(d)

    def _walk(self, d: np.ndarray) -> Iterator[int]:
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if not self.children[node]:
                yield self.leaf_of[node]
            for child in self.children[node]:
                heapq.heappush(heap, (d[child], child))


def fit(x: np.ndarray, k: int, norm: float, seed: int = 3) -> Tree:
    """A tree over the sample x, with its number of visits calibrated for k neighbours."""
    rng = np.random.default_rng(seed)
    bare = Tree(np.zeros((1, x.shape[1] + 1)), [[]], norm=norm)
    full = bare.extend(x)
    centres, children = [full.mean(0) if len(x) else bare.centres[0]], [[]]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= LEAF:
            continue
        near = _kmeans(full[rows], min(BRANCH, max(2, len(rows) // (LEAF // 2))), rng)
        groups = [rows[near == g] for g in np.unique(near)]
        if len(groups) < 2:
            continue
        for g in groups:
            centres.append(full[g].mean(0))
            children.append([])
            children[node].append(len(centres) - 1)
            todo.append((len(centres) - 1, g))
    tree = Tree(np.array(centres), children, norm=norm)
    total = len(tree.leaf_of)
    queries = rng.choice(len(x), min(CALIBRATION, len(x)), replace=False)
    if total > 1 and len(queries):
        own = tree.leaves(full)
        near = min(k, len(x) - 1)
        products = x[queries] @ x.T
        products[np.arange(len(queries)), queries] = -np.inf
        best = np.argpartition(-products, near - 1, axis=1)[:, :near] if near else np.zeros((len(queries), 0), int)
        places = np.empty((len(queries), total), np.int64)
        for i, walk in enumerate(tree.order(tree.extend(x[queries], query=True))):
            places[i, list(walk)] = np.arange(total)
        needed = np.sort(places[np.arange(len(queries))[:, None], own[best]], axis=None)
        tree.visits = min(total, int(needed[min(len(needed) - 1, int(TARGET * len(needed)))]) + 1) if len(needed) else total
    return tree


def _valid(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec, norm): rows that take part, with the vector as bytes of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("v")
            at = lists.offsets.to_numpy()
            x = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)[at[0] : at[-1]] + 0.0  # null is nan; -0.0 counts as 0.0
            at = at - at[0]
            wrong, full = np.r_[0, np.cumsum(~np.isfinite(x))], np.r_[0, np.cumsum(x != 0)]
            fit = lists.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            fit &= (wrong[at[1:]] == wrong[at[:-1]]) & (full[at[1:]] > full[at[:-1]])
            vectors = [x[at[i] : at[i + 1]] for i in np.flatnonzero(fit)]
            norms = [float(np.sqrt(v @ v)) for v in vectors]
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(fit)), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array(norms, pa.float64())], ["vec_id", "vec", "norm"])

    return rows.selectExpr(f"cast(`{id_col}` as long) as vec_id", f"cast(`{vec_col}` as array<double>) as v").mapInArrow(run, "vec_id long, vec binary, norm double")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


class _Search:
    """Searches blocks of an index with the queries that come after each, a few at a time."""

    def __init__(self, k: int):
        self.k = k

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (shelf, block, role): the block's classes, role 0, then its queries. Gives (qid, cid, low, score)."""
        at, parts, block = None, [], None
        for batch in batches:
            shelf, of, role = (batch.column(c).to_numpy() for c in ("shelf", "block", "role"))
            edges = np.flatnonzero(np.r_[True, (shelf[1:] != shelf[:-1]) | (of[1:] != of[:-1]) | (role[1:] != role[:-1])])
            for i, j in zip(edges.tolist(), np.r_[edges[1:], len(shelf)].tolist(), strict=True):
                rows = batch.slice(i, j - i)
                if at != (shelf[i], of[i]):
                    at, parts, block = (shelf[i], of[i]), [], None
                ids, raw = rows.column("id").to_numpy(), _matrix([x.as_buffer() for x in rows.column("vec")])
                if role[i] == 0:
                    parts.append((raw, ids, rows.column("low").to_numpy(), rows.column("leaf").to_numpy() % SHELF))
                elif parts:
                    block = block or tuple(np.concatenate(p) for p in zip(*parts, strict=True))
                    for q in range(0, len(ids), 256):
                        yield self._best(raw[q : q + 256], ids[q : q + 256], rows.column("leaves").slice(q, 256).to_pylist(), *block)

    def _best(self, asking, qid, leaves, have, cid, low, leaf) -> pa.RecordBatch:
        """The k + 1 best classes of a block for each query by exact product, ties by their smallest id.

        The product of matrices errs in its last bits, so all that come within its error of place k + 1 are compared exactly.
        """
        most = min(self.k + 1, len(have))
        visited = np.zeros((len(qid), SHELF), bool)
        for row, at in enumerate(leaves):
            visited[row, at] = True
        away = np.where(visited[:, leaf], -(asking @ have.T), np.inf)
        error = 4 * have.shape[1] * np.finfo(float).eps * np.sqrt((asking**2).sum(1)) * np.sqrt((have**2).sum(1).max())
        last = np.partition(away, most - 1, axis=1)[:, most - 1] + error
        row, best = np.nonzero((away <= last[:, None]) & np.isfinite(away))
        exact = np.concatenate([(asking[row[i : i + 4096]] * have[best[i : i + 4096]]).sum(1) for i in range(0, len(row), 4096)] or [np.zeros(0)])
        order = np.lexsort((low[best], -exact, row))
        row, best, exact = row[order], best[order], exact[order]
        first = np.searchsorted(row, np.arange(len(qid)))
        keep = np.arange(len(row)) - first[row] < most
        row, best, exact = row[keep], best[keep], exact[keep]
        return pa.RecordBatch.from_arrays([pa.array(qid[row]), pa.array(cid[best]), pa.array(low[best]), pa.array(exact)], ["qid", "cid", "low", "score"])


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row whose id is divisible by `every`, its k nearest other rows found.

    Null vectors, zero vectors, vectors with null or non-finite components and rows without an id take no part, nor do
    vectors of another length than most have (of the smallest such length, if several are as frequent). Ids are cast to
    long. Ties go to the smaller id. A repeated row counts once, and rows with a query's own id are never its
    neighbours. With k or fewer other rows all of them are returned. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = written(_valid(vectors, id_col, vec_col), "vectors")
    length = rows.groupBy(F.length("vec").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).orderBy(F.desc("n"), "length").first()
    if not length:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.length("vec") == length["length"])
    # the k + 1 smallest ids of each vector; the limit on ranks is applied before the shuffle too
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = rows.select("vec", "vec_id").groupBy("vec", "vec_id").agg(F.count(F.lit(1)).alias("n")).drop("n").withColumn("r", rank).where(F.col("r") <= k + 1)
    classes = written(few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("cid", F.monotonically_increasing_id()), "classes")
    sample = classes.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").toPandas()
    tree = fit(_matrix(sample["vec"]), k, float(length["norm"]))
    shared = spark.sparkContext.broadcast(tree)

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                f["leaf"] = shared.value.leaves(shared.value.extend(_matrix(f["vec"]))).astype("int32")
                yield f[["leaf", "cid", "vec", "ids"]]

    index = written(classes.mapInPandas(indexed, "leaf int, cid long, vec binary, ids array<long>"), "index")
    # a row for each leaf of the tree
    leaves = index.groupBy("leaf").agg(F.sum(F.size("ids")).alias("n"), F.count(F.lit(1)).alias("classes")).collect()
    sizes = {r["leaf"]: r["n"] for r in leaves}
    shelves: dict[int, int] = {}
    for r in leaves:
        shelves[r["leaf"] // SHELF] = shelves.get(r["leaf"] // SHELF, 0) + r["classes"]
    blocks = spark.createDataFrame([(k, -(-n // BLOCK)) for k, n in shelves.items()], "shelf int, blocks int")
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "vec").distinct()
    asked = written(asked.join(classes.select("vec", F.col("cid").alias("qid")), "vec").select("vec_id", "qid", "vec"), "queries")

    def routed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for f in frames:
            if not len(f):
                continue
            out = []
            for qid, vec, walk in zip(f["qid"], f["vec"], t.order(t.extend(_matrix(f["vec"]), query=True)), strict=True):
                held, shelves = 0, {}
                for n, leaf in enumerate(walk):
                    if n >= t.visits and held > 2 * k:
                        break
                    if leaf in sizes:
                        held += sizes[leaf]
                        shelves.setdefault(leaf // SHELF, []).append(leaf % SHELF)
                out += [(qid, vec, shelf, leaves) for shelf, leaves in shelves.items()]
            yield pd.DataFrame(out, columns=["qid", "vec", "shelf", "leaves"])

    visits = asked.select("qid", "vec").distinct().mapInPandas(routed, "qid long, vec binary, shelf int, leaves array<int>")
    blocks = F.broadcast(blocks)  # a row for each SHELF leaves
    visits = visits.join(blocks, "shelf").select("shelf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), F.col("qid").alias("id"), "vec", F.lit(None).cast("long").alias("low"), F.lit(None).cast("int").alias("leaf"), "leaves")
    by_block = index.withColumn("shelf", F.floor(F.col("leaf") / SHELF).cast("int")).join(blocks, "shelf")
    by_block = by_block.select("shelf", F.pmod(F.col("cid"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), F.col("cid").alias("id"), "vec", F.col("ids")[0].alias("low"), "leaf", F.lit(None).cast("array<int>").alias("leaves"))
    sorted_ = by_block.unionByName(visits).repartition("shelf", "block").sortWithinPartitions("shelf", "block", "role")
    found = sorted_.mapInArrow(_Search(k), "qid long, cid long, low long, score double")
    # the k + 1 best classes of a query, ties by their smallest ids: any row beyond them has k better ones, each in another class
    ranked = Window.partitionBy("qid").orderBy(F.desc("score"), "low")
    kept = written(found.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k + 1).select("qid", "cid", "score"), "found")
    shared.destroy()
    lists = kept.join(classes.select("cid", "ids"), "cid").groupBy("qid").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    pairs = F.flatten(F.transform("found", lambda c: F.transform(c["ids"], lambda i: F.struct((-c["score"]).alias("minus"), i.alias("vec_id")))))
    near = asked.select(F.col("vec_id").alias("query_id"), "qid").join(lists, "qid")
    near = near.withColumn("near", F.slice(F.array_sort(F.filter(pairs, lambda p: p["vec_id"] != F.col("query_id"))), 1, k))
    return near.select("query_id", F.posexplode("near").alias("at", "p")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("p.vec_id").alias("vec_id"), (-F.col("p.minus")).alias("score"))
