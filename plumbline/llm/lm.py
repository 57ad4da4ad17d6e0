"""Language-model scores from an Elias-Fano n-gram trie.

Level 1 holds the training words: per shard an Elias-Fano sequence of 64-bit word identities, their counts and quantised
backoff weights; a word's place in it is its number. Level 2 holds the
word pairs seen at least PRUNE times: per shard, an Elias-Fano sequence of contexts, one of pointers to their successors,
one of the successors' word numbers (each context's run lifted by the last value before it, so that the whole is
monotone) and quantised discounted probabilities. A pair is looked up by a successor search within its context's run.

P(b | a) = max(n(ab) - D, 0) / n(a) + backoff(a) * P(b) with P(b) = (n(b) + 0.5) / (N + 0.5 * (V + 1)), where backoff(a) is what the
kept pairs of a leave over, so probabilities over all words and one unknown word sum to 1. Texts begin in the context of
an end. PRUNE = 1 keeps all pairs; above it, pairs below PRUNE would leave their mass to the backoff.

All training rows are counted. Tasks count their own slices with numpy, shards of the trie are built by separate tasks
and written to the shared folder, and scoring tasks map them into memory, so nothing of the corpus passes the driver.
A context with very many successors is spread over all shards. The shared folder has to be mounted (see mounted()).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import fresh, mounted, written
from ._words import mix, pieces, span_hashes, words
from .elias_fano import EliasFano
from .toxicity import held_out

DISCOUNT = 0.75
PRUNE = 1
END = np.uint64(0x454E44)  # identity of the end of a text
#: Step of quantised log10 values.
STEP = 1 / 4096
SHARD_TOKENS = 2_000_000
SHARD_WORDS = 500_000
SLICE = 6 << 20
#: Distinct keys that a task counts before it hands them on.
HELD = 2_500_000


def _save(path: str, arrays: list[np.ndarray]) -> None:
    """One file: number of arrays, kinds and sizes, then the arrays, each at a multiple of 8. A retried task replaces it whole."""
    head = np.zeros((len(arrays), 2), np.int64)
    for k, a in enumerate(arrays):
        head[k] = (a.dtype.itemsize, len(a))
    temporary = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(temporary, "wb") as out:
        out.write(np.int64(len(arrays)).tobytes() + head.tobytes())
        for a in arrays:
            out.write(a.tobytes() + bytes(-a.nbytes % 8))
    os.replace(temporary, path)


def _load(path: str) -> list[np.ndarray]:
    raw = np.memmap(path, np.uint8, "r")
    n = int(raw[:8].view(np.int64)[0])
    head = raw[8 : 8 + 16 * n].view(np.int64).reshape(n, 2)
    out, at = [], 8 + 16 * n
    for size, length in head.tolist():
        out.append(raw[at : at + size * length].view({1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[size]))
        at += -(-size * length // 8) * 8
    return out


def _quantised(p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(np.maximum(p, 1e-15)) / STEP), 0, 65535).astype(np.uint16)


def _value(code: np.ndarray) -> np.ndarray:
    return 10.0 ** (-STEP * code.astype(np.float64))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(identities of all tokens, an end after each text; first token of each text and the number of tokens at last)."""
    data, starts, ends, first = words(texts)
    names = span_hashes(data, starts, ends)
    out = np.empty(len(names) + len(first) - 1, np.uint64)
    bounds = first + np.arange(len(first))
    keep = np.ones(len(out), bool)
    keep[bounds[1:] - 1] = False
    out[keep] = names
    out[~keep] = END
    return out, bounds


class _Counter:
    """Sorted keys with counts, merged when the parts grow."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.parts.append((k, n))
        self.held += len(k)
        if len(self.parts) > 8:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        self.parts = [merged(self.parts)]
        self.held = len(self.parts[0][0])
        return self.parts[0]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _planes(a: np.ndarray) -> bytes:
    """Sorted 64-bit keys with their bytes by place, which Spark's shuffle compresses well."""
    return a.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _base(k: int, bits: int) -> np.uint64:
    """The first identity that belongs to shard k of 2 ** bits."""
    return np.uint64(k << (64 - bits) if bits else 0)


class Words:
    """Level 1: numbers, counts and backoff weights of words by identity."""

    def __init__(self, folder: str, bits: int, sizes: tuple[int, ...], with_backoff: bool):
        self.bits, self.offset = bits, np.r_[0, np.cumsum(sizes)]
        self.shards = [self._opened(f"{folder}/words-{k}") if n else None for k, n in enumerate(sizes)]
        self.backoffs = [_load(f"{folder}/backoff-{k}")[0] if n and with_backoff else None for k, n in enumerate(sizes)]

    @staticmethod
    def save(path: str, names: np.ndarray, counts: np.ndarray) -> None:
        """Ascending identities, counted from the shard's first possible one on, and their counts."""
        _save(path, [*EliasFano.of(names).arrays(), counts.astype(np.uint64)])

    @staticmethod
    def _opened(path: str) -> tuple[EliasFano, np.ndarray]:
        a = _load(path)
        return EliasFano.from_arrays(a[:5]), a[5]

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count) of ascending identities."""
        number, count = np.full(len(names), -1, np.int64), np.zeros(len(names), np.int64)
        edges = np.searchsorted(names, [np.uint64(k << (64 - self.bits)) for k in range(1 << self.bits)]) if self.bits else np.array([0])
        for k, (i, j) in enumerate(zip(edges, np.r_[edges[1:], len(names)], strict=True)):
            if self.shards[k] is None or i == j:
                continue
            have, n = self.shards[k]
            place, hit = have.successor(names[i:j] - _base(k, self.bits))
            at = np.minimum(place, have.n - 1)
            number[i:j] = np.where(hit, at + self.offset[k], -1)
            count[i:j] = np.where(hit, n[at], 0)
        return number, count

    def _shard(self, number: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offset, number, "right") - 1

    def counts(self, number: np.ndarray) -> np.ndarray:
        """Counts of word numbers."""
        return self._of(number, [s and s[1] for s in self.shards], np.int64)

    def backoff(self, number: np.ndarray) -> np.ndarray:
        return _value(self._of(number, self.backoffs, np.uint16))

    def _of(self, number: np.ndarray, arrays: list, kind) -> np.ndarray:
        out = np.zeros(len(number), kind)
        shard = self._shard(number)
        for k in np.unique(shard):
            at = shard == k
            out[at] = arrays[k][number[at] - self.offset[k]]
        return out


class Pairs:
    """One shard of level 2."""

    def __init__(self, path: str):
        a = _load(path)
        self.contexts, self.pointers, self.successors = (EliasFano.from_arrays(a[5 * k : 5 * k + 5]) for k in range(3))
        self.codes = a[15]

    @staticmethod
    def save(path: str, a: np.ndarray, b: np.ndarray, p: np.ndarray) -> None:
        """Pairs sorted by (a, b) with their discounted probabilities."""
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
        last = b[np.r_[first[1:], len(a)] - 1] if len(a) else b
        lift = np.r_[0, np.cumsum(last + 1)[:-1]] if len(a) else last
        run = np.repeat(lift, np.diff(np.r_[first, len(a)]))
        sequences = [EliasFano.of(a[first]), EliasFano.of(np.r_[first, len(a)]), EliasFano.of(b + run)]
        _save(path, [x for s in sequences for x in s.arrays()] + [_quantised(p)])

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Discounted probabilities of pairs sorted by (a, b); 0 where the trie has none."""
        out = np.zeros(len(a))
        if not self.contexts.n:
            return out
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        context, known = self.contexts.successor(a[first])
        context, first, sizes = context[known], first[known], np.diff(np.r_[first, len(a)])[known]
        if not len(first):
            return out
        begin, end = self.pointers.access(context).astype(np.int64), self.pointers.access(context + 1).astype(np.int64)
        lift = np.zeros(len(begin), np.int64)
        lift[begin > 0] = self.successors.access(begin[begin > 0] - 1).astype(np.int64) + 1
        rows = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        place, equal = self.successors.successor(b[rows] + np.repeat(lift, sizes))
        hit = equal & (place < np.repeat(end, sizes))
        out[rows[hit]] = _value(self.codes[place[hit]])
        return out


@lru_cache(maxsize=4)
def _level1(folder: str, bits: int, sizes: tuple[int, ...], with_backoff: bool) -> Words:
    return Words(folder, bits, sizes, with_backoff)


@lru_cache(maxsize=512)
def _level2(path: str) -> Pairs:
    return Pairs(path)


def _shard_of(a: np.ndarray, b: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
    """By context; pairs of contexts in hot (ascending) by both words."""
    key = a.astype(np.uint64)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, a), len(hot) - 1)
        key = np.where(hot[at] == a, key * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) + np.uint64(1), key)
    return (mix(key + np.uint64(7)) % np.uint64(shards)).astype(np.int64)


class Model:
    """Where the trie lies and what its sizes are."""

    def __init__(self, folder: str, bits: int, sizes: tuple[int, ...], total: int, shards: int, hot: np.ndarray):
        self.folder, self.bits, self.sizes, self.total, self.shards, self.hot = folder, bits, sizes, total, shards, hot
        self.distinct = sum(sizes)

    def level1(self, with_backoff: bool = True) -> Words:
        return _level1(self.folder, self.bits, self.sizes, with_backoff)

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word number or -1, count, bounds) of all tokens."""
        names, bounds = _tokens(texts)
        distinct, at = np.unique(names, return_inverse=True)
        number, count = self.level1(False).find(distinct)
        return number[at], count[at], bounds

    def contexts(self, number: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The word number before each token; at the start of a text that of an end."""
        before = np.empty_like(number)
        before[1:] = number[:-1]
        end = self.level1(False).find(np.array([END]))[0][0]
        before[bounds[:-1]] = end
        return before

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, known tokens, base score, score) of whole texts, in log10."""
        number, count, bounds = self.numbers(texts)
        base = (count + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        per_text = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  each text has its end
        n = np.diff(bounds)
        if not self.distinct:
            s = per_text(np.log10(base))
            return n, np.zeros_like(n), s, s
        before = self.contexts(number, bounds)
        p = base.copy()
        inner = np.flatnonzero((number >= 0) & (before >= 0) & (count >= PRUNE))
        known_context = np.flatnonzero(before >= 0)
        context, at = np.unique(before[known_context], return_inverse=True)
        p[known_context] *= self.level1().backoff(context)[at]
        if len(inner):
            key, at = np.unique(before[inner].astype(np.uint64) * np.uint64(self.distinct) + number[inner].astype(np.uint64), return_inverse=True)
            a, b = (key // np.uint64(self.distinct)).astype(np.int64), (key % np.uint64(self.distinct)).astype(np.int64)
            shard = _shard_of(a, b, self.shards, self.hot)
            found = np.zeros(len(key))
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(self.shards + 1))
            for k in range(self.shards):
                rows = order[edges[k] : edges[k + 1]]
                if len(rows):
                    found[rows] = _level2(f"{self.folder}/pairs-{k}").find(a[rows], b[rows])
            p[inner] += found[at]
        return n, per_text((count > 0).astype(np.int64)), per_text(np.log10(base)), per_text(np.log10(np.minimum(p, 1.0)))


def _part_of(edges: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The word shard of each number: how many shards end at or before it."""
    return np.searchsorted(edges, word, "right").astype(np.int32)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts all tokens and pairs of docs and writes the trie. Null text counts as empty: one end."""
    spark = docs.sparkSession
    folder = mounted(fresh(spark, "trie"))
    os.makedirs(folder)
    texts = docs.select(F.col(text_col).alias("text"))

    def out(c: _Counter) -> Iterator[pa.RecordBatch]:
        k, n = c.merge()
        for i in range(0, len(k), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(k[i : i + (1 << 16)].view(np.int64)), pa.array(n[i : i + (1 << 16)])], ["name", "n"])
        c.parts, c.held = [], 0

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _Counter()
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                c.add(_tokens(part.column("text"))[0])
                if c.held > HELD:
                    yield from out(c)
        yield from out(c)

    counted = written(texts.mapInArrow(count_words, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")), "words")
    distinct, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = max(0, (distinct // SHARD_WORDS).bit_length())
    shard = F.shiftrightunsigned("name", 64 - bits).cast("int") if bits else F.lit(0)

    def write_words(rows: pd.DataFrame) -> pd.DataFrame:
        names = rows["name"].to_numpy().view(np.uint64)
        order = np.argsort(names)
        k = int(rows["shard"].iloc[0])
        Words.save(f"{folder}/words-{k}", names[order] - _base(k, bits), rows["n"].to_numpy()[order])
        return pd.DataFrame({"shard": [k], "size": [len(rows)]})

    parts = counted.withColumn("shard", shard).groupBy("shard").applyInPandas(write_words, "shard int, size long").collect()
    held = {r["shard"]: r["size"] for r in parts}  # a row for each shard
    sizes = tuple(held.get(k, 0) for k in range(1 << bits))
    shards = max(1, -(-int(total) // SHARD_TOKENS))
    # words that are a large part of a shard by themselves: 8 * shards at most
    heavy = [r["name"] for r in counted.where(F.col("n") > total / (8 * shards)).collect()] if distinct else []
    model = Model(folder, bits, sizes, int(total), shards, np.zeros(0, np.int64))
    if not distinct:
        return model
    model.hot = np.sort(model.level1(False).find(np.sort(np.array(heavy, np.int64).view(np.uint64)))[0])

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _Counter()

        def shared_out() -> Iterator[pa.RecordBatch]:
            key, n = c.merge()
            a, b = (key // np.uint64(model.distinct)).astype(np.int64), (key % np.uint64(model.distinct)).astype(np.int64)
            shard = _shard_of(a, b, shards, model.hot)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            for k in range(shards):
                rows = order[edges[k] : edges[k + 1]]
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_planes(key[rows])], pa.binary()), pa.array([_planes(n[rows].astype(np.uint64))], pa.binary())], ["shard", "keys", "counts"])
            c.parts, c.held = [], 0

        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                number, _, bounds = model.numbers(part.column("text"))
                before = model.contexts(number, bounds)
                c.add(before.astype(np.uint64) * np.uint64(model.distinct) + number.astype(np.uint64))
                if c.held > HELD:
                    yield from shared_out()
        yield from shared_out()

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        key, n = merged([(_unplanes(k), _unplanes(c).astype(np.int64)) for k, c in zip(rows["keys"], rows["counts"], strict=True)])
        keep = n >= PRUNE
        key, n = key[keep], n[keep]
        a, b = (key // np.uint64(model.distinct)).astype(np.int64), (key % np.uint64(model.distinct)).astype(np.int64)
        Pairs.save(f"{folder}/pairs-{int(rows['shard'].iloc[0])}", a, b, (n - DISCOUNT) / model.level1(False).counts(a))
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
        return pd.DataFrame({"word": a[first], "mass": np.add.reduceat(n - DISCOUNT, first) if len(first) else np.zeros(0)})

    mass = written(texts.mapInArrow(count_pairs, "shard int, keys binary, counts binary").groupBy("shard").applyInPandas(build, "word long, mass double"), "mass")
    for k in range(shards):  # a shard that no pair fell into
        if not os.path.exists(f"{folder}/pairs-{k}"):
            Pairs.save(f"{folder}/pairs-{k}", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    offset = model.level1(False).offset

    def write_backoff(key, rows: pd.DataFrame) -> pd.DataFrame:
        k = int(key[0])
        mass = np.zeros(sizes[k])
        has = rows["word"].notna().to_numpy()
        mass[rows["word"].to_numpy()[has].astype(np.int64) - offset[k]] = rows["mass"].to_numpy()[has]
        counts = _load(f"{folder}/words-{k}")[5].astype(np.float64)
        _save(f"{folder}/backoff-{k}", [_quantised(1 - mass / counts)])
        return pd.DataFrame({"shard": [k]})

    per_word = mass.groupBy("word").agg(F.sum("mass").alias("mass"))
    edges = np.asarray(offset[1:-1], np.int64)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_part_of(edges, b.column("word").to_numpy())), *b.columns], ["shard", "word", "mass"])

    blank = spark.createDataFrame([(k, None, None) for k in range(1 << bits) if sizes[k]], "shard int, word long, mass double")
    per_word.mapInArrow(placed, "shard int, word long, mass double").unionByName(blank).groupBy("shard").applyInPandas(write_backoff, "shard int").collect()
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts have one token, the end. Ids may be null or repeat. Extra columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                n, known, base, s = model.scores(part.column("text"))
                total = pa.array(np.full(len(n), model.total, np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), total, pa.array(base), pa.array(s)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out_scores(docs: DataFrame, parts: int = 5, part: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all rows by a model of the rows that aren't held out, and held_out."""
    out = held_out(F.col(id_col), parts, part)
    scored = score(docs, train(docs.where(~out), text_col), id_col, text_col)
    return scored.withColumn("held_out", held_out(F.col("doc_id"), parts, part))
