"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are encoded and cut into pieces of at most CAPACITY tokens. Full pieces are sequences of their own; the
others are dealt at random into blocks of about BLOCK pieces, so that no task packs more than that, whatever the size
of the table. Each block has ISLANDS populations of packings, one Spark row each. A crossover injects whole well-filled
bins of one parent into the other, removes the bins that hold their pieces twice, and puts the displaced pieces back
best-fit. Between epochs (one Spark job each, written to the shared folder) each island's elite moves to the
next island of its block. Afterwards the pieces of badly filled bins of all blocks are packed once more together, in
the same way, until too few are left to fill a block.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import small_batches, written
from ._words import LOWER, SPACE, flat, pieces, span_hashes

CAPACITY = 2048
BLOCK = 1024
ISLANDS = 3
EPOCHS = 3
POPULATION = 4
CROSSOVERS = 6
#: Bins below this share of CAPACITY are dissolved and packed again across blocks.
POOR = 0.99
#: Encoded words that a Python worker remembers, about; only speed depends on it.
REMEMBERED = 300_000
#: Longer words go through the whole tokenizer, whose result takes less memory.
LONG = 256
#: Bytes of text that are segmented and encoded together, and of an Arrow batch: memory of a worker is a small multiple of it.
PIECE = 1 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Classes of bytes: 0 space, 1 letter, 2 digit, 3 punctuation without the apostrophe, 4 anything else.
KIND = np.full(256, 4, np.uint8)
KIND[33:127] = 3
KIND[48:58] = 2
KIND[65:91] = KIND[97:123] = 1
KIND[39] = 4
KIND[SPACE] = 0
CUTS = np.zeros((5, 5), bool)
CUTS[[1, 3, 1, 2, 2, 2, 3], [3, 1, 2, 1, 2, 3, 2]] = True
CUTS = CUTS.ravel()
#: The character that stands for each byte in a byte-level model: itself where it is printable, else one from U+0100 on.
CHARS = np.arange(256, dtype="<u2")
CHARS[[*range(33), *range(127, 161), 173]] = 256 + np.arange(68)


def segments(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like words(), but cut as well where the tokenizer's own pattern surely cuts, and with a flag for each segment.

    That is between a letter (A-Z, a-z or U+00C0 to U+00FF) and ASCII punctuation or a digit, and between digits. An
    apostrophe stays with its neighbours, as do all other characters, so ids of a text are those of its segments.
    Segments of letters only, of one digit or of punctuation only are in lower case and have the flag False: the
    tokenizer takes them as one piece. Others stay as they are, since a capital and the mark after it may compose otherwise
    than the small letter does.
    """
    raw, offsets = flat(texts)
    data, kind = LOWER[raw], KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    data[lead[raw[lead + 1] < 0x9F] + 1] += 32
    inside = kind > 0
    cut = np.zeros(len(data), bool)
    cut[1:] = CUTS[kind[:-1] * 5 + kind[1:]]
    cut[offsets[(offsets > 0) & (offsets < len(data))]] = True
    starts_here = inside.copy()
    starts_here[1:] &= ~inside[:-1] | cut[1:]
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:] | cut[1:]
    starts = np.flatnonzero(starts_here)
    odd = np.maximum.reduceat(kind, starts) == 4 if len(starts) else np.zeros(0, bool)
    capital = np.flatnonzero(data != raw)
    capital = capital[odd[np.searchsorted(starts, capital, "right") - 1]]
    data[capital] = raw[capital]
    return data, starts, np.flatnonzero(ends_here) + 1, odd, np.searchsorted(starts, offsets)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: strings that the tokenizer takes as one token wherever they stand
        self.added = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        #: ids of words met since the memory was half full last, and of those met in the time before that
        self.known: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}

    def encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> list[bytes]:
        """Ids of each segment. Those that are one piece need the library's model only, not its normalizer and pattern."""
        through = odd | (ends - starts > LONG)
        out: list = [None] * len(starts)
        raw, chars, tokenize = data.tobytes(), CHARS[data].tobytes().decode("utf-16-le"), self.model.tokenize
        at = np.flatnonzero(~through)
        for i, s, e in zip(at.tolist(), starts[at].tolist(), ends[at].tolist(), strict=True):
            ids = [x.id for x in tokenize(chars[s:e])]
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        at = np.flatnonzero(through)
        texts = [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        for i, x in zip(at.tolist(), self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[i] = np.array(x.ids, "<u4").tobytes()
        return out

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        data, starts, ends, odd, first = segments(texts)
        at, names = pd.factorize(span_hashes(data, starts, ends))
        sample = np.empty(len(names), np.int64)
        sample[at] = np.arange(len(at))
        keys = names.tolist()
        found = [self.known.get(k) for k in keys]
        unmet = [i for i, x in enumerate(found) if x is None]
        for i in unmet:
            found[i] = self.older.get(keys[i])
        new = [i for i in unmet if found[i] is None]
        if new:
            k = sample[new]
            for i, x in zip(new, self.encoded(data, starts[k], ends[k], odd[k]), strict=True):
                found[i] = x
        self.known.update((keys[i], found[i]) for i in unmet)
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        # each segment's ids, gathered from those of the distinct ones
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        every, size = np.frombuffer(b"".join(found), "<u4"), sizes[at]
        to = np.zeros(len(at) + 1, np.int64)
        np.cumsum(size, out=to[1:])
        ids = every[np.repeat((np.cumsum(sizes) - sizes)[at] - to[:-1], size) + np.arange(to[-1])].tobytes()
        edges = (4 * to[first]).tolist()
        out = [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        plain, edges = flat(texts)
        plain = plain.tobytes()
        if any(x in plain for x in self.added):
            for i, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist(), strict=False)):
                if any(x in plain[a:b] for x in self.added):
                    out[i] = np.array(self.tokenizer.encode(plain[a:b].decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all texts: doc_id, piece, start, length, ids_crc32; each text's ids end with id 0. Null text is empty."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                out: list[tuple] = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), e.ids(part.column("text")), strict=True):
                    ids += b"\0\0\0\0"
                    for k in range(0, len(ids), 4 * capacity):
                        piece = ids[k : k + 4 * capacity]
                        out.append((doc_id, k // (4 * capacity), k // 4, len(piece) // 4, zlib.crc32(piece)))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """A packing: bins of item numbers, with the bins of each free space at hand for best fit."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def _list(self, b: int) -> None:
        free = self.capacity - self.fill[b]
        self.by_free[free].append(b)
        self.mask |= 1 << free

    def add_bin(self, items: list[int], fill: int) -> None:
        self.items.append(items)
        self.fill.append(fill)
        self._list(len(self.items) - 1)

    def put(self, item: int) -> None:
        """Into the bin with the least free space that it fits, or a new one."""
        size = self.sizes[item]
        rest = self.mask >> size
        if not rest:
            self.add_bin([item], size)
            return
        free = size + (rest & -rest).bit_length() - 1
        stack = self.by_free[free]
        b = stack.pop()
        if not stack:
            self.mask &= ~(1 << free)
        self.items[b].append(item)
        self.fill[b] += size
        self._list(b)

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones."""
        return -len(self.items), sum(f * f for f in self.fill)

    def genes(self) -> list[int]:
        out = [0] * len(self.sizes)
        for b, items in enumerate(self.items):
            for i in items:
                out[i] = b
        return out


def best_fit(sizes: list[int], capacity: int, order) -> Bins:
    out = Bins(sizes, capacity)
    for i in order:
        out.put(int(i))
    return out


def from_genes(sizes: list[int], capacity: int, genes) -> Bins:
    bins: list[list[int]] = [[] for _ in range(int(max(genes)) + 1)] if len(genes) else []
    for i, b in enumerate(genes):
        bins[int(b)].append(i)
    out = Bins(sizes, capacity)
    for items in bins:
        if items:
            out.add_bin(items, sum(sizes[i] for i in items))
    return out


def crossover(a: Bins, b: Bins, rng: np.random.Generator) -> Bins:
    """Well-filled bins of b go whole into a; a's bins that share items with them are emptied and their other items put back."""
    order = np.argsort(-np.array(b.fill) + rng.integers(0, max(2, b.capacity // 64), len(b.fill)))
    chosen = order[: max(1, int(len(order) * rng.uniform(0.1, 0.5)))]
    injected = {i for k in chosen for i in b.items[k]}
    out, displaced = Bins(a.sizes, a.capacity), []
    for k in chosen:
        out.add_bin(list(b.items[k]), b.fill[k])
    for items, fill in zip(a.items, a.fill, strict=True):
        if injected.isdisjoint(items):
            out.add_bin(list(items), fill)
        else:
            displaced += [i for i in items if i not in injected]
    displaced.sort(key=lambda i: -a.sizes[i])
    for i in displaced:
        out.put(i)
    return out


def mutate(a: Bins, rng: np.random.Generator) -> Bins:
    """The emptiest bins and a few others are dissolved, their items put back best-fit, large ones first."""
    worst = set(np.argsort(a.fill)[: max(1, len(a.fill) // 20)].tolist()) | set(rng.integers(0, len(a.fill), max(1, len(a.fill) // 10)).tolist())
    out, loose = Bins(a.sizes, a.capacity), []
    for b, (items, fill) in enumerate(zip(a.items, a.fill, strict=True)):
        if b in worst:
            loose += items
        else:
            out.add_bin(list(items), fill)
    loose.sort(key=lambda i: -a.sizes[i])
    for i in loose:
        out.put(i)
    return out


def evolve(sizes: list[int], population: list[list[int]], seed: tuple[int, ...], capacity: int, crossovers: int = CROSSOVERS) -> list[list[int]]:
    """One epoch of an island; the elite comes first. An empty population starts from best-fit packings."""
    rng = np.random.default_rng(seed)
    found = [from_genes(sizes, capacity, g) for g in population]
    if not found:
        found = [best_fit(sizes, capacity, range(len(sizes)))]  # sizes descend
        found += [best_fit(sizes, capacity, np.argsort(-np.array(sizes) * rng.uniform(0.8, 1.2, len(sizes)))) for _ in range(POPULATION - 1)]
    bound = -(-sum(sizes) // capacity)
    for _ in range(crossovers):
        found.sort(key=Bins.fitness, reverse=True)
        if len(found[0].items) <= bound:
            break
        i, j = rng.integers(0, len(found)), rng.integers(0, len(found))
        child = crossover(found[int(min(i, j))], found[int(max(i, j))], rng)
        if rng.random() < 0.5:
            child = mutate(child, rng)
        found[-1] = max(found[-1], child, key=Bins.fitness)
    found.sort(key=Bins.fitness, reverse=True)
    return [x.genes() for x in found[:POPULATION]]


def _packed(items: DataFrame, count: int, capacity: int, seed: int) -> DataFrame:
    """Items (uid, length) to (uid, length, block, bin, fill)."""
    blocks = max(1, -(-count // BLOCK))
    block = F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(blocks)).cast("int")
    grouped = written(items.withColumn("block", block).groupBy("block").agg(F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("minus"), "uid"))).alias("items")), "blocks")
    none = F.array().cast("array<array<int>>")
    state = grouped.select("block", F.transform("items", lambda x: (-x["minus"]).cast("int")).alias("sizes"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), none.alias("population"))
    schema = "block int, sizes array<int>, island int, population array<array<int>>"
    for epoch in range(EPOCHS):

        def run(frames: Iterator[pd.DataFrame], epoch: int = epoch) -> Iterator[pd.DataFrame]:
            for f in frames:
                f["population"] = [evolve(list(map(int, s)), [list(map(int, g)) for g in p], (seed, epoch, b, i), capacity) for b, s, i, p in zip(f.block, f.sizes, f.island, f.population, strict=True)]
                yield f[["block", "sizes", "island", "population"]]

        if epoch:  # each island gets the elite of the one before it
            elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("population", 1, 1).alias("elite"))
            state = state.join(elite, ["block", "island"]).select("block", "sizes", "island", F.concat("population", "elite").alias("population"))
        state = written(state.repartition(max(1, blocks * ISLANDS // 16), "block", "island").mapInPandas(run, schema), "islands")
    bins = lambda genes: F.array_max(genes) + 1
    elite = state.select("block", F.struct(bins(F.col("population")[0]).alias("bins"), "island", F.col("population")[0].alias("genes")).alias("elite"))
    best = elite.groupBy("block").agg(F.min("elite").alias("elite"))
    rows = best.join(grouped, "block").select("block", F.explode(F.arrays_zip(F.col("elite.genes").alias("bin"), F.col("items").alias("item"))).alias("x"))
    rows = rows.select("block", F.col("x.bin").alias("bin"), F.col("x.item.uid").alias("uid"), (-F.col("x.item.minus")).alias("length"))
    fill = rows.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
    return rows.join(fill, ["block", "bin"])


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, seed: int = 29) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty (one piece of the closing id). Null and repeated ids are packed like others, each row for
    itself. Texts of any length are cut into pieces of `capacity` tokens, the last one may be shorter. An empty table
    gives no rows. Extra columns aren't read.
    """
    with small_batches(docs.sparkSession, PIECE):
        every = written(cut(docs, tokenizer, capacity, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    done = every.where(F.col("length") == capacity).select("uid", (F.lit(1 << 60) + F.col("uid")).alias("sequence_id"))
    left = every.where(F.col("length") < capacity).select("uid", "length")
    count = left.count()
    for k in range(rounds):
        if not count:
            break
        packed = written(_packed(left, count, capacity, seed + k), "packed")
        last = count <= BLOCK or k == rounds - 1
        good = packed if last else packed.where(F.col("fill") >= POOR * capacity)
        done = done.unionByName(good.select("uid", (F.lit(k << 56) + F.shiftleft(F.col("block").cast("long"), 24) + F.col("bin")).alias("sequence_id")))
        if last:
            break
        left = packed.where(F.col("fill") < POOR * capacity).select("uid", "length")
        count = left.count()
    placed = every.join(done, "uid")
    # a sequence has `capacity` pieces at most, so the running sum is over a bounded group
    running = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(running), F.lit(0)).cast("long")).drop("uid")
