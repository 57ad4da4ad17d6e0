"""N-gram Jaccard join by prefix trees.

A text's set holds its distinct word n-grams, as 58-bit hashes. Two texts link when the Jaccard similarity of their sets
is at least PERCENT / 100; the result is every text's component over the links and its number of links. No link is lost:

1. Texts with equal sets form a class; only classes are compared.
2. All n-grams get one global order: rare ones first, by hash among themselves, common ones last, by how common they are.
   The list of common n-grams is short (COMMON at most) and only orders; any list gives the same links.
3. Classes that share a smallest hash (STARS hashes) with a centre are compared with it. That joins most near copies with
   few comparisons, so that large groups of them needn't be compared pairwise later.
4. Prefix filter: sets that link share one of their first n - ceil(0.75 n) + 1 n-grams. For each n-gram, the pairs of
   classes that hold it there, that aren't connected yet and whose lengths and places admit a link are candidates. N-grams of more
   than GROUP classes are handled apart, in cells of bounded size, after classes that are connected already have been set aside;
   n-grams that are known to be that common are dealt over many tasks at once, and no task holds the classes of one n-gram.
5. Parity sketches (four bits or more for each n-gram) differ in no more bits than two sets differ in n-grams; candidates whose
   sketches differ in more than a link allows are dropped, so whole sets are moved for few pairs.
6. The others are compared in a prefix tree: the partners of a class, as ordered sets, lie in a path-compressed trie; one
   walk down it with the class's own set shares the overlap of common beginnings and leaves out subtrees whose remaining
   lengths can't reach the overlap that a link needs.
7. Links give components by label propagation over tables in the shared folder.
8. All links lie within components. Each component is cut into cells of bounded size (classes of one range of sizes with those of
   the same or the next one); in a cell one set of classes lies in a prefix tree, which is walked once with all sets of the other,
   and only the number of links of each class leaves the cell, so pairs are neither written nor shuffled.

Only prefixes and the sets of candidates cross the network, never whole texts. A class's copies cost one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import components, discard, extended, gathered, small_batches, written
from ._words import mix, pieces, span_hashes, words

N = 5
PERCENT = 75
STARS = 6
#: An n-gram is common from this count on; the list's length bounds what is broadcast (9 bytes each).
OFTEN = 32
COMMON = 500_000
#: n-grams that a task counts at once, about; those of one text among them aren't reported.
WINDOW = 3_000_000
GROUP = 48
CELL = 4096
#: Rounds over common n-grams before the exact one: how many n-grams of a class, how many nearest classes.
ROUNDS = ((4, 4), (4, 32))
#: Bits of the sketches that cells compare; longer ones are folded to them.
SHORT = 1024
BLOCK = 256
#: A cell in which links are counted holds so many classes at most, and so many n-grams unless a single class has more.
MEMBERS = 1024
SHINGLES = 1 << 19
#: An n-gram is dealt over SALTS tasks if the list says that it has 2 ** HOT texts or more.
HOT = 10
SALTS = 61
#: Tasks with much work take so many shuffle partitions each (see gathered()).
HEAVY = 4
#: Sets of sizes with more than this ratio never link (4/3, and something for rounding).
RATIO = 1.34
KEY_BYTES = 8
BITS = 25
MASK = np.uint64((1 << 58) - 1)
WEIGHTS = np.random.default_rng(58).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def needed(a, b):
    """Least overlap of linked sets of sizes a and b: 100 i >= PERCENT (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def ngrams(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): each text's distinct n-grams, ascending; fewer than n words count as one n-gram."""
    data, starts, ends, first = words(texts)
    w = span_hashes(data, starts, ends)
    size = np.diff(first)
    count = np.where(size >= n, size - n + 1, (size > 0).astype(np.int64))
    sums = np.zeros(len(w), np.uint64)
    for k in range(n):
        sums[: len(w) - k] += w[k:] * WEIGHTS[k]
    short = np.flatnonzero((size > 0) & (size < n))
    for t in short.tolist():
        a, b = first[t], first[t + 1]
        sums[a : a + 1] = (w[a:b] * WEIGHTS[: b - a]).sum(dtype=np.uint64, keepdims=True) + WEIGHTS[32 + b - a]
    hashes = mix(sums) & MASK
    out, bounds = [np.zeros(0, np.uint64)], np.zeros(len(size) + 1, np.int64)
    for t, (a, c) in enumerate(zip(first[:-1].tolist(), count.tolist(), strict=True)):
        if c:
            h = np.sort(hashes[a : a + c])
            if c > 1:
                keep = np.empty(c, bool)
                keep[0] = True
                np.not_equal(h[1:], h[:-1], out=keep[1:])
                h = h[keep]
            out.append(h)
            c = len(h)
        bounds[t + 1] = bounds[t] + c
    return np.concatenate(out), bounds


def _per_text(values: np.ndarray, bounds: np.ndarray, how) -> np.ndarray:
    """how.reduceat over texts; 0 for empty ones."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    full = np.diff(bounds) > 0
    if full.any():
        out[full] = how.reduceat(values, bounds[:-1][full])
    return out


def _class(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each set; the first is the class's id."""
    one = _per_text(mix(hashes + np.uint64(11)), bounds, np.add)
    two = _per_text(mix(hashes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(5)), bounds, np.add)
    return mix(one + np.diff(bounds).astype(np.uint64)).view(np.int64), two.view(np.int64)


def _sketches(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each set the parities of its hashes in m cells, m being the power of two from four times its size on, SHORT at least."""
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        m = max(SHORT, 1 << (4 * (b - a)).bit_length())
        cells = (hashes[a:b] & np.uint64(m - 1)).astype(np.int64)
        out.append(np.packbits(np.bincount(cells, minlength=m).astype(np.uint8) & 1, bitorder="little").tobytes())
    return out


def _folded(sketches: pa.Array, length: int) -> np.ndarray:
    """Sketches of one length, folded to `length` bytes, as rows of 64-bit words."""
    raw = np.frombuffer(b"".join(x.as_buffer() for x in sketches), np.uint64).reshape(len(sketches), -1)
    return np.bitwise_xor.reduce(raw.reshape(len(raw), -1, length // 8), axis=1)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, nb) whose sketches admit a link, from (a, b, na, nb, sa, sb): the longer sketch is folded to the other's length."""
    for batch in batches:
        na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
        la, lb = (np.diff(np.frombuffer(batch.column(c).cast(pa.large_binary()).buffers()[1], np.int64)[batch.column(c).offset :][: batch.num_rows + 1]) for c in ("sa", "sb"))
        apart = np.zeros(len(na), np.int64)
        for x, y in np.unique(np.stack([la, lb], 1), axis=0).tolist():
            rows = np.flatnonzero((la == x) & (lb == y))
            for i in range(0, len(rows), 4096):
                part = rows[i : i + 4096]
                one, two = (_folded(batch.column(c).take(pa.array(part)), min(x, y)) for c in ("sa", "sb"))
                apart[part] = np.bitwise_count(one ^ two).sum(1, dtype=np.int64)
        keep = pa.array(apart <= na + nb - 2 * needed(na, nb))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b", "nb")], ["a", "b", "nb"])


class Order:
    """The global order as sortable keys: six bits of how common an n-gram is, then its hash."""

    def __init__(self, common: np.ndarray, count: np.ndarray):
        order = np.argsort(common)
        self.common = common[order]
        self.level = np.minimum(np.log2(np.maximum(count[order], 1)).astype(np.uint64), np.uint64(63)) << np.uint64(58)

    def keys(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if not len(self.common) or not len(hashes):
            return hashes
        at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
        hit = self.common[at] == hashes
        if not hit.any():
            return hashes
        out = np.where(hit, hashes | self.level[at], hashes)
        touched = np.flatnonzero(_per_text(hit.astype(np.int64), bounds, np.add))
        for t in touched.tolist():
            out[bounds[t] : bounds[t + 1]].sort()
        return out


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text (doc_id, place, n, cid, check, stars), and for each n-gram of two texts of one window or more (ngram, df)."""
    names = ["doc_id", "place", "n", "cid", "check", "stars", "sketch", "ngram", "df"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int32()]
    seen: set[int] = set()
    held: list[np.ndarray] = []

    def count() -> Iterator[pa.RecordBatch]:
        """The window's n-grams of two texts or more; the window starts anew, so memory doesn't follow the task's size."""
        keys = np.empty(sum(map(len, held)), np.uint64)
        end = len(keys)
        while held:  # one copy of the window at a time
            part = held.pop()
            keys[end - len(part) : end] = part
            end -= len(part)
        keys.sort()
        again = keys[1:] == keys[:-1]
        begins, ends = again.copy(), again.copy()
        begins[1:] &= ~again[:-1]
        ends[:-1] &= ~again[1:]
        start = np.flatnonzero(begins)
        keys, counts = keys[start].view(np.int64), (np.flatnonzero(ends) + 2 - start).astype(np.int32)
        for i in range(0, len(keys), 1 << 16):
            k = keys[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(k), t) for t in kinds[:7]], pa.array(k), pa.array(counts[i : i + (1 << 16)])], names)

    for batch in batches:
        for part in pieces(batch, "text"):
            hashes, bounds = ngrams(part.column("text"))
            cid, check = _class(hashes, bounds)
            stars = np.stack([_per_text(mix(hashes + WEIGHTS[40 + j]), bounds, np.minimum) for j in range(STARS)], 1)
            n = np.diff(bounds)
            new = np.zeros(len(n), bool)
            for t, c in enumerate(cid.tolist()):
                if n[t] and c not in seen:
                    seen.add(c)
                    new[t] = True
            held.append(hashes[np.repeat(new, n)])
            if sum(map(len, held)) > WINDOW:
                yield from count()
            list_ = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * STARS, pa.int32()), pa.array(stars.view(np.int64).ravel()))
            none = [pa.nulls(len(n), k) for k in kinds[7:]]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("place"), pa.array(n.astype(np.int32)), pa.array(cid), pa.array(check), list_, pa.array(_sketches(hashes, bounds), pa.binary()), *none], names)
    yield from count()


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[pa.Array]]:
    """Rows sorted by keys, in pieces that hold whole groups; columns of each piece."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        # the last group may go on in the next batch
        n = t.num_rows
        last = np.zeros(n, bool)
        for k in keys:
            c = t.column(k).combine_chunks().to_numpy(zero_copy_only=False)
            last[1:] |= c[1:] != c[:-1]
        start = int(np.flatnonzero(last)[-1]) if last.any() else 0
        if start:
            yield [c.combine_chunks() for c in t.slice(0, start).columns]
        rest = t.slice(start)
    if rest is not None and rest.num_rows:
        yield [c.combine_chunks() for c in rest.columns]


def _admits(na, pa_, nb, pb):
    """Whether sets of sizes na, nb that first meet at the places pa_, pb can link."""
    most = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)) & (most >= needed(na, nb))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix rows sorted by n-gram to candidate pairs (a, b), and to the rows themselves where an n-gram has many classes.

    Of one n-gram no more than GROUP classes and a batch are held: rows of one with more, and those with a salt, pass through.
    """
    names = ["a", "b", "ngram", "cid", "place"]
    held: list[np.ndarray] = []
    rest = [np.zeros(0, np.int64)] * 4
    through: int | None = None  # the n-gram whose first rows have passed through

    def pairs() -> pa.RecordBatch:
        every = np.concatenate(held)
        held.clear()
        every = every[np.lexsort((every[:, 1], every[:, 0]))]
        every = every[np.r_[True, (every[1:] != every[:-1]).any(1)]]
        none = [pa.nulls(len(every), pa.int64())] * 3
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(every[:, 0])), pa.array(np.ascontiguousarray(every[:, 1])), *none], names)

    for batch in _and_none(batches):
        if batch is not None:
            rest = [np.concatenate([r, batch.column(c).to_numpy().astype(np.int64)]) for r, c in zip(rest, ("ngram", "cid", "place", "salt"), strict=True)]
        if not len(rest[0]):
            continue
        # copies of a class come from several tasks
        first = np.r_[True, (rest[0][1:] != rest[0][:-1]) | (rest[1][1:] != rest[1][:-1])]
        rest = [r[first] for r in rest]
        gram = rest[0]
        start = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        size = np.repeat(np.diff(np.r_[start, len(gram)]), np.diff(np.r_[start, len(gram)]))
        many = (size > GROUP) | (rest[3] > 0)
        if through is not None:
            many |= gram == through
        last = gram[-1]  # it may go on in the next batch
        if batch is not None and not many[-1]:
            cut = int(start[-1])
        else:
            cut, through = len(gram), int(last) if many[-1] else None
        (gram, cid, place, _), many, size = [r[:cut] for r in rest], many[:cut], size[:cut]
        rest = [r[cut:] for r in rest]
        if many.any():
            k = int(many.sum())
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(gram[many]), pa.array(cid[many]), pa.array(place[many])], names)
        few = (size > 1) & ~many
        gram, cid, place = gram[few], cid[few], place[few]
        n, p = place >> 32, place & 0xFFFFFFFF
        for d in range(1, int(size[few].max()) if few.any() else 0):
            i = np.flatnonzero(gram[d:] == gram[:-d])
            j = i + d
            i, j = (x[_admits(n[i], p[i], n[j], p[j])] for x in (i, j))
            if len(i):
                held.append(np.stack([np.minimum(cid[i], cid[j]), np.maximum(cid[i], cid[j])], 1))
        if sum(map(len, held)) > 1_000_000:
            yield pairs()
    if held:
        yield pairs()


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _short(sketch: bytes) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, SHORT // 64), axis=0)


def _cell_pairs(batches: Iterator[pa.RecordBatch], nearest: int | None) -> Iterator[pa.RecordBatch]:
    """Cells of a common n-gram's rows (ngram, low, high, own, cid, place, root, sketch) to candidate pairs of classes that aren't connected.

    With `nearest` only that many partners of each class, those with the nearest sketches.
    """
    for columns in _grouped(batches, ["ngram", "low", "high"]):
        gram, low, high, own, cid, place, root = (c.to_numpy(zero_copy_only=False) for c in columns[:7])
        n, p = place >> 32, place & 0xFFFFFFFF
        start = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        for i, j in zip(start, np.r_[start[1:], len(gram)], strict=True):
            rows = np.arange(i, j)
            if (root[rows] == root[i]).all():
                continue
            left, right = rows[own[rows] == low[i]], rows[own[rows] == high[i]]
            sketch = {int(k): _short(columns[7][k].as_py()) for k in rows}
            x, y = np.array([sketch[int(k)] for k in left]), np.array([sketch[int(k)] for k in right])
            held: list[np.ndarray] = []
            for a in range(0, len(left), 64):
                part = left[a : a + 64]
                apart = np.bitwise_count(x[a : a + 64, None, :] ^ y[None]).sum(2, dtype=np.int64) if len(y) else np.zeros((len(part), 0), np.int64)
                u, v = part[:, None], right[None, :]
                fit = (root[u] != root[v]) & _admits(n[u], p[u], n[v], p[v]) & (apart <= n[u] + n[v] - 2 * needed(n[u], n[v]))
                if nearest is not None and fit.shape[1] > nearest:
                    apart = np.where(fit, apart, 1 << 40)
                    best = np.argpartition(apart, nearest - 1, axis=1)[:, :nearest]
                    only = np.zeros_like(fit)
                    np.put_along_axis(only, best, True, axis=1)
                    fit &= only
                k, m = np.nonzero(fit)
                if len(k):
                    one, two = cid[part[k]], cid[right[m]]
                    held.append(np.stack([np.minimum(one, two), np.maximum(one, two)], 1))
            if held:
                every = np.unique(np.concatenate(held), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(every[:, 0])), pa.array(np.ascontiguousarray(every[:, 1]))], ["a", "b"])


class Trie:
    """Ordered sets in a path-compressed prefix tree."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].byteswap().tobytes())  # bytes in order of value
        self.sets = [sets[i] for i in order]
        self.original = order
        common = [self._common(a, b) for a, b in zip(self.sets, self.sets[1:], strict=False)]
        #: node: (first set, depth of its beginning, depth of its end, children, shortest and longest set below, sets that end here)
        self.root = self._node(0, len(order), 0, common)

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def _node(self, i: int, j: int, depth: int, common: list[int]):
        """Sets i to j, which agree up to `depth` at least."""
        todo = []

        def make(i: int, j: int, depth: int) -> list:
            end = min(common[i : j - 1]) if j - i > 1 else len(self.sets[i])
            sizes = [len(self.sets[k]) for k in range(i, j)]
            node = [i, depth, end, [], min(sizes), max(sizes), [k for k in range(i, j) if len(self.sets[k]) == end]]
            todo.append((node, i, j))
            return node

        top = make(i, j, depth)
        while todo:
            node, i, j = todo.pop()
            k = i
            for cut in [*[c + 1 for c in range(i, j - 1) if common[c] == node[2]], j]:
                if cut > k and len(self.sets[k]) > node[2]:
                    node[3].append(make(k, cut, node[2]))
                elif cut - k > 1:  # the first of them ends here
                    node[3].append(make(k + 1, cut, node[2]))
                k = cut
        return top

    def search(self, probe: np.ndarray) -> Iterator[tuple[int, int]]:
        """(number of a set, overlap) of the sets that link with probe."""
        stack = [(self.root, 0)]
        size = len(probe)
        while stack:
            node, overlap = stack.pop()
            first, begin, end, children, shortest, longest, here = node
            segment = self.sets[first][begin:end]
            if len(segment):
                at = np.searchsorted(probe, segment)
                inside = at < size
                overlap += int((probe[at[inside]] == segment[inside]).sum())
                left = size - int(np.searchsorted(probe, segment[-1], "right"))
            else:
                left = size
            for k in here:
                if overlap >= needed(size, end):
                    yield self.original[k], overlap
            best = max(shortest, min(longest, end + left))  # the length below that leaves most room
            if children and overlap + min(left, best - end) >= needed(size, best):
                stack += [(c, overlap) for c in children]

    def links(self, probes: list[np.ndarray], weights: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(for each probe the sum of `own` over the sets that link with it, for each set the sum of `weights` over its probes)."""
        to_probe, to_set = np.zeros(len(probes), np.int64), np.zeros(len(self.sets), np.int64)
        values = np.unique(np.concatenate(self.sets))
        places = [np.searchsorted(values, x) for x in self.sets]
        own = own[self.original]
        step = max(1, (32 << 20) // len(values))
        for i in range(0, len(probes), step):
            a, b = self._walk_all(probes[i : i + step], weights[i : i + step], own, values, places)
            to_probe[i : i + step] += a
            to_set += b
        out = np.zeros_like(to_set)
        out[self.original] = to_set
        return to_probe, out

    def _walk_all(self, probes, weights, own, values, places):
        """One walk down the tree with all probes, each dropped where the lengths that remain can't reach a link."""
        size = np.array([len(p) for p in probes])
        who, every = np.repeat(np.arange(len(probes)), size), np.concatenate(probes)
        rank = np.searchsorted(values, every)  # values below each
        hit = values[np.minimum(rank, len(values) - 1)] == every
        has = np.zeros((len(values), len(probes)), np.uint8)
        has[rank[hit], who[hit]] = 1
        # a probe's elements up to the value of rank r are those of rank r or less
        line = who * (len(values) + 1) + rank
        begin = np.cumsum(size) - size
        to_probe, to_set = np.zeros(len(probes), np.int64), np.zeros(len(self.sets), np.int64)
        stack = [(self.root, np.arange(len(probes)), np.zeros(len(probes), np.int64))]
        while stack:
            node, live, overlap = stack.pop()
            first, start, end, children, shortest, longest, here = node
            segment = places[first][start:end]
            left = size[live]
            if len(segment):
                rows = has[segment]
                overlap = overlap + (rows if len(live) == len(probes) else rows[:, live]).sum(0, dtype=np.int64)
                left = left - (np.searchsorted(line, live * (len(values) + 1) + segment[-1], "right") - begin[live])
            if here:
                link = overlap >= needed(size[live], end)
                to_set[here] += weights[live[link]].sum()
                to_probe[live[link]] += own[here].sum()
            if children:
                best = np.maximum(shortest, np.minimum(longest, end + left))
                go = overlap + np.minimum(left, best - end) >= needed(size[live], best)
                if go.any():
                    stack += [(c, live[go], overlap[go]) for c in children]
        return to_probe, to_set


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells (root, low, high) of classes (cid, own, copies, keys) to (cid, links): the documents that each class links with there, its own included."""
    for columns in _grouped(batches, ["root", "low", "high"]):
        root, low, high, own, cid, copies = (c.to_numpy(zero_copy_only=False) for c in columns[:6])
        start = np.flatnonzero(np.r_[True, (root[1:] != root[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in zip(start.tolist(), np.r_[start[1:], len(root)].tolist(), strict=True):
            rows = np.arange(i, j)
            left, right = rows[own[rows] == low[i]], rows[own[rows] == high[i]]
            if not len(left) or not len(right):
                continue
            of = lambda k: [np.frombuffer(columns[6][int(x)].as_buffer(), np.uint64) for x in k]  # noqa: E731, B023
            a, b = Trie(of(right)).links(of(left), copies[left], copies[right])
            ids.append(cid[left])
            counts.append(a)
            if low[i] != high[i]:
                ids.append(cid[right])
                counts.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(counts))], ["cid", "links"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells (a, block), a's own set first, to links (a, b)."""
    for columns in _grouped(batches, ["a", "block"]):
        a, block, cid = (c.to_numpy(zero_copy_only=False) for c in columns[:3])
        raw = columns[4]
        start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (block[1:] != block[:-1])])
        left, right = [], []
        for i, j in zip(start.tolist(), np.r_[start[1:], len(a)].tolist(), strict=True):
            sets = [np.frombuffer(raw[k].as_buffer(), np.uint64) for k in range(i, j)]
            if cid[i] != a[i] or j - i < 2:
                continue
            for k, _ in Trie(sets[1:]).search(sets[0]):
                left.append(int(a[i]))
                right.append(int(cid[i + 1 + k]))
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])


def _cells(rows: DataFrame, key: str, most: int, shingles: int | None = None) -> DataFrame:
    """Rows (key, cid, n, ...) once for each cell (key, low, high) they belong to, `own` being the row's block, low or high.

    Two rows of one key whose sizes admit a link meet in one cell at least. A key of `most` rows (and of n-grams `shingles`
    in all) is one cell; others are cut by ranges of sizes, so that only neighbouring ranges can link, and into blocks.
    """
    total = F.count(F.lit(1)) if shingles is None else F.greatest(F.count(F.lit(1)), F.ceil(F.sum("n") * (most / shingles)))
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(RATIO))).cast("int")
    by_level = rows.groupBy(key, level.alias("level")).agg(total.alias("rows"))
    # at most as many levels as sizes have ranges
    blocks = by_level.groupBy(key).agg(F.sum("rows").alias("all"), F.map_from_entries(F.collect_list(F.struct("level", F.ceil(F.col("rows") / most).cast("int").alias("blocks")))).alias("blocks"))
    dealt = rows.join(blocks, key).withColumn("level", F.when(F.col("all") > most, level).otherwise(-9))
    code = lambda at, k: at.cast("long") * (1 << 32) + k
    dealt = dealt.withColumn("own", F.when(F.col("level") == -9, F.lit(0).cast("long")).otherwise(code(F.col("level"), F.pmod(F.xxhash64("cid"), F.element_at("blocks", F.col("level"))))))
    near = F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)
    there = F.filter(near, lambda at: F.map_contains_key("blocks", at))
    others = F.flatten(F.transform(there, lambda at: F.transform(F.sequence(F.lit(0), F.element_at("blocks", at) - 1), lambda k: code(at, k))))
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("level") == -9, F.array(F.lit(0).cast("long"))).otherwise(others)))
    return dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))


class Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.spark = docs.sparkSession
        place = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(1 << BITS))
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), place.alias("place"))
        schema = "doc_id long, place long, n int, cid long, check long, stars array<long>, sketch binary, ngram long, df int"
        every = written(self.docs.mapInArrow(_profiles, schema), "profiles")
        self.rows = every.where("n is not null").select("doc_id", "place", "n", "cid", "check", "stars", "sketch")
        common = every.where("ngram is not null").groupBy("ngram").agg(F.sum("df").alias("df")).where(F.col("df") >= OFTEN)
        common = common.orderBy(F.desc("df"), "ngram").limit(COMMON).toPandas()
        self.order = self.spark.sparkContext.broadcast(Order(common["ngram"].to_numpy().astype(np.int64).view(np.uint64), common["df"].to_numpy().astype(np.int64)))
        classes = self.rows.where("n > 0").groupBy("cid").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.min("n").alias("n"), F.min("check").alias("c"), F.max("check").alias("d"), F.first("stars").alias("stars"), F.first("sketch").alias("sketch"))
        self.classes = written(classes.select("cid", F.col("first.place").alias("place"), "n", (F.col("c") != F.col("d")).alias("clash"), "stars", "sketch"), "classes", light=True)
        if self.classes.where("clash").limit(1).count():
            raise RuntimeError("two different sets share a 64-bit hash")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(cid, n, keys) of the classes in wanted (cid), as ordered sets.

        A bitmap of fixed size picks the texts to read again; what it lets through by chance is dropped by the join.
        """
        bits = self.classes.join(wanted, "cid", "left_semi").select("place").groupBy(F.shiftright("place", 6).cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits"))
        found = bits.toPandas()
        bitmap = np.zeros(1 << (BITS - 6), np.uint64)
        bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
        shared, order = self.spark.sparkContext.broadcast(bitmap), self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                place = batch.column("place").to_numpy().astype(np.uint64)
                hit = (shared.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                for part in pieces(batch.filter(pa.array(hit.astype(bool))), "text"):
                    hashes, bounds = ngrams(part.column("text"))
                    cid, _ = _class(hashes, bounds)
                    keys = order.value.keys(hashes, bounds)
                    rows = []
                    for t, c in enumerate(cid.tolist()):
                        if bounds[t + 1] > bounds[t] and c not in seen:
                            seen.add(c)
                            rows.append((c, keys[bounds[t] : bounds[t + 1]].tobytes()))
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["cid", "keys"])

        made = self.docs.mapInArrow(run, "cid long, keys binary").join(wanted, "cid", "left_semi")
        out = written(gathered(made.dropDuplicates(["cid"]), HEAVY), "sets")
        shared.destroy()
        return out

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that link."""
        of = lambda c: self.classes.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
        both = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
        pairs = written(gathered(both).mapInArrow(_near, "a long, b long, nb int"), "pairs")
        if pairs.isEmpty():  # no text has to be read again
            return pairs.select("a", "b")
        sets = self.sets(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
        blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("nb") / SHINGLES)).cast("int")
        sizes = written(pairs.groupBy("a").agg(blocks.alias("blocks")), "sizes", light=True)
        cells = pairs.join(sizes, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
        partners = cells.join(sets, cells["b"] == sets["cid"]).select("a", "block", F.col("b").alias("cid"), F.lit(1).alias("role"), "keys")
        probes = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(sets, F.col("a") == sets["cid"]).select("a", "block", "cid", F.lit(0).alias("role"), "keys")
        rows = partners.unionByName(probes).repartition("a", "block").sortWithinPartitions("a", "block", "role", "cid")
        out = written(gathered(rows, HEAVY).mapInArrow(_compared, "a long, b long"), "links")
        discard(pairs, sets, sizes)
        return out

    def counts(self, root: DataFrame, copies: DataFrame) -> DataFrame:
        """(cid, links) of the classes in root (id, root): how many documents each links with, its own included."""
        sets = self.sets(root.select(F.col("id").alias("cid")))
        named = sets.join(root.withColumnRenamed("id", "cid"), "cid").join(copies, "cid")
        named = written(named.select("root", "cid", "copies", F.expr(f"length(keys) div {KEY_BYTES}").alias("n"), "keys"), "members")
        cells = _cells(named, "root", MEMBERS, SHINGLES).select("root", "low", "high", "own", "cid", "copies", "keys")
        cells = cells.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
        out = written(gathered(cells, HEAVY).mapInArrow(_counted, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("links")), "counts", light=True)
        discard(sets, named)
        return out

    def stars(self) -> DataFrame:
        """Pairs of a class and the centre of a group that shares a smallest hash."""
        own = written(self.classes.select("cid", "n", F.posexplode("stars").alias("j", "key")), "stars")
        # the centre: the smallest of the class ids mixed with the key, so centres differ between hashes
        centre = written(own.groupBy("j", "key").agg(F.min(F.struct("cid", "n")).alias("centre"), F.count(F.lit(1)).alias("many")).where("many > 1"), "centres", light=True)
        near = own.join(centre, ["j", "key"]).select(F.col("centre.cid").alias("a"), F.col("cid").alias("b"), "n", F.col("centre.n").alias("m"))
        near = near.where("a <> b").where(100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m"))
        return near.select("a", "b").distinct()

    def prefixes(self) -> DataFrame:
        """(ngram, cid, place, salt) of all prefixes; place holds the set's size and the place in it; n-grams known to be hot have salts."""
        order = self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                for part in pieces(batch, "text"):
                    hashes, bounds = ngrams(part.column("text"))
                    cid, _ = _class(hashes, bounds)
                    keys = order.value.keys(hashes, bounds)
                    n = np.diff(bounds)
                    first = np.zeros(len(n), bool)
                    for t, c in enumerate(cid.tolist()):
                        if n[t] and c not in seen:
                            seen.add(c)
                            first[t] = True
                    size = np.where(first, n - -(-PERCENT * n // 100) + 1, 0)
                    size[n == 0] = 0
                    at = np.repeat(np.cumsum(size) - size, size)
                    p = np.arange(size.sum()) - at
                    rows = np.repeat(bounds[:-1], size) + p
                    place = np.repeat(n, size) << 32 | p
                    classes = np.repeat(cid, size)
                    salt = np.where(keys[rows] >> np.uint64(58) >= HOT, 1 + classes % SALTS, 0)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[rows].view(np.int64)), pa.array(classes), pa.array(place), pa.array(salt.astype(np.int32))], ["ngram", "cid", "place", "salt"])

        return self.docs.select("text").mapInArrow(run, "ngram long, cid long, place long, salt int")

    def prefix_pairs(self) -> tuple[DataFrame, DataFrame]:
        """(pairs (a, b) that share an n-gram of few classes, rows (ngram, cid, place) of those with many)."""
        rows = self.prefixes().repartition("ngram", "salt").sortWithinPartitions("ngram", "cid")
        found = written(gathered(rows, HEAVY).mapInArrow(_candidates, "a long, b long, ngram long, cid long, place long"), "candidates")
        # a class's copies come from several tasks
        many = written(found.where("ngram is not null").groupBy("ngram", "cid").agg(F.min("place").alias("place")), "many", light=True)
        return found.where("a is not null").select("a", "b").distinct(), many

    @staticmethod
    def apart(pairs: DataFrame, root: DataFrame) -> DataFrame:
        """Pairs of classes that aren't connected by root (id, root)."""
        of = lambda c: root.select(F.col("id").alias(c), F.col("root").alias(f"{c}_root"))
        return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")

    def common_pairs(self, many: DataFrame, root: DataFrame, grams: int | None = None, nearest: int | None = None) -> DataFrame:
        """Candidate pairs among the rows of n-grams with many classes; grams: only so many n-grams of each class."""
        if grams is not None:
            rank = F.row_number().over(Window.partitionBy("cid").orderBy("place", "ngram"))
            many = many.withColumn("r", rank).where(F.col("r") <= grams).drop("r")
        named = many.join(root.withColumnRenamed("id", "cid"), "cid", "left").select("ngram", "cid", "place", F.coalesce("root", "cid").alias("root"))
        named = written(named, "common", light=True)
        # sketches join only the rows of n-grams whose classes aren't all connected
        mixed = written(named.groupBy("ngram").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("ngram"), "mixed", light=True)
        if mixed.isEmpty():
            return mixed.select(F.col("ngram").alias("a"), F.col("ngram").alias("b"))
        mixed = written(named.join(mixed, "ngram").join(self.classes.select("cid", "sketch"), "cid").withColumn("n", F.shiftright("place", 32)), "cells")
        discard(named)
        cells = _cells(mixed, "ngram", CELL).select("ngram", "low", "high", "own", "cid", "place", "root", "sketch")
        cells = cells.repartition("ngram", "low", "high").sortWithinPartitions("ngram", "low", "high")
        return gathered(cells, HEAVY).mapInArrow(lambda b: _cell_pairs(b, nearest), "a long, b long").distinct()

    def close(self) -> None:
        """What executors hold goes; all that is still read has been written."""
        self.order.destroy()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id and, if they are counted, n_links.

    n_links is the number of other rows that the row's text links with, copies among them. Null and empty texts and texts
    without words have no n-grams and link with nothing; their component is their own id. A null id gives its row's component
    no id; a component of null ids alone has a null id. Repeated rows are in one class and link with each other. Ids are
    cast to long. Extra columns aren't read. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, id_col, text_col, count_links)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, count_links: bool) -> DataFrame:
    join = Join(docs, id_col, text_col)
    root = components(join.links(join.stars()))
    few, many = join.prefix_pairs()
    root = extended(root, join.links(join.apart(few, root)))
    for grams, nearest in (*ROUNDS, (None, None)):
        root = extended(root, join.links(join.common_pairs(many, root, grams, nearest)))
    copies = written(join.rows.where("n > 0").groupBy("cid").agg(F.count(F.lit(1)).alias("copies")), "copies", light=True)
    per_class = copies.join(root.withColumnRenamed("id", "cid"), "cid", "left")
    if count_links:
        per_class = per_class.join(join.counts(root, copies), "cid", "left")
    else:
        per_class = per_class.withColumn("links", F.lit(None).cast("long"))
    per_class = written(per_class.select("cid", F.coalesce("root", "cid").alias("root"), (F.coalesce("links", "copies") - 1).alias("n_links")), "classes", light=True)
    join.close()
    named = written(join.rows.where("n > 0").join(per_class, "cid").select("doc_id", "n", "root", "n_links"), "named", light=True)
    first = written(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "first", light=True)
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", *(["n_links"] if count_links else [])]
    alone = join.rows.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("n_links", F.lit(0).cast("long"))
    return named.join(first, "root").select(*columns).unionByName(alone.select(*columns))
