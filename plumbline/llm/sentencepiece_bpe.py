"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are cut into words (segments that no merge can cross), and the distinct words of a slice of texts lie in flat
numpy arrays of symbols. Each round looks up the rank of all adjacent pairs, finds each word's smallest rank at its
leftmost place, merges there in all words at once and compacts the arrays; words without a mergeable pair leave. One
merge in each word and round is the library's own order, so ids are equal to its ids. Words of over LONG symbols that
cannot be cut are merged with a priority queue, in the same order.

Only the vocabulary and the scores are read from the model file; ids are computed here.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._words import CHUNK, mix, pieces

SPACE = 0x2581
NONE = np.iinfo(np.int64).max
LONG = 400
UNSEEN = 0  # class of characters that occur in no piece


codecs.register_error("replace-bytes", lambda e: ("\ufffd", e.start + 1))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Lookup tables of a model with an identity normalizer, a dummy prefix and byte fallback."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=model)
        n = p.get_piece_size()
        text = [p.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        self.unk = p.unk_id()
        self.byte_id = {int(text[i][3:5], 16): i for i in range(n) if p.is_byte(i)}
        of = {text[i]: i for i in normal}
        chars = sorted({c for i in normal for c in text[i]})
        #: a symbol is a piece's id, or n + class for a character that is no piece
        self.n = n
        self.char_class = np.zeros(0x110000, np.int64)
        self.symbol_of_class = np.zeros(len(chars) + 1, np.int64)
        for k, c in enumerate(chars, 1):
            self.char_class[ord(c)] = k
            self.symbol_of_class[k] = of.get(c, n + k)
        symbols = of | {c: n + k for k, c in enumerate(chars, 1) if c not in of}
        follows = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        scores = sorted({-p.get_score(i) for i in normal})
        rank_of = {s: r for r, s in enumerate(scores)}
        pairs: dict[int, tuple[int, int]] = {}
        self.width = n + len(chars) + 2
        for i in normal:
            s = text[i]
            for a, b in zip(s, s[1:], strict=False):
                follows[self.char_class[ord(a)], self.char_class[ord(b)]] = True
            for k in range(1, len(s)):
                a, b = symbols.get(s[:k]), symbols.get(s[k:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = (rank_of[-p.get_score(i)], i)
        self.follows = follows
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[int(k)][0] for k in self.pair_keys], np.int64)
        self.pair_id = np.array([pairs[int(k)][1] for k in self.pair_keys], np.int64)
        self.bytes_of = {i: bytes([b]) for b, i in self.byte_id.items()}
        self.piece_bytes = [self.bytes_of[i] if i in self.bytes_of else b"" if p.is_control(i) else " ⁇ ".encode() if i == self.unk else t.replace("▁", " ").encode() for i, t in enumerate(text)]
        self.decimal = [str(i).encode() + b"," for i in range(n)]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, id) of each pair; NONE where it is no piece."""
        keys = left * self.width + right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_rank[at], NONE), self.pair_id[at]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """One word by a priority queue over (rank, place)."""
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        ranks, ids = (x.tolist() for x in self.ranks(np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64)))
        heap = [(r, i, symbols[i], symbols[i + 1], new) for i, (r, new) in enumerate(zip(ranks, ids, strict=True)) if r != NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                r, new = self.ranks(np.array([symbols[i]]), np.array([symbols[j]]))
                if r[0] != NONE:
                    heapq.heappush(heap, (int(r[0]), i, symbols[i], symbols[j], int(new[0])))

        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            if not alive[i] or symbols[i] != a or (j := after[i]) >= n or symbols[j] != b:
                continue
            symbols[i], alive[j], after[i] = new, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s, a in zip(symbols, alive, strict=True) if a]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges all words; symbols lie word by word, word ascends. Returns the final symbols and their words."""
        sizes = np.bincount(word)
        done_s, done_w = [], []
        if (sizes > LONG).any():
            long = sizes[word] > LONG
            for w in np.flatnonzero(sizes > LONG):
                s = np.array(self.merge_long(symbols[word == w].tolist()), np.int64)
                done_s.append(s)
                done_w.append(np.full(len(s), w, np.int64))
            symbols, word = symbols[~long], word[~long]
        rank, new = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            r, x = self.ranks(symbols[:-1], symbols[1:])
            inner = word[:-1] == word[1:]
            rank[:-1], new[:-1] = np.where(inner, r, NONE), x
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, first)
            lengths = np.diff(np.r_[first, len(symbols)])
            live = best != NONE
            if not live.all():
                stay = np.repeat(live, lengths)
                done_s.append(symbols[~stay])
                done_w.append(word[~stay])
                symbols, word, rank, new = symbols[stay], word[stay], rank[stay], new[stay]
                if not len(symbols):
                    break
                lengths, best = lengths[live], best[live]
                first = np.cumsum(lengths) - lengths
            hits = np.flatnonzero(rank == np.repeat(best, lengths))
            _, leftmost = np.unique(word[hits], return_index=True)
            at = hits[leftmost]
            symbols[at] = new[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            where = np.cumsum(keep) - 1
            symbols, word, rank, new = symbols[keep], word[keep], rank[keep], new[keep]
            at = where[at]
            for place in (at, at[at > 0] - 1):  # only the pairs at the merge have changed
                nxt = np.minimum(place + 1, len(symbols) - 1)
                r, x = self.ranks(symbols[place], symbols[nxt])
                rank[place] = np.where((nxt != place) & (word[place] == word[nxt]), r, NONE)
                new[place] = x
        s = np.concatenate(done_s) if done_s else np.zeros(0, np.int64)
        w = np.concatenate(done_w) if done_w else np.zeros(0, np.int64)
        order = np.argsort(w, kind="stable")
        return s[order], w[order]


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    return Vocabulary(model)


def encode_words(v: Vocabulary, texts: list[str]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """(ids of each distinct word, word of each place, first place of each text and the number of places at last)."""
    full = ["▁" + t.replace(" ", "▁") if t else "" for t in texts]
    sizes = np.array([len(t) for t in full], np.int64)
    code = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    offsets = np.r_[0, np.cumsum(sizes)]
    kind = v.char_class[code]
    cut = np.empty(len(code), bool)
    cut[0] = True
    cut[1:] = ~v.follows[kind[:-1], kind[1:]]
    cut[offsets[:-1][sizes > 0]] = True
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], len(code)]
    # identity of a word: a polynomial over its characters
    with np.errstate(over="ignore"):
        values = mix(code.astype(np.uint64) + np.uint64(0x9E3779B9))
        names = _spans(values, starts, ends)
    _, sample, word = np.unique(names, return_index=True, return_inverse=True)
    lengths = ends[sample] - starts[sample]
    at = np.repeat(starts[sample] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    of = np.repeat(np.arange(len(sample)), lengths)
    # an unseen character is a word of its own: nothing follows it
    unseen = kind[starts[sample]] == UNSEEN
    known = ~unseen[of]
    symbols, owner = v.merge(v.symbol_of_class[kind[at[known]]], of[known])
    bounds = np.searchsorted(owner, np.arange(len(sample) + 1))
    flat = symbols.tolist()
    edges = bounds.tolist()
    ids: list[list[int]] = [flat[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    for w in np.flatnonzero(unseen):
        ids[w] = _bytes(v, int(code[starts[sample[w]]]))
    for w in np.unique(owner[symbols >= v.n]):
        ids[w] = [i for s in ids[w] for i in ([s] if s < v.n else _bytes(v, int(np.flatnonzero(v.char_class == s - v.n)[0])))]
    return ids, word, np.searchsorted(starts, offsets)


def _bytes(v: Vocabulary, code: int) -> list[int]:
    return [v.byte_id.get(b, v.unk) for b in chr(code).encode("utf-8", "surrogatepass")]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    from ._words import powers

    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        power, inverse = powers(1 << max(12, (hi - lo).bit_length()))
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[lo:hi] * power[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def encode(texts: list[str], model: str | None = None) -> list[list[int]]:
    """Ids of each text, without begin and end ids."""
    ids, word, first = encode_words(vocabulary(model or default_model()), texts)
    return [[i for w in word[a:b].tolist() for i in ids[w]] for a, b in zip(first, first[1:], strict=False)]


def decode(ids: list[int], model: str | None = None) -> str:
    """The text of ids; the dummy prefix goes."""
    v = vocabulary(model or default_model())
    raw = b"".join(v.piece_bytes[i] for i in ids)
    return _text(raw, bool(ids) and ids[0] not in v.bytes_of).decode()


def _text(raw: bytes, prefixed: bool = True) -> bytes:
    """Bytes of pieces to a text: without the dummy prefix, broken UTF-8 replaced byte by byte."""
    raw = raw[1:] if prefixed and raw[:1] == b" " else raw
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = raw.decode("utf-8", "replace-bytes").encode()
    return raw


def encoded(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids where asked for.

    Null text counts as empty: no ids, and the SHA-256 of nothing twice. Ids may be null or repeat. Extra columns
    aren't read. Texts are never cut; a slice of about 8 MB of text is in memory at a time.
    """
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            for part in pieces(batch, "text", 8 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, word, first = encode_words(v, texts)
                size = np.array([len(x) for x in ids], np.int64)
                decimal, raw = np.empty(len(ids), object), np.empty(len(ids), object)
                for w, x in enumerate(ids):
                    decimal[w] = b"".join([v.decimal[i] for i in x])
                    raw[w] = b"".join([v.piece_bytes[i] for i in x])
                n, digest, back, lists = [], [], [], []
                for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
                    w = word[a:b]
                    n.append(int(size[w].sum()) if b > a else 0)
                    digest.append(hashlib.sha256(b"".join(decimal[w].tolist())[:-1]).hexdigest())
                    back.append(hashlib.sha256(_text(b"".join(raw[w].tolist()))).hexdigest())
                    if with_ids:
                        lists.append([i for k in w.tolist() for i in ids[k]])
                columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest), pa.array(back)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(lists, pa.list_(pa.int32()))] * with_ids, names + ["ids"] * with_ids)

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
