"""Importance resampling towards a target distribution by hashed word and word-pair features.

Three passes, none of which shuffles texts. The first reads the texts once and writes packed streams: a row for each slice of
documents, with the uint16 bucket of each feature, one document after another, and the offsets of the documents. The
second sorts each stream and run-length encodes it; only (bucket, count) rows are summed up, at most one for each bucket and task.
The third reads the streams again, gathers each feature's gain and sums them between the offsets with np.add.reduceat.

Buckets are CRC-32 values, computed for all words of a slice together: one table step for each place in a word, and for
word pairs the shift of the first word's value by the second word's length, which is linear and so four table look-ups.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import numbered, ship, written
from ._words import LOWER, flat, pieces

BUCKETS = 10000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Percent of the documents with enough words that are drawn.
PERCENT = 25
SEED = 7
#: Bytes of texts that are taken together; longer texts are taken in parts of that size.
SLICE = 4 << 20
#: Longer words (bytes) are hashed one by one.
LONG = 48

#: Bytes of words: digits, letters, and all bytes of characters beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The table of CRC-32, and for each length up to LONG what so many zero bytes make of each byte of a value."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> 1), step >> 1).astype(np.uint32)
    shift = np.empty((LONG + 1, 4, 256), np.uint32)
    for k in range(4):
        shift[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(LONG):
        shift[n + 1] = step[shift[n] & 255] ^ (shift[n] >> 8)
    return step, shift


def _crc(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each span."""
    step, _ = _tables()
    out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-sizes, kind="stable")  # the longest first, so those that go on are always in front
    order = order[sizes[order] <= LONG]
    at, left, value = starts[order], sizes[order], out[order]
    live = len(order)
    for k in range(int(left[0]) if live else 0):
        live = int(np.searchsorted(-left[:live], -k, "left"))  # those with more than k bytes
        value[:live] = step[(value[:live] ^ data[at[:live] + k]) & 255] ^ (value[:live] >> 8)
    out[order] = value
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]])
    return out


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of lower-cased data; no word crosses an offset."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = WORD[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first = inside[1:-1] & ~inside[:-2]
    first[edge] |= inside[1:-1][edge]
    last = inside[1:-1] & ~inside[2:]
    last[edge - 1] |= inside[1:-1][edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def stream(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all features, where each document's features start and the end, words of each document).

    data: bytes with A-Z lower-cased. A document's stream is word, pair, word, pair, ..., word.
    """
    step, shift = _tables()
    starts, ends = _spans(data, offsets)
    sizes = ends - starts
    first = np.searchsorted(starts, offsets)
    words = np.diff(first)
    one = _crc(data, starts, sizes)
    # the value of a word and a space, carried on over the next word
    value = one ^ np.uint32(0xFFFFFFFF)
    value = (step[(value ^ np.uint32(32)) & 255] ^ (value >> 8)) ^ np.uint32(0xFFFFFFFF)
    value, n = value[:-1], sizes[1:]
    short = np.minimum(n, LONG)
    two = one[1:] ^ shift[short, 0, value & 255] ^ shift[short, 1, value >> 8 & 255] ^ shift[short, 2, value >> 16 & 255] ^ shift[short, 3, value >> 24]
    for i in np.flatnonzero(n > LONG).tolist():
        two[i] = zlib.crc32(data[starts[i + 1] : ends[i + 1]], int(value[i]))
    both = np.empty(2 * len(one), np.uint16)
    both[0::2] = one % np.uint32(buckets)
    both[1:-1:2] = two % np.uint32(buckets)
    keep = np.ones(len(both), bool)
    keep[2 * first[1:][words > 0] - 1] = False  # what would pair a document's last word with the next document's first
    features = np.maximum(2 * words - 1, 0)
    return both[keep], np.concatenate([[0], np.cumsum(features)]), words


def _long(data: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """stream() of one long document, part by part: the last word of a part is put before the next one."""
    found, words, at, carry = [np.zeros(0, np.uint16)], 0, 0, np.zeros(0, np.uint8)
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and WORD[data[end]]:
            gap = np.flatnonzero(~WORD[data[end : end + SLICE]])
            end = end + int(gap[0]) if len(gap) else min(end + SLICE, len(data))
        part = np.concatenate([carry, np.full(1, 32, np.uint8), data[at:end]])
        edges = np.array([0, len(part)])
        got, _, n = stream(part, edges, buckets)
        carried = len(carry) > 0
        found.append(got[1:] if carried else got)
        words += int(n[0]) - carried
        starts, ends = _spans(part, edges)
        carry = part[starts[-1] : ends[-1]] if len(starts) else carry
        at = end
    both = np.concatenate(found)
    return both, np.array([0, len(both)]), np.array([words])


def streams(docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed streams: rows (ids, offsets, words, stream), one for each slice of documents. Null text counts as empty."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are packed in 16 bits")
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                data, offsets = flat(part.column("text"))
                data = LOWER[data]
                both, at, words = stream(data, offsets, buckets) if len(data) <= 2 * SLICE else _long_slice(data, offsets, buckets)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (part.column("doc_id"), pa.array(at), pa.array(words))]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([both.astype("<u2").tobytes()], pa.binary())], ["ids", "offsets", "words", "stream"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pack, f"ids array<{kind}>, offsets array<long>, words array<long>, stream binary")


def _long_slice(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """stream() where a document is long: document by document."""
    each = [_long(data[a:b], buckets) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
    return np.concatenate([x[0] for x in each]), np.concatenate([[0], np.cumsum([x[1][1] for x in each])]), np.concatenate([x[2] for x in each])


def counts(packed: DataFrame) -> dict[int, int]:
    """Features in each bucket: each stream is sorted and run-length encoded, the runs are summed. At most 65,536 rows come to the driver."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("stream"):
                both = np.sort(np.frombuffer(cell.as_buffer(), "<u2"))
                first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
                n = np.diff(np.r_[first, len(both)])
                yield pa.RecordBatch.from_arrays([pa.array(both[first].astype(np.int32)), pa.array(n.astype(np.int64))], ["bucket", "n"])

    return {r.bucket: r.n for r in packed.select("stream").mapInArrow(runs, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, both smoothed by one, floored."""
    s, t = sum(source.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * (s + buckets) / ((source.get(b, 0) + 1) * (t + buckets)))) for b in range(buckets)], np.int64)


def weighted(packed: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight): the floored mean of the gains of a document's features, 0 without any."""
    kind = packed.schema["ids"].dataType.elementType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("ids")[k].values
                at = batch.column("offsets")[k].values.to_numpy(zero_copy_only=False)
                n, total = np.diff(at), np.zeros(len(at) - 1, np.int64)
                if at[-1]:
                    some = n > 0  # reduceat takes an empty span for one element
                    total[some] = np.add.reduceat(gain[np.frombuffer(batch.column("stream")[k].as_buffer(), "<u2")], at[:-1][some])
                mean = np.floor_divide(total, np.maximum(n, 1))
                yield pa.RecordBatch.from_arrays([ids, batch.column("words")[k].values, pa.array(n), pa.array(mean)], ["doc_id", "n_words", "n_features", "weight"])

    return packed.mapInArrow(gather, f"doc_id {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of docs: doc_id, n_features, weight, score, rank; rank is null where a document isn't drawn.

    score is the weight plus Gumbel noise that seed and doc_id decide, in thousandths. Of the N documents with
    least_words words or more the floor of percent * N / 100 highest scores are drawn, ties to the smaller id; rows with
    equal scores and ids (repeated rows) have ranks in the order of their number of features. Null texts have no
    features, null ids draw their noise as the text `null` and come before other ids of the same score. Other columns
    aren't read. Ranks come from a sort by ranges, so no task sees all rows. An empty table gives no rows; an empty
    target gives weights from the source's counts alone.
    """
    ship(docs.sparkSession)
    packed = written(streams(docs, buckets, id_col, text_col), "streams")
    wanted = written(streams(target.select(F.lit(0).alias("at"), F.col("text")), buckets, "at"), "streams")
    each = weighted(packed, gains(counts(packed), counts(wanted), buckets))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)
    each = written(each.withColumn("score", F.col("weight") + noise), "scores")
    enough = F.col("n_words") >= least_words
    drawn = each.where(enough).count() * percent // 100
    names = ["doc_id", "n_features", "weight", "score"]
    placed = numbered(each.where(enough).select(*names, (-F.col("score")).alias("low")), ["low", "doc_id", "n_features"], "at", "ranked")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1)
    return placed.select(*names, rank.alias("rank")).union(each.where(~enough).select(*names, F.lit(None).cast("long")))
