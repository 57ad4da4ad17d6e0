"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5 bytes of "<word>") and of itself, hashed into BUCKETS vectors; a
text is the average of its words' averages; a linear softmax on it gives two classes. Vectors and softmax are
trained together in numpy, so a misspelling that was never seen shares most of its vectors with the word it comes from.

The classifier is fitted on a bounded sample of labelled rows, at most SAMPLE of each class, chosen by a hash of the
id; the prior of the whole training set is put back into the bias. One task reads the sample's texts piece by piece and
keeps each text's distinct words only, so neither the driver nor the task holds texts. Scoring reads every whole text
once: after training each n-gram's part in the difference of the logits is one number, so executors get an array of
BUCKETS numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._spark import discard, written
from ._words import VALUE, mix, pieces, powers, span_hashes, words

BUCKETS = 1 << 18
DIMENSIONS = 8
GRAMS = (3, 4, 5)
#: Most rows of each class that the classifier is fitted on.
SAMPLE = 4000
#: A text is called toxic from this score on.
THRESHOLD = 0.3
#: Passes over the sample; more where they would make fewer than STEPS steps.
EPOCHS = 6
STEPS = 240
BATCH = 128
#: n-grams of fewer sample texts keep a zero vector: they can only tell single texts apart. Fewer in samples below SHARE * LEAST texts.
LEAST = 10
SHARE = 100
RATE = 0.05
DECAY = 3e-4
SEED = 5


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of each n-gram of the words, word by word."""
    sizes = ends - starts + 2
    at = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    text = np.empty(total, np.uint8)
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(total) - at[word]
    inner = (place > 0) & (place < sizes[word] - 1)
    text[place == 0], text[place == sizes[word] - 1] = 60, 62
    text[inner] = data[(starts[word] + place - 1)[inner]]
    power, inverse = powers(1 << max(12, total.bit_length()))
    sums = np.zeros(total + 1, np.uint64)
    np.cumsum(VALUE[text] * power[:total], out=sums[1:])
    buckets, owners = [], []
    for n in GRAMS:
        i = np.flatnonzero(place + n <= sizes[word])
        buckets.append(mix((sums[i + n] - sums[i]) * inverse[i] + np.uint64(n)))
        owners.append(word[i])
    whole = (sums[at + sizes] - sums[at]) * inverse[at]
    buckets.append(mix(whole + np.uint64(99)))
    owners.append(np.arange(len(starts)))
    bucket, owner = np.concatenate(buckets) & np.uint64(BUCKETS - 1), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order].astype(np.int64), owner[order]


def _slices(n: int, sizes: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    i = 0
    total = np.r_[0, np.cumsum(sizes)]
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, "right")) - 1)
        yield i, j
        i = j


@dataclass
class Model:
    #: each n-gram's part in logit(toxic) - logit(clean)
    part: np.ndarray
    bias: float

    def word_parts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts))
        for i, j in _slices(len(starts), ends - starts + 2):
            bucket, owner = grams(data, starts[i:j], ends[i:j])
            out[i:j] = np.bincount(owner, self.part[bucket], j - i) / np.bincount(owner, minlength=j - i)
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of whole texts; one without words has that of the bias alone."""
        data, starts, ends, first = words(texts)
        _, sample, at = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        order = np.argsort(sample)
        part = np.empty(len(sample))
        part[order] = self.word_parts(data, starts[sample[order]], ends[sample[order]])
        n = np.diff(first)
        text = np.repeat(np.arange(len(n)), n)
        mean = np.bincount(text, part[at], len(n)) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -60, 60)))


class _Bag:
    """Words and n-grams of the sample: each distinct word once, each text as (word, share of its words) pairs."""

    def __init__(self, texts: pa.Array | None = None):
        self.names, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of distinct words, by identity
        self.texts_of_word = np.zeros(0, np.int64)
        self.parts: dict[str, list[np.ndarray]] = {k: [] for k in ("bucket", "grams", "word", "share", "size")}
        if texts is not None:
            self.add(texts)

    def add(self, texts: pa.Array) -> None:
        data, starts, ends, first = words(texts)
        names, sample, at = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.names, names)
        known = self.names[np.minimum(place, len(self.names) - 1)] == names if len(self.names) else np.zeros(len(names), bool)
        new = np.flatnonzero(~known)
        number = np.empty(len(names), np.int64)
        number[known] = self.number[place[known]]
        by_text = np.argsort(sample[new])  # grams() takes spans in order
        number[new[by_text]] = len(self.names) + np.arange(len(new))
        self.names, self.number = np.insert(self.names, place[new], names[new]), np.insert(self.number, place[new], number[new])
        self.texts_of_word = np.r_[self.texts_of_word, np.zeros(len(new), np.int64)]
        span = sample[new[by_text]]
        for i, j in _slices(len(span), ends[span] - starts[span] + 2):
            bucket, owner = grams(data, starts[span[i:j]], ends[span[i:j]])
            self.parts["bucket"].append(bucket.astype(np.int32))
            self.parts["grams"].append(np.bincount(owner, minlength=j - i))
        n = np.diff(first)
        text = np.repeat(np.arange(len(n), dtype=np.int64), n)
        pair, count = np.unique(text * max(len(names), 1) + at, return_counts=True)
        text, word = pair // max(len(names), 1), number[pair % max(len(names), 1)]
        self.texts_of_word += np.bincount(word, minlength=len(self.names))
        self.parts["word"].append(word.astype(np.int32))
        self.parts["share"].append((count / n[text]).astype(np.float32))
        self.parts["size"].append(np.bincount(text, minlength=len(n)))

    def close(self) -> None:
        """Keeps the n-grams of enough texts, numbered anew; the others have zero vectors and count in averages only."""
        whole = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in self.parts.items()}
        self.parts.clear()
        self.word, self.share, self.first = whole["word"], whole["share"], np.r_[0, np.cumsum(whole["size"])]
        grams_of = whole["grams"]
        seen = np.zeros(BUCKETS, np.int64)
        start = np.r_[0, np.cumsum(grams_of)]
        for i, j in _slices(len(grams_of), grams_of, 1 << 20):
            seen += np.bincount(whole["bucket"][start[i] : start[j]], np.repeat(self.texts_of_word[i:j], grams_of[i:j]), BUCKETS).astype(np.int64)
        self.usual = np.flatnonzero(seen >= max(2, min(LEAST, (len(self.first) - 1) // SHARE)))
        new = np.full(BUCKETS, -1, np.int32)
        new[self.usual] = np.arange(len(self.usual))
        kept = new[whole["bucket"]]
        owner = np.repeat(np.arange(len(grams_of)), grams_of)[kept >= 0]
        self.gram = kept[kept >= 0]
        self.grams_of = np.maximum(grams_of, 1)
        self.gram_start = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(grams_of)))]

    def batch(self, texts: np.ndarray):
        """(kept n-grams of the batch's distinct words, how many of each word, all n-grams of each word, word and text and share of each pair)."""
        n = self.first[texts + 1] - self.first[texts]
        at = np.repeat(self.first[texts] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        distinct, local = np.unique(self.word[at], return_inverse=True)
        g = self.gram_start[distinct + 1] - self.gram_start[distinct]
        gram_at = np.repeat(self.gram_start[distinct] - (np.cumsum(g) - g), g) + np.arange(g.sum())
        return self.gram[gram_at], g, self.grams_of[distinct], local, np.repeat(np.arange(len(texts)), n), self.share[at]


def _constant(p: float) -> Model:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return Model(np.zeros(BUCKETS), float(np.log(p / (1 - p))))


def fit(texts: list[str], labels: list[int], prior: float | None = None) -> Model:
    """The model of a few texts. prior: share of toxic rows where texts aren't a fair sample."""
    return fit_bag(_Bag(pa.array(texts, pa.large_string())), np.array(labels, float), prior)


def fit_bag(bag: _Bag, y: np.ndarray, prior: float | None = None, epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY) -> Model:
    """Adam on the logistic loss of the batch's classes. One class alone gives a model of the prior."""
    if not len(y) or y.min() == y.max():
        return _constant(prior if prior is not None else (float(y.mean()) if len(y) else 0.0))
    bag.close()
    rng = np.random.default_rng(SEED)
    kept = len(bag.usual)
    vectors = np.zeros((kept, DIMENSIONS), np.float32)
    soft = rng.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    scale = np.float32(64)  # of a text's average, whose telling words are few
    m1, m2 = np.zeros_like(vectors), np.zeros(kept, np.float32)
    s1, s2 = np.zeros_like(soft), np.zeros_like(soft)
    epochs = max(epochs, -(-STEPS * BATCH // len(y)))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            rows = order[i : i + BATCH]
            gram, g, all_grams, local, owner, share = bag.batch(rows)
            lr = rate * (1 - (epoch + i / len(y)) / epochs) + 1e-4
            of = np.repeat(np.arange(len(g)), g)
            word = np.stack([np.bincount(of, vectors[gram, d], len(g)) for d in range(DIMENSIONS)], 1) / all_grams[:, None]
            text = np.stack([np.bincount(owner, word[local, d] * share, len(rows)) for d in range(DIMENSIONS)], 1) * scale
            logits = text @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows].astype(int)] -= 1
            p /= len(rows)
            d_soft, d_bias, d_text = text.T @ p, p.sum(0), (p @ soft.T) * scale
            d_word = np.stack([np.bincount(local, d_text[owner, d] * share, len(g)) for d in range(DIMENSIONS)], 1) / all_grams[:, None]
            touched = np.flatnonzero(np.bincount(gram, minlength=kept))
            grad = np.stack([np.bincount(gram, d_word[of, d], kept)[touched] for d in range(DIMENSIONS)], 1).astype(np.float32)
            grad += decay * vectors[touched]
            m1[touched] = 0.9 * m1[touched] + 0.1 * grad
            m2[touched] = 0.99 * m2[touched] + 0.01 * (grad**2).mean(1)
            vectors[touched] -= lr * m1[touched] / (np.sqrt(m2[touched]) + 1e-8)[:, None]
            s1 = 0.9 * s1 + 0.1 * d_soft
            s2 = 0.99 * s2 + 0.01 * d_soft**2
            soft -= lr * s1 / (np.sqrt(s2) + 1e-8)
            bias -= lr * d_bias
    shift = 0.0
    if prior is not None and 0 < prior < 1:
        drawn = y.mean()
        shift = np.log(prior / (1 - prior)) - np.log(drawn / (1 - drawn))
    part = np.zeros(BUCKETS)
    part[bag.usual] = (vectors @ (soft[:, 1] - soft[:, 0])).astype(float) * float(scale)
    return Model(part, float(bias[1] - bias[0] + shift))


def held_out(id_col: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves `part` when divided by `parts`; a null id is in training."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on labelled rows that aren't held out, in one task.

    A row with two labels counts as toxic; null ids and labels are left out. Null text counts as empty. Of several texts
    with one id the smallest is taken. Without labels of both classes, or none of
    their ids in docs, the model is the share of toxic ones.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return _constant(prior)
    drawn = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for y in (0, 1)]
    sample = written(drawn[0].union(drawn[1]), "sample")  # 2 * SAMPLE rows at most
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bag, y = _Bag(), [np.zeros(0)]
        for batch in batches:
            for part in pieces(batch, "text"):
                bag.add(part.column("text"))
                y.append(part.column("label").to_numpy().astype(float))
        model = fit_bag(bag, np.concatenate(y), prior)
        yield pa.RecordBatch.from_arrays([pa.array([model.part.tobytes()], pa.binary()), pa.array([model.bias])], ["part", "bias"])

    # the sample is bounded, so one task may read it
    made = rows.repartition(1).sortWithinPartitions("id").mapInArrow(run, "part binary, bias double").first()
    discard(sample)
    if made is None:  # none of the labelled ids is in docs
        return _constant(prior)
    return Model(np.frombuffer(bytes(made["part"]), np.float64), made["bias"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted; with keep, the rows' own columns and a boolean of that name.

    Null and empty texts get the score of the bias alone. Texts are scored whole. A doc_id may be null or repeat.
    docs mustn't have a column named as `keep` (ValueError); other columns may have any name.
    """
    if keep and keep.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {keep} of its own")
    added = keep or "__score"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    schema = docs.schema if keep else T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)])
    rows = docs if keep else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    text = text_col if keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                own = part if keep else part.select(["doc_id"])
                scores = shared.value.scores(part.column(text))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(scores >= THRESHOLD if keep else scores)], [*own.schema.names, added])

    out = rows.mapInArrow(run, T.StructType([*schema.fields, T.StructField(added, T.BooleanType() if keep else T.DoubleType())]))
    if keep:
        return out
    score = F.col(added)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
