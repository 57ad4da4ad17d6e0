"""Token counts of texts without their ids: each distinct pre-token is counted once for the whole corpus.

A pre-token is a run of space marks (and of other characters that no piece holds, such as line ends) with what follows
up to the next such run. No piece of the model crosses the start of a pre-token, so a text has as many tokens as its
pre-tokens have together. The first pass gathers the distinct pre-tokens of all texts and how often each is used, and counts the
pieces of each once. The second takes the frequencies within each document: pre-tokens of frequent use find their
counts in a broadcast table of at most COMMON entries, all others in a join by pre-token, and both are summed.

The most used ones are in the broadcast table, so a pre-token that is joined has about 1/COMMON of all uses at most: no
key of the join is hot. Only a document's sums leave its task otherwise.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import ship, written
from ._words import pieces
from .sentencepiece_bpe import default_model

#: Entries of the broadcast table of pre-tokens at most.
COMMON = 1 << 18
#: Longer pre-tokens (characters) are counted where they are found: they hardly ever repeat and would only be moved.
LONG = 512
#: Characters of a text that are cut into pre-tokens at once, up to the next start of a pre-token.
WINDOW = 1 << 20
#: Bytes of texts that are taken together.
SLICE = 8 << 20
#: Steps of the histogram of uses for each power of two.
STEPS = 8

MARK = "▁"
# White space that a model's pieces may or may not hold.
_WHITE = "\n\r\t\x0b\x0c"


class Splitter:
    """Cuts texts into pre-tokens of one model, and counts the pieces of a pre-token by its library."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=model)
        p = self.library
        text = [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        if any(re.search(f"[^{MARK}]{MARK}", t) for t in text):
            raise ValueError(f"{model}: a piece goes on beyond a space, so texts can't be cut there")
        if p.encode("a b") != [*p.encode("a"), *p.encode("b")] or p.encode("a ") == p.encode("a"):
            raise ValueError(f"{model}: needs the dummy prefix, and spaces that stay as they are")
        held = set("".join(text))
        starts = MARK + "".join(c for c in _WHITE if c not in held)
        self.pattern = re.compile(f"[{starts}]+[^{starts}]*")
        self.border = re.compile(f"(?<=[^{starts}])[{starts}]")

    def split(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, window by window."""
        full = MARK + text.replace(" ", MARK) if text else ""
        i = 0
        while i < len(full):
            cut = self.border.search(full, i + WINDOW) if i + WINDOW < len(full) else None
            j = cut.start() if cut else len(full)
            yield self.pattern.findall(full, i, j)
            i = j

    def count(self, found: list[str]) -> list[int]:
        """Pieces of each pre-token. The library puts a space mark in front, which is that of the pre-token or one too many."""
        ids = self.library.encode([t[1:] if t[0] == MARK else t for t in found], num_threads=1)
        # a lone mark is an empty text to the library
        return [1 if t == MARK else len(x) - (t[0] != MARK) for t, x in zip(found, ids, strict=True)]


@lru_cache(maxsize=2)
def splitter(model: str) -> Splitter:
    return Splitter(model)


def pretokens(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """The distinct pre-tokens of all texts up to LONG characters: rows (pretoken, uses, n), n the pieces of one."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = splitter(model)
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                seen: Counter[str] = Counter()
                for text in part.column("text").to_pylist():
                    for window in cut.split(text or ""):
                        seen.update(window)
                kept = [(t, n) for t, n in seen.items() if len(t) <= LONG]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["pretoken", "uses"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = splitter(model).count(batch.column("pretoken").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], ["pretoken", "uses", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(find, "pretoken string, uses long")
    return found.groupBy("pretoken").agg(F.sum("uses").alias("uses")).mapInArrow(count, "pretoken string, uses long, n long")


def _least_uses(known: DataFrame, common: int) -> int:
    """The fewest uses of a pre-token in the broadcast table: at most `common` of them have so many. From a histogram of a few hundred rows."""
    step = F.floor(F.log2("uses") * STEPS)
    bars = sorted(known.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("uses").alias("least")).collect(), reverse=True)
    total, least = 0, math.inf
    for _, n, uses in bars:
        total += n
        if total > common:
            break
        least = uses
    return least if least < math.inf else (1 << 62)


def counted(docs: DataFrame, limit: int = 4096, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", common: int = COMMON) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens. Ids keep their type and may be null or repeat: rows are known by
    numbers of their own. Columns other than the two aren't read, so their names can't clash. An empty table gives no
    rows. Texts are never cut short: a long one is split in windows. Strings that look like special tokens are text, as
    they are to the library.
    """
    model = model or default_model()
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = written(pretokens(rows, model), "pretokens")
    least = _least_uses(known, common)
    table = {r.pretoken: r.n for r in known.where(F.col("uses") >= least).select("pretoken", "n").toLocalIterator()}
    shared = spark.sparkContext.broadcast(table)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, common = splitter(model), shared.value
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                sums, open_, times, offsets = [], [], [], [0]
                for text in part.column("text").to_pylist():
                    uses: Counter[str] = Counter()
                    for window in cut.split(text or ""):
                        uses.update(window)
                    n = 0
                    for t, k in uses.items():
                        if (of_one := common.get(t)) is not None:
                            n += of_one * k
                        elif len(t) > LONG:
                            n += cut.count([t])[0] * k
                        else:
                            open_.append(t)
                            times.append(k)
                    sums.append(n)
                    offsets.append(len(open_))
                pairs = pa.StructArray.from_arrays([pa.array(open_, pa.string()), pa.array(times, pa.int64())], ["pretoken", "uses"])
                rest = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
                columns = [part.column("doc_id"), part.column("n_bytes"), pa.array(sums, pa.int64()), rest]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n", "rest"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    sized = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    each = sized.mapInArrow(add, f"doc_id {kind}, n_bytes long, n long, rest array<struct<pretoken: string, uses: long>>")
    each = written(each.withColumn("row", F.monotonically_increasing_id()), "frequencies")
    shared.destroy()
    open_ = each.select("row", F.inline("rest")).withColumnRenamed("uses", "times")
    more = open_.join(known.select("pretoken", F.col("n").alias("of_one")), "pretoken").groupBy("row").agg(F.sum(F.col("times") * F.col("of_one")).alias("more"))
    total = (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    return each.select("row", "doc_id", "n_bytes", "n").join(more, "row", "left").select("doc_id", "n_bytes", total).withColumn("over_limit", F.col("n_tokens") > limit)
