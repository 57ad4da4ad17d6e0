"""Repair of conversations: the cheapest edits that make roles follow `(s?(ua)+)?`, found by a fold in Spark SQL.

Turns get a place in one global order of (conversation, turn, role, text), dealt by ranges, so a conversation is a run
of places. Faults of a turn and of neighbours come from windows. The sorted turns are collected in blocks of at most
BLOCK places and folded with aggregate(): it carries four (cost, audit) structs, one for each state of the pattern, and
takes the least of them natively; the order of structs is that of the costs and then of the audits, as ties demand.

A block that begins inside a conversation is folded from each of the four states. Blocks of one conversation are then
combined, BLOCK at a time, by the least sum over the state between them. So no task holds the turns of one very long
conversation; its own result row does hold a letter for each edit. Texts aren't part of the fold. They are streamed in
order past the finished audit, which needs one turn in memory.

States: 0 nothing yet, 1 after the system's turn, 2 after a user's, 3 after an assistant's; 0 and 3 may be the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._spark import numbered, ship, written

#: Places in a block, and blocks that are combined at once.
BLOCK = 1024
#: What edits cost. A truncated turn that stays costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The cost of what can't be reached; far over any sum of real costs.
NEVER = 1 << 50

# White space, ends of sentences, neighbours that may stand side by side.
WHITE, ENDS, LEGAL = " \t\n\x0b\x0c\r", ".!?", ("su", "ua", "au")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults put in by crc32(`conv_id:turn`) % 20; nulls of role, text and of the key count as one space.

    0 drops the row, 1 empties its text, 2 takes out its ends of sentences, 3 repeats it, 4 makes its role user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, initial, digest, at): at is the place in the order of conversation, turn (nulls first), role and text's SHA-256."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"initial": F.substring("role", 1, 1), "digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256))})
    return numbered(rows, ["conv_id", "turn", "role", "digest"], "at", "turns")


def flagged(turns: DataFrame) -> DataFrame:
    """ordered() rows without their texts: conv_id, turn, block, at, initial, fault (first of blank, duplicate, truncated, or null), illegal, new_turn.

    A turn that repeats within its block isn't compared again, so a turn that is repeated without end is a row for each block.
    """
    left = F.rtrim("text", F.lit(WHITE))
    rows = turns.select("conv_id", "turn", "role", "digest", "at", "initial", (left == "").alias("blank"), (~F.right(left, F.lit(1)).isin(*ENDS)).alias("cut"), F.expr(f"at div {BLOCK}").alias("block"))
    inside = Window.partitionBy("conv_id", "block").orderBy("at")
    before, turn = F.lag("initial").over(inside), F.lag("turn").over(inside)
    rows = rows.withColumns({
        "illegal": ~F.concat(before, "initial").isin(*LEGAL),
        "new_turn": F.col("turn").isNotNull() & (turn.isNull() | (turn != F.col("turn"))),
        "again": F.row_number().over(Window.partitionBy("conv_id", "block", "role", "digest").orderBy("at")) > 1,
    })
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("at")) > 1
    rows = rows.where(~F.col("again")).withColumn("seen", seen).union(rows.where("again").withColumn("seen", F.lit(True)))
    fault = F.when(F.col("blank"), "blank").when(F.col("seen"), "duplicate").when(F.col("cut"), "truncated")
    return rows.select("conv_id", "turn", "block", "at", "initial", fault.alias("fault"), "illegal", "new_turn")


def _best(cost: Column, audit: Column) -> Column:
    return F.struct(cost.cast("bigint").alias("cost"), audit.alias("audit"))


def _then(best: Column, letter: str, cost: Column | int) -> Column:
    """The struct with one more edit."""
    return _best(best["cost"] + cost, F.concat(best["audit"], F.lit(letter)))


def _inserted(s: list[Column]) -> list[Column]:
    """The four structs with what insertions reach."""
    two = F.least(s[2], _then(F.least(s[0], s[1], s[3]), "I", INSERT))
    return [s[0], s[1], two, F.least(s[3], _then(two, "I", INSERT))]


def _step(carried: Column, turn: Column) -> Column:
    s = [carried[k] for k in range(4)]
    stays = F.coalesce(~turn["fault"].isin("blank", "duplicate"), F.lit(True))
    more = F.when(turn["fault"] == "truncated", TRUNCATED).otherwise(0)
    to_user = F.least(s[0], s[1], s[3])
    kept = lambda best, initial: F.when(stays & (turn["initial"] == initial), _then(best, "K", more))
    moved = lambda best: F.when(stays, _then(best, "R", more + REROLE))
    gone = [_then(x, "D", DELETE) for x in s]
    after = [gone[0], F.least(gone[1], kept(s[0], "s")), F.least(gone[2], kept(to_user, "u"), moved(to_user)), F.least(gone[3], kept(s[2], "a"), moved(s[2]))]
    return F.array(*_inserted(after))


def _folded(turns: Column, start: Column) -> Column:
    zero = [_best(F.when(start == k, F.lit(0)).otherwise(F.lit(NEVER)), F.lit("")) for k in range(4)]
    return F.aggregate(turns, F.array(*_inserted(zero)), _step)


#: Columns of a block that add up.
_SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _combined(parts: DataFrame, unit: int | None) -> DataFrame:
    """The parts of one conversation (and of one block of `unit` places) as one part."""
    keys = ["conv_id"] if unit is None else ["conv_id", F.expr(f"at div {unit}").alias("block")]
    carried = ["at", "first", "last", "first_turn", "last_turn", "paths"]
    some = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*carried))).alias("parts"), *(F.sum(c).alias(c) for c in _SUMS), F.min("least").alias("least"), F.max("most").alias("most"))
    of, states = F.col("parts"), F.array(*(F.lit(k) for k in range(4)))
    borders = F.zip_with(F.slice(of, F.lit(1), F.size(of) - 1), F.slice(of, F.lit(2), F.size(of) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    count = lambda holds: F.size(F.filter(borders, holds))
    wrong = count(lambda x: ~F.concat(x["a"]["last"], x["b"]["first"]).isin(*LEGAL))
    shared = count(lambda x: x["a"]["last_turn"] == x["b"]["first_turn"])
    plus = lambda x, y: _best(x["cost"] + y["cost"], F.concat(x["audit"], y["audit"]))
    over = lambda path, part, end: F.array_min(F.transform(states, lambda between: plus(path[between], part["paths"][between][end])))
    paths = F.aggregate(
        F.slice(of, F.lit(2), F.size(of)), of[0]["paths"], lambda done, part: F.transform(done, lambda path: F.transform(states, lambda end: over(path, part, end)))
    )
    last = F.element_at(of, -1)
    columns = {"at": of[0]["at"], "first": of[0]["first"], "last": last["last"], "first_turn": of[0]["first_turn"], "last_turn": last["last_turn"], "paths": paths}
    return some.select("conv_id", *(v.alias(k) for k, v in columns.items()), *(c for c in _SUMS if c not in ("illegal", "turns")), (F.col("illegal") + wrong).alias("illegal"), (F.col("turns") - shared).alias("turns"), "least", "most")


def plans(flags: DataFrame) -> DataFrame:
    """One row for each conversation with turns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    of = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    turns = F.array_sort(F.collect_list(F.struct("at", "initial", "fault", "turn")))
    blocks = flags.groupBy("conv_id", "block").agg(
        F.min("at").alias("at"), turns.alias("rows"), of("blank"), of("duplicate"), of("truncated"),
        F.count_if("illegal").alias("illegal"), F.count_if("new_turn").alias("turns"), F.min("turn").alias("least"), F.max("turn").alias("most"),
    )
    # a block whose first place is the conversation's own start is folded from state 0 alone
    inside = F.col("at") == F.col("block") * BLOCK
    starts = F.when(inside, F.array(*(F.lit(k) for k in range(4)))).otherwise(F.array(F.lit(0)))
    first, last = F.col("rows")[0], F.element_at("rows", -1)
    parts = blocks.select(
        "conv_id", "at", first["initial"].alias("first"), last["initial"].alias("last"), first["turn"].alias("first_turn"), last["turn"].alias("last_turn"),
        F.transform(starts, lambda s: _folded(F.col("rows"), s)).alias("paths"), *_SUMS, "least", "most",
    )
    whole = _combined(_combined(parts, BLOCK * BLOCK), None)
    end = F.least(F.col("paths")[0][0], F.col("paths")[0][3])
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("bigint")
    return whole.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", end["cost"].alias("cost"), end["audit"].alias("audit"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str, str] | tuple[object]]:
    """(conversation,) where one begins, then (conversation, edit, role, text) of its messages; a conversation's row with the audit comes before its turns."""
    audit, at, place, conv = "", 0, 0, None

    def inserted() -> Iterator[tuple[object, str, str, str]]:
        nonlocal at, place
        while audit[at : at + 1] == "I":
            yield conv, "I", ("user", "assistant")[place % 2], ""
            at, place = at + 1, place + 1

    for batch in batches:
        for c, plan, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "audit", "role", "text")), strict=True):
            if plan is not None:
                yield from inserted()
                audit, at, place, conv = plan, 0, 0, c
                yield (c,)
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                yield c, edit, role, text
                place += role[:1] != "s"  # a system's turn stands before the pairs
            elif edit == "R":
                yield c, edit, ("user", "assistant")[place % 2], text
                place += 1
    yield from inserted()


def _streamed(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """Plans and turns in order: each conversation's plan, then its turns by place."""
    heads = planned.select("conv_id", F.lit(-1).cast("bigint").alias("at"), "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    rows = heads.union(turns.select("conv_id", "at", F.lit(None).cast("string"), "role", "text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "at")


def messages(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired conversations: rows (conv_id, place, edit, role, text), places from 0. turns: ordered(); planned: plans()."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    arrow = to_arrow_type(turns.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, place = 0, 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        schema = pa.schema([("conv_id", arrow), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        for x in _edited(batches):
            if len(x) == 1:
                place = 0
                continue
            rows.append((x[0], place, *x[1:]))
            size, place = size + len(x[3]) + 64, place + 1
            if size > 4 << 20:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()

    return _streamed(turns, planned).mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def digests(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows (conv_id, repaired_sha256): of the repaired `role:text`, joined by line ends, without holding a conversation."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    arrow = to_arrow_type(turns.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[object, str]] = []
        conv, state, some = None, None, False
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], arrow), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])
        for x in _edited(batches):
            if len(x) == 1:
                if state is not None:
                    done.append((conv, state.hexdigest()))
                if len(done) > 10_000:
                    yield batch()
                    done.clear()
                conv, state, some = x[0], hashlib.sha256(), False
            else:
                state.update(f"{chr(10) if some else ''}{x[2]}:{x[3]}".encode())
                some = True
        if state is not None:
            done.append((conv, state.hexdigest()))
        yield batch()

    return _streamed(turns, planned).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repaired(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    turns: rows (conv_id, turn, role, text); other columns aren't read. Null roles and texts count as one space, null
    turns come first and don't count for gaps, a null conv_id is a conversation like any other. Turns of the same number are
    taken by role and then by the SHA-256 of their texts. ids: conversations that get a row though they have no turns (zeros, no
    edits, the hash of nothing). An empty table gives no rows.
    """
    ship(turns.sparkSession)
    rows = ordered(turns)
    planned = plans(flagged(rows))
    if ids is not None:
        every = ids.select(F.col("conv_id").alias("id")).distinct()
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        planned = every.join(planned, F.col("id").eqNullSafe(F.col("conv_id")), "left")
        planned = planned.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"))
    planned = written(planned, "plans")
    hashes = digests(rows, planned).withColumnRenamed("conv_id", "id")
    return planned.join(hashes, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
