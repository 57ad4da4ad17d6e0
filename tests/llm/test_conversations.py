"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from plumbline.llm import conversations

COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def solve(rows):
    """(the counts, cost, audit, messages), state by state, with insertions until nothing gets better."""
    rows = sorted(rows, key=lambda z: (z[1] is not None, z[1] or 0, z[2].encode(), hashlib.sha256(z[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, r, x in rows:
        faults.append("b" if not x.strip(WHITE) else "d" if (r, x) in seen else "" if x.rstrip(WHITE)[-1] in ".!?" else "t")
        seen.add((r, x))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = {z[1] for z in rows if z[1] is not None}

    def put(best, s, v):
        if s not in best or v[:2] < best[s][:2]:
            best[s] = v
            return True

    def inserted(best):
        while any([put(best, NEXT[s][0], (c + 2, a + "I", [*m, (NEXT[s][1], "")])) for s, (c, a, m) in list(best.items())]):
            pass
        return best

    best = inserted({0: (0, "", [])})
    for (_, _, r, x), fault in zip(rows, faults, strict=True):
        after = {}
        for s, (c, a, m) in best.items():
            put(after, s, (c + 3, a + "D", m))
            if fault not in ("b", "d"):
                c += fault == "t"
                keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((r[:1], s))
                if keep:
                    put(after, keep, (c, a + "K", [*m, (r, x)]))
                put(after, NEXT[s][0], (c + 2, a + "R", [*m, (NEXT[s][1], x)]))
        best = inserted(after)
    cost, audit, made = min((best[s] for s in (0, 3) if s in best), key=lambda v: v[:2])
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(faults.count(k) for k in "bdt"), illegal, cost, audit), made


def wanted(rows):
    by = {r[0]: [] for r in rows}
    for r in damage(rows):
        by[r[0]].append(r)
    out = {}
    for c, v in by.items():
        counts, made = solve(v)
        out[c] = (*counts, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest())
    return out


def drawn(r, n, convs, turns):
    roles, texts = ["user", "assistant", "system", "tool", "", None, "u", "Sys", "ä"], ["", "  ", "Hi.", "a", "b!", "Hello?\n", "c. x", "日。", None, "\x0b", "x" * 5000 + "."]
    return [(r.choice(convs), r.choice(turns), r.choice(roles), r.choice(texts)) for _ in range(n)]


def check(frame, rows):
    got = {r[0]: tuple(r)[1:] for r in conversations.repaired(conversations.damaged(frame), ids=frame).select("conv_id", *COLUMNS).collect()}
    assert got == wanted(rows)


@pytest.mark.parametrize("block", [1024, 3])
def test_against_search(spark, monkeypatch, block):
    """Nulls in all columns, ties of turns, blank and repeated turns, unknown roles; conversations within and across blocks."""
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = drawn(random.Random(5), 300, [None, *range(30)], [None, *range(12)])
    check(spark.createDataFrame(rows, SCHEMA).repartition(5), rows)


def test_one_long_conversation(spark, monkeypatch):
    """Far more turns than a block holds, and more blocks than are combined at once."""
    monkeypatch.setattr(conversations, "BLOCK", 16)
    rows = drawn(random.Random(6), 900, [1, 1, 1, 2], [None, *range(500)])
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_messages_and_digests_agree(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "Hi?"), (1, 3, "user", "Still there?"), (1, 4, "assistant", "Yes"), (2, 0, "assistant", " ")]
    turns = conversations.ordered(spark.createDataFrame(rows, SCHEMA))
    planned = conversations.plans(conversations.flagged(turns))
    hashes = {r.conv_id: r.repaired_sha256 for r in conversations.digests(turns, planned).collect()}
    told = {}
    for r in conversations.messages(turns, planned).orderBy("conv_id", "place").collect():
        told.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert told == {1: ["system:S.", "user:Hi?", "assistant:", "user:Still there?", "assistant:Yes"]}
    assert hashes == {c: hashlib.sha256("\n".join(told.get(c, [])).encode()).hexdigest() for c in (1, 2)}


def test_empty_all_dropped_and_clashing_columns(spark):
    extra = spark.createDataFrame([], SCHEMA + ", at long, audit string, block int, id int")
    assert conversations.repaired(conversations.damaged(extra), ids=extra).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    rows = [(9, gone, "user", "Hi.", 1, "x", 2, 3), (8, 1, "user", "Hi.", 1, "x", 2, 3)]
    check(spark.createDataFrame(rows, extra.schema), [r[:4] for r in rows])
