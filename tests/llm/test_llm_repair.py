"""Conversation repair against a plain search, in blocks and in one go."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

import __spark_entry__ as entry
from eventweave.llm import conversation_repair as cr
from eventweave.llm.shipping import ship
from tests.conftest import SF001
from tests.oracle_check import compare, duck

SCHEMA = "conv_id long, turn long, role string, text string"
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired lines) of (role, text, kind) rows by trying every edit."""

    @lru_cache(maxsize=None)
    def best(i, last, inserts):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            c, a, t = best(i, FOLLOWS[last], inserts + 1)
            found.append((c + 5, "I" + a, (f"{ROLE[FOLLOWS[last]]}:", *t)))
        if i < len(rows):
            role, text, kind = rows[i]
            c, a, t = best(i + 1, last, 0)
            found.append((c + 2, "D" + a, t))
            if kind != "gone":
                extra = 5 if kind == "cut" else 0
                first = role[:1]
                if first == FOLLOWS[last] or (first == "s" and last == ""):
                    c, a, t = best(i + 1, first, 0)
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *t)))
                to = FOLLOWS[last]
                c, a, t = best(i + 1, to, 0)
                found.append((c + 1 + extra, "R" + a, (f"{ROLE[to]}:{text}", *t)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def plain_summary(rows):
    """The summary of (turn, role, text) rows of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults, marked = set(), [], []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        marked.append((role, text, {"": "", "truncated": "cut"}.get(fault, "gone")))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit, lines = cheapest(tuple(marked))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    found = {}
    for conv, *row in rows:
        found.setdefault(conv, []).append(tuple(row))
    return found


def summaries(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def random_rows(seed, conversations=120):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "u", "tool", "", None, "Assistant"]
    texts = ["Yes.", "No!", "cut off", " ", "", None, "Why?  \n", "…", "é.", "a\x0b", "long " * 50 + "."]
    rows = []
    for conv in range(conversations):
        n = rng.choice([1, 2, 3, 5, 8, 12])
        turn = 0
        for _ in range(n):
            turn += rng.choice([0, 1, 1, 1, 2])
            rows.append((conv if conv else None, rng.choice([turn] * 9 + [None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}."))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("long_rows", [cr.LONG_ROWS, 3])
def test_summary_matches_a_plain_search(spark, long_rows):
    rows = random_rows(long_rows % 7)
    frame = ship(spark).createDataFrame([(*r, 1, "x", "y") for r in rows], f"{SCHEMA}, seq int, fault string, pos string").repartition(5)
    got = summaries(cr.summarize(frame, long_rows=long_rows))
    expected = {c: plain_summary(r) for c, r in by_conversation(rows).items()}
    assert got == expected
    damaged = cr.damage(frame)
    got = summaries(cr.every_conversation(frame, cr.summarize(damaged, long_rows=long_rows)))
    after = by_conversation(plain_damage(rows))
    assert got == {c: plain_summary(after.get(c, [])) for c in by_conversation(rows)}


def test_edit_rows_give_the_repaired_conversations(spark):
    rows = random_rows(5)
    frame = ship(spark).createDataFrame(rows, SCHEMA)
    short = cr.repair(frame).orderBy("conv_id", "seq").collect()
    blocks = cr.repair(frame, long_rows=2).orderBy("conv_id", "seq").collect()
    assert short == blocks
    for conv, given in by_conversation(rows).items():
        edits = [e for e in short if e["conv_id"] == conv]
        gaps, blank, duplicate, truncated, illegal, cost, audit, digest = plain_summary(given)
        assert "".join(e["edit"] for e in edits) == audit and sum(e["cost"] for e in edits) == cost
        left = [e for e in edits if e["edit"] != "D"]
        assert hashlib.sha256("\n".join(f"{e['role']}:{e['text']}" for e in left).encode()).hexdigest() == digest
        initials = "".join(e["role"][0] for e in left)
        assert initials.removeprefix("s") == "ua" * (len(initials.removeprefix("s")) // 2) and initials != "s"


def test_one_long_conversation_and_very_long_texts(spark):
    rng = random.Random(1)
    rows = [(7, i // 2, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"t{i}.", f"cut {i}", ""])) for i in range(3000)]
    rows += [(8, 0, "user", "x" * 400_000 + "."), (8, 1, "assistant", "y" * 300_000)]
    frame = ship(spark).createDataFrame(rows, SCHEMA).repartition(4)
    whole = summaries(cr.summarize(frame))
    assert summaries(cr.summarize(frame, long_rows=100)) == whole
    assert summaries(cr.summarize(frame, long_bytes=500_000)) == whole
    assert whole[8] == plain_summary([r[1:] for r in rows if r[0] == 8])
    # the same rows through unlimited vectors
    p = cr.Programme()
    codes = [rng.randrange(12) for _ in range(4000)]
    _, least, _ = p.backward(codes, cr.FINAL)
    vector, _, kept = p.backward(codes, cr.FINAL, every=64)
    assert len(kept) == 4000 // 64 and max(map(len, kept)) == 4
    edits, state = p.walk(codes, cr.FINAL, 0)
    assert len(edits) == 4000 and cr.FINAL[state] in (0, cr.INSERT)
    price = {"I": 5, "D": 2}
    total = len(p.ending(state)[0]) * 5
    for code, (letters, _) in zip(codes, edits, strict=True):
        total += sum(price.get(x, (x == "R") + 5 * (code % 3 == cr.CUT)) for x in letters)
    assert total == least + vector[0]


def test_equal_rows_of_a_hot_conversation_are_split(spark):
    frame = ship(spark).range(6000).selectExpr("cast(NULL AS long) AS conv_id", "1L AS turn", "'user' AS role", "'Same.' AS text").repartition(6)
    (row,) = cr.summarize(frame, long_rows=500).collect()
    assert row["duplicate"] == 5999 and row["audit"] == "D" * 6000 and row["cost"] == 12000 and row["illegal"] == 5999


def test_empty_table(spark):
    none = ship(spark).createDataFrame([], SCHEMA)
    assert cr.every_conversation(none, cr.summarize(cr.damage(none))).count() == 0
    assert cr.repair(none).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    (row,) = cr.every_conversation(one, cr.summarize(cr.damage(one))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_query_equals_its_sql(spark):
    name = "op12_conversation_repair"
    info = compare(spark, duck(SF001), SF001, name, entry.queries()[name], entry.oracle_sql()[name])
    assert info["ok"], info
