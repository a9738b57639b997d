"""Cheapest repair of conversation structure (operator 12).

The rows of a conversation, by turn (nulls first; ties by role, then text), are edited until their role
initials read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert of an
empty user or assistant row 5; a truncated row that stays costs 5 more.  Blank rows and repeats of
an earlier (role, text) must be deleted.  Of the cheapest repairs the one whose edit letters
are ASCII-least is taken.  ``repair`` returns one row an edit, ``summarize`` one row a conversation.

Dynamic programme: going backward, a vector holds for every state of the pattern the least cost of the rows
still to come.  Only every sqrt(n)-th vector is kept; walking forward, the vectors between two
checkpoints are computed anew and the least letter that stays on a cheapest path is emitted.  A vector less its
least entry takes few values, so steps are looked up by (row code, vector).

Distribution: conversations are dealt out by id and streamed, one at a time, each of bounded size
(``LONG_ROWS`` rows, ``LONG_BYTES`` bytes).  Longer ones take the same programme in blocks: rows are numbered by a
range-partitioned scan, each block of ``LONG_ROWS`` rows gives its 4 x 4 table of least costs
between states, the blocks' end vectors follow from these tables, every block walks from
each of its four entry states, and the states are followed through the blocks.  No task then holds
more than a block, except that the digest of one conversation, a single hash and string by
definition, is streamed by one task.

Edge cases: a null role or text reads as one space; roles are known by their first letter (s, u,
a; any other can't be kept); a null conversation id is a conversation; rows of no conversation give no edits; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import join_null_safe, number_within
from ..session import materialize

#: conversations beyond either bound are worked on in blocks
LONG_ROWS = 20_000
LONG_BYTES = 8 << 20
#: output rows and bytes in one Arrow batch
BATCH_ROWS = 10_000
BATCH_BYTES = 4 << 20

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
STATES = range(4)
#: the state that a user or assistant row leads to, and that row's role
FOLLOWS = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}
#: least cost after the last row
FINAL = (0, 2 * INSERT, INSERT, 0)
NO = 1 << 40  # no path
#: row codes: 3 * initial + kind
INITIALS = "sua"
WHOLE, CUT, GONE = 0, 1, 2
BLANKS = " \t\n\x0b\x0c\r"

EDITS = "conv_id long, seq long, edit string, turn long, role string, text string, initial string, fault string, cost long"
_EDITS = pa.schema(
    [("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()),
     ("text", pa.string()), ("initial", pa.string()), ("fault", pa.string()), ("cost", pa.int64())]
)
SUMMARY = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def row_code(initial: str, kind: int) -> int:
    at = INITIALS.find(initial) if initial else -1
    return 3 * (at if at >= 0 else 3) + kind


def _kept_state(initial: int, state: int) -> int | None:
    """Where keeping a row of this initial leads, None if the pattern forbids it."""
    if initial == 0:
        return 1 if state == 0 else None
    return FOLLOWS[state] if initial < 3 and FOLLOWS[state] == initial + 1 else None


class Programme:
    """Backward steps and forward choices, looked up after their first use."""

    def __init__(self) -> None:
        self._steps: dict = {}
        self._choices: dict = {}

    def _options(self, code: int, state: int, after: tuple) -> list[tuple[int, str, str, int]]:
        """(cost, letter, new role, next state) of the edits that use the row."""
        initial, kind = divmod(code, 3)
        found = [(DELETE + after[state], "D", "", state)]
        if kind != GONE:
            extra = TRUNCATED if kind == CUT else 0
            to = _kept_state(initial, state)
            if to is not None:
                found.append((extra + after[to], "K", "", to))
            to = FOLLOWS[state]
            found.append((REROLE + extra + after[to], "R", ROLE_OF[to], to))
        return found

    def _before(self, code: int, after: tuple) -> tuple:
        best = [min(o[0] for o in self._options(code, s, after)) for s in STATES]
        for _ in range(2):  # two inserts in a row at most: the third would undo the first
            best = [min(best[s], INSERT + best[FOLLOWS[s]]) for s in STATES]
        return tuple(min(b, NO) for b in best)

    def step(self, code: int, after: tuple) -> tuple[tuple, int]:
        """The vector before the row, less its least entry, and that entry; ``after`` likewise is reduced."""
        key = (code, after)
        known = self._steps.get(key)
        if known is None:
            before = self._before(code, after)
            least = min(before)
            known = self._steps[key] = (tuple(b - least if b < NO // 2 else NO for b in before), least)
        return known

    def choose(self, code: int, after: tuple, state: int) -> tuple[str, str, int]:
        """(letters, new roles, next state): ASCII-least edits of the row on a cheapest path."""
        key = (code, after, state)
        known = self._choices.get(key)
        if known is None:
            before, at, letters, roles = self._before(code, after), state, "", []
            while True:
                options = [o for o in self._options(code, at, after) if o[0] == before[at]]
                if INSERT + before[FOLLOWS[at]] == before[at]:
                    options.append((before[at], "I", ROLE_OF[FOLLOWS[at]], -1))
                _, letter, role, to = min(options, key=lambda o: o[1])
                letters += letter
                roles.append(role)
                if letter != "I":
                    break
                at = FOLLOWS[at]
            known = self._choices[key] = (letters, ",".join(roles), to)
        return known

    def ending(self, state: int) -> tuple[str, str]:
        """Inserts after the last row."""
        roles = []
        while FINAL[state]:
            state = FOLLOWS[state]
            roles.append(ROLE_OF[state])
        return "I" * len(roles), ",".join(roles)

    def backward(self, codes: list[int], end: tuple, every: int = 0) -> tuple[tuple, int, list[tuple]]:
        """The reduced vector before the first row, the least cost taken off it, and the reduced
        vectors after rows every, 2 * every, ... (from the last to the first)."""
        least = min(end)
        vector, kept = tuple(e - least if e < NO // 2 else NO for e in end), []
        for i in range(len(codes) - 1, -1, -1):
            if every and (i + 1) % every == 0:
                kept.append(vector)
            vector, more = self.step(codes[i], vector)
            least += more
        return vector, least, kept

    def walk(self, codes: list[int], end: tuple, state: int) -> tuple[list[tuple[str, str]], int]:
        """The (letters, new roles) of every row from ``state`` on, and the state after the last."""
        every = math.isqrt(len(codes)) + 1
        _, _, kept = self.backward(codes, end, every)
        least = min(end)
        last = tuple(e - least if e < NO // 2 else NO for e in end)
        out = []
        for begin in range(0, len(codes), every):
            part = codes[begin : begin + every]
            after = [kept.pop() if len(part) == every else last]
            for code in reversed(part[1:]):
                after.append(self.step(code, after[-1])[0])
            for code in part:
                letters, roles, state = self.choose(code, after.pop(), state)
                out.append((letters, roles))
        return out, state


def _is_cut(text: str) -> bool:
    return text.rstrip(BLANKS)[-1:] not in ".!?"


class _Rows:
    """Columns of edit rows, given out as Arrow batches of bounded size."""

    def __init__(self) -> None:
        self.columns: list[list] = [[] for _ in _EDITS]
        self.bytes = 0

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.bytes += len(row[5])

    def full(self) -> bool:
        return len(self.columns[0]) >= BATCH_ROWS or self.bytes >= BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, _EDITS, strict=True)], schema=_EDITS)
        self.__init__()
        return batch


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """(id, its rows) of the runs of equal ids in a sorted partition."""
    held, rows, some = None, [], False
    for batch in batches:
        for conv, turn, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")], strict=True):
            if some and conv != held:
                yield held, rows
                rows = []
            held, some = conv, True
            rows.append((turn, role, text))
    if some:
        yield held, rows


def _repair_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    programme, out = Programme(), _Rows()
    for conv, rows in _conversations(batches):
        seen, faults, codes = set(), [], []
        for _, role, text in rows:
            if not text.strip(BLANKS):
                fault, kind = "blank", GONE
            elif (role, text) in seen:
                fault, kind = "duplicate", GONE
            elif _is_cut(text):
                fault, kind = "truncated", CUT
            else:
                fault, kind = None, WHOLE
            seen.add((role, text))
            faults.append(fault)
            codes.append(row_code(role[:1], kind))
        edits, state = programme.walk(codes, FINAL, 0)
        for i, ((letters, new), (turn, role, text), fault) in enumerate(zip(edits, rows, faults, strict=True)):
            for j, (letter, named) in enumerate(zip(letters, new.split(","), strict=True)):
                if letter == "I":
                    out.add(conv, 4 * i + j, letter, None, named, "", None, None, INSERT)
                else:
                    cost = DELETE if letter == "D" else (letter == "R") * REROLE + (fault == "truncated") * TRUNCATED
                    out.add(conv, 4 * i + j, letter, turn, named or role, text, role[:1], fault, cost)
            if out.full():
                yield out.take()
        letters, new = programme.ending(state)
        for j, named in enumerate(new.split(",") if letters else []):
            out.add(conv, 4 * len(rows) + j, "I", None, named, "", None, None, INSERT)
    if out.columns[0]:
        yield out.take()


def _digest_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its edits in order."""
    done: list[tuple] = []
    state: dict = {}

    def close() -> None:
        gaps = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
        counts = [state["faults"].get(f, 0) for f in ("blank", "duplicate", "truncated")]
        done.append((state["conv"], gaps, *counts, state["illegal"], state["cost"], "".join(state["audit"]), state["hash"].hexdigest()))

    def take() -> pa.RecordBatch:
        names = [f.split()[0] for f in SUMMARY.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
        done.clear()
        return batch

    names = ("conv_id", "edit", "turn", "role", "text", "initial", "fault", "cost")
    for batch in batches:
        for conv, edit, turn, role, text, initial, fault, cost in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
            if not state or conv != state["conv"]:
                if state:
                    close()
                state = dict(conv=conv, high=None, low=None, turns=0, faults={}, illegal=0, cost=0, audit=[], hash=hashlib.sha256(), some=False, before=None)
            state["audit"].append(edit)
            state["cost"] += cost
            if edit != "I":
                if turn is not None and turn != state["high"]:
                    state["turns"] += 1
                    state["high"] = turn
                    state["low"] = turn if state["low"] is None else state["low"]
                if fault:
                    state["faults"][fault] = state["faults"].get(fault, 0) + 1
                if state["before"] is not None and state["before"] + initial not in ("su", "ua", "au"):
                    state["illegal"] += 1
                state["before"] = initial
            if edit != "D":
                state["hash"].update(("\n" if state["some"] else "").encode() + f"{role}:{text}".encode())
                state["some"] = True
        if len(done) >= BATCH_ROWS:
            yield take()
    if state:
        close()
    if done:
        yield take()


def clean_columns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; a null role or text is one space."""
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )


def _parts(rows: DataFrame, long_rows: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the usual conversations, sorted by conversation; rows of the long ones, None without any)."""
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    long_ids = materialize(sizes.filter((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("conv_id"), "long_conversations")
    usual, long = rows, None
    if not long_ids.isEmpty():
        same = rows["conv_id"].eqNullSafe(long_ids["conv_id"])
        usual, long = rows.join(long_ids, same, "left_anti"), rows.join(long_ids, same, "left_semi")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    return usual.repartition("conv_id").sortWithinPartitions("conv_id", *order), long


def _codes(table: pa.Table) -> list[int]:
    return table.sort_by("pos").column("code").to_pylist()


def _costs_of_block(table: pa.Table) -> pa.Table:
    """Least cost from every state before the block to every state after it."""
    codes, programme = _codes(table), Programme()
    costs = []
    for to in STATES:
        vector, least, _ = programme.backward(codes, tuple(0 if s == to else NO for s in STATES))
        costs.append([v + least if v < NO // 2 else NO for v in vector])
    between = [costs[to][s] for s in STATES for to in STATES]
    return pa.table({"conv_id": table.column("conv_id")[:1], "block": table.column("block")[:1], "between": pa.array([between], pa.list_(pa.int64()))})


def _ends_of_blocks(table: pa.Table) -> pa.Table:
    """The vector after every block, from the last block to the first."""
    table = table.sort_by([("block", "descending")])
    vector, ends = FINAL, []
    for between in table.column("between").to_pylist():
        ends.append([v - min(vector) for v in vector])
        vector = tuple(min(between[4 * s + to] + vector[to] for to in STATES) for s in STATES)
    return pa.table({"conv_id": table.column("conv_id"), "block": table.column("block"), "after": pa.array(ends, pa.list_(pa.int64()))})


def _walks_of_block(table: pa.Table) -> pa.Table:
    """For each of the four states before the block: the state after it and the edits of its rows."""
    after = tuple(table.column("after")[0].as_py())
    codes, programme = _codes(table), Programme()
    walks = [programme.walk(codes, after, s) for s in STATES]
    edits = [[f"{letters}:{new}" for letters, new in out] for out, _ in walks]
    return pa.table({
        "conv_id": table.column("conv_id")[:1],
        "block": table.column("block")[:1],
        "leads": pa.array([[to for _, to in walks]], pa.list_(pa.int32())),
        "edits": pa.array([edits], pa.list_(pa.list_(pa.string()))),
    })


def _entries_of_blocks(table: pa.Table) -> pa.Table:
    """The state in which every block is entered, and what is inserted after the last."""
    table = table.sort_by("block")
    state, entered = 0, []
    for leads in table.column("leads").to_pylist():
        entered.append(state)
        state = leads[state]
    letters, new = Programme().ending(state)
    ending = [None] * (len(entered) - 1) + [f"{letters}:{new}" if letters else None]
    return pa.table({
        "conv_id": table.column("conv_id"), "block": table.column("block"),
        "entered": pa.array(entered, pa.int32()), "ending": pa.array(ending, pa.string()),
    })


def _repair_long(rows: DataFrame, block_rows: int) -> DataFrame:
    """Edits of conversations of any length, a block at a time."""
    # equal rows are interchangeable, so their position in the input may part them
    rows = rows.withColumn("text_hash", F.sha2("text", 256)).withColumn("copy", F.monotonically_increasing_id())
    order = ["turn asc nulls first", "role", "text", "copy"]
    rows = materialize(number_within(rows, ["conv_id"], order, "pos").withColumn("pos", F.col("pos") - 1), "repair_rows")
    firsts = rows.groupBy("conv_id", "role", "text_hash").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    shown = F.rtrim("text", F.lit(BLANKS))
    narrow = rows.select("conv_id", "pos", "role", "text_hash", F.length(shown).alias("shown"), F.substring(shown, -1, 1).alias("last"))
    kind = (
        F.when(F.col("shown") == 0, "blank").when(F.col("pos") > F.col("first_pos"), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    marked = join_null_safe(narrow, firsts, ["conv_id", "role", "text_hash"], "left")
    marked = marked.select("conv_id", "pos", F.substring("role", 1, 1).alias("initial"), kind.alias("fault"))
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    doom = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", CUT).otherwise(WHOLE)
    block = F.floor(F.col("pos") / block_rows).cast("long")
    codes = materialize(marked.select("conv_id", "pos", block.alias("block"), (3 * initial + doom).alias("code"), "initial", "fault"), "repair_codes")
    key = "conv_id long, block long"
    narrow = codes.select("conv_id", "block", "pos", "code")
    between = narrow.groupBy("conv_id", "block").applyInArrow(_costs_of_block, f"{key}, between array<long>")
    ends = materialize(between.groupBy("conv_id").applyInArrow(_ends_of_blocks, f"{key}, after array<long>"), "repair_ends")
    walks = join_null_safe(narrow, ends, ["conv_id", "block"]).groupBy("conv_id", "block")
    walks = materialize(walks.applyInArrow(_walks_of_block, f"{key}, leads array<int>, edits array<array<string>>"), "repair_walks")
    entries = walks.select("conv_id", "block", "leads").groupBy("conv_id").applyInArrow(_entries_of_blocks, f"{key}, entered int, ending string")
    entries = materialize(entries, "repair_entries")
    taken = join_null_safe(walks, entries, ["conv_id", "block"])
    taken = taken.select("conv_id", "block", F.posexplode(F.col("edits")[F.col("entered")]).alias("at", "how"))
    taken = taken.select("conv_id", (F.col("block") * block_rows + F.col("at")).alias("pos"), "how")
    edited = join_null_safe(join_null_safe(rows, taken, ["conv_id", "pos"]), codes.select("conv_id", "pos", "initial", "fault"), ["conv_id", "pos"])
    counted = codes.groupBy("conv_id").agg(F.max("pos").alias("pos"))
    after = join_null_safe(entries.filter("ending IS NOT NULL").select("conv_id", "ending"), counted, ["conv_id"])
    none = F.lit(None)
    after = after.select(
        "conv_id", (F.col("pos") + 1).alias("pos"), none.cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.col("ending").alias("how"), none.cast("string").alias("initial"), none.cast("string").alias("fault"),
    )
    rows_to_edit = edited.select(*after.columns).unionByName(after)
    letters, named = F.split_part("how", F.lit(":"), F.lit(1)), F.split(F.split_part("how", F.lit(":"), F.lit(2)), ",")
    single = rows_to_edit.withColumn("named", named).withColumn("letters", letters)
    single = single.withColumn("j", F.explode(F.sequence(F.lit(0), F.length("letters") - 1)))
    edit = F.substr("letters", F.col("j") + 1, F.lit(1))
    single = single.withColumn("edit", edit).withColumn("new_role", F.col("named")[F.col("j")])
    added = F.col("edit") == "I"
    cost = (
        F.when(added, INSERT).when(F.col("edit") == "D", DELETE)
        .otherwise(F.when(F.col("edit") == "R", REROLE).otherwise(0) + F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0))
    )
    return single.select(
        "conv_id",
        (F.col("pos") * 4 + F.col("j")).alias("seq"),
        "edit",
        F.when(~added, F.col("turn")).alias("turn"),
        F.when(F.col("new_role") != "", F.col("new_role")).otherwise(F.col("role")).alias("role"),
        F.when(added, "").otherwise(F.col("text")).alias("text"),
        F.when(~added, F.col("initial")).alias("initial"),
        F.when(~added, F.col("fault")).alias("fault"),
        cost.cast("long").alias("cost"),
    )


def repair(conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row an edit of ``conversations(conv_id, turn, role, text)``: conv_id, seq (orders the edits of a
    conversation), edit (K, R, D or I), turn, role (the new one), text, initial (of the given role), fault
    (blank, duplicate, truncated or null), cost.  The rows that aren't deleted are the repaired conversation."""
    usual, long = _parts(clean_columns(conversations), long_rows, long_bytes)
    edits = usual.mapInArrow(_repair_partition, EDITS)
    return edits if long is None else edits.unionByName(_repair_long(long, long_rows))


def summarize(conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row a conversation, from the edits of :func:`repair`: conv_id, gaps (turns missing between the first
    and the last), blank, duplicate, truncated, illegal (neighbouring roles out of turn), cost,
    audit (the edit letters), repaired_sha256 (of the repaired ``role:text`` lines)."""
    usual, long = _parts(clean_columns(conversations), long_rows, long_bytes)
    # edits come out conversation by conversation and in order, so the digest needs no shuffle of its own
    found = usual.mapInArrow(_repair_partition, EDITS).mapInArrow(_digest_partition, SUMMARY)
    if long is not None:
        edits = _repair_long(long, long_rows).repartition("conv_id").sortWithinPartitions("conv_id", "seq")
        found = found.unionByName(edits.mapInArrow(_digest_partition, SUMMARY))
    return found


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with known faults, by crc32(conv_id:turn) % 20 (nulls are one space): 0 drops the row, 1
    empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it the user's."""
    rows = clean_columns(conversations)
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    rows = rows.withColumn("kind", kind).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def every_conversation(conversations: DataFrame, summary: DataFrame) -> DataFrame:
    """``summary`` with a row for each id of ``conversations``; one without rows left has zeros, no edits and
    the hash of the empty string."""
    ids = conversations.select(F.col("conv_id").cast("long")).distinct()
    found = join_null_safe(ids, summary, ["conv_id"], "left")
    zero = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return found.na.fill(zero | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})
