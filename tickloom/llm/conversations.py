"""Repair of the turn structure of conversations by the cheapest edits, found with square-root checkpoints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.units import bounded, listed, release, slices
from tickloom.session import written

#: Kinds of first initials, and faults of a row; a row's code is kind + 4 * fault.
KINDS = "sua"
OTHER = 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States of a repaired conversation: nothing yet, after system, after user, after assistant; it may end in these.
ENDS = (0, 3)
#: State after an insert or a new role, and that role: only one is possible in each state.
_NEXT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: State after a row of a kind is kept in a state, where that is allowed.
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
DELETE, NEW = 3, 2
NEVER = 1 << 60
LONGEST = (1 << 63) - 1
_SPACE = r"\x20\x09-\x0D"
_BATCH_BYTES = 1 << 20


# -- the edits of one conversation ------------------------------------------------------------------------------------


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs from a place on, when rows may be inserted there: one insert does, as two lead back."""
    two, three = min(costs[2], NEW + costs[3]), min(costs[3], NEW + costs[2])
    return min(costs[0], NEW + two), min(costs[1], NEW + two), two, three


_END = _inserted([0 if s in ENDS else NEVER for s in range(4)])


def _choices(code: int, state: int, after: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """(initial, cost to the end, next state) of what can be done with a row, in the order of initials."""
    fault, found = code >> 2, [("D", DELETE + after[state], state)]
    if fault not in (BLANK, DUPLICATE):
        more = int(fault == TRUNCATED)
        to = _KEPT.get((state, code & 3))
        if to is not None:
            found.append(("K", more + after[to], to))
        found.append(("R", NEW + more + after[_NEXT[state]], _NEXT[state]))
    return found


def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    return _inserted([min(c for _, c, _ in _choices(code, s, after)) for s in range(4)])


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Least cost of edits that make the rows legal, and the ASCII-least initials of such edits.

    Costs of going on from each state are computed backward and kept at about sqrt(n) checkpoints only; each block's
    costs are computed again from its checkpoint while the walk goes forward, which takes the least initial that stays on a
    cheapest way. So 4 numbers are held for 2 sqrt(n) places and one byte for each row.
    """
    n = len(codes)
    step = isqrt(n) + 1
    kept, costs = {n: _END}, _END
    for i in range(n - 1, -1, -1):
        costs = _before(codes[i], costs)
        if i % step == 0:
            kept[i] = costs
    least, state, edits = costs[0], 0, []
    for begin in range(0, n, step):
        end = min(n, begin + step)
        block = [kept[end]]
        for i in range(end - 1, begin, -1):
            block.append(_before(codes[i], block[-1]))
        block.append(kept[begin])
        for i in range(begin, end):
            here, after = block.pop(), block[-1]
            while True:
                ways = _choices(codes[i], state, after)
                ways.append(("I", NEW + here[_NEXT[state]], _NEXT[state]))
                edit, _, state = min(w for w in ways if w[1] == here[state])
                edits.append(edit)
                if edit != "I":
                    break
    while state not in ENDS:
        edits.append("I")
        state = _NEXT[state]
    return least, "".join(edits)


class _Structure:
    """What is known of a conversation after its rows went by in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes = conv_id, bytearray()
        self.turns, self.first, self.last, self.illegal = 0, None, None, 0

    def add(self, turn: int | None, kind: int, fault: int, first: bool, copies: int) -> None:
        """copies rows that are equal; all but the first, or all if first is false, are seen earlier."""
        if not copies:
            return
        if turn is not None and (self.last is None or turn != self.last):
            self.first = turn if self.first is None else self.first
            self.turns, self.last = self.turns + 1, turn
        again = kind + 4 * (fault if fault == BLANK else DUPLICATE)
        self.illegal += bool(self.codes) and (self.codes[-1] & 3, kind) not in ((0, 1), (1, 2), (2, 1))
        self.illegal += copies - 1  # no initial may follow itself
        self.codes.append(kind + 4 * fault if first else again)
        self.codes.extend(bytes([again]) * (copies - 1))

    def result(self) -> tuple:
        counts = [sum(self.codes.count(k + 4 * f) for k in range(4)) for f in (BLANK, DUPLICATE, TRUNCATED)]
        gaps = min(LONGEST, self.last - self.first + 1 - self.turns) if self.turns else 0
        return self.conv_id, len(self.codes), gaps, *counts, self.illegal, *cheapest_edits(bytes(self.codes))


# -- rows --------------------------------------------------------------------------------------------------------------


def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id, turn (long), role, text; a null role or text is one space."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return bounded(rows).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *filled)


def damaged(turns: DataFrame) -> DataFrame:
    """turns_of with faults that the crc32 of conv_id:turn decides, and copies: how often a row stands there.

    Of 20 remainders, 0 drops the row (copies 0), 1 empties its text, 2 removes . ! ? from it, 3 repeats it, 4 makes its
    role user. A null conv_id or turn is one space in the hashed text.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def counted(turns: DataFrame) -> DataFrame:
    """Equal rows as one with the sum of their copies, which each task adds up before any row is sent."""
    copies = F.sum("copies") if "copies" in turns.columns else F.count("*")
    return turns.groupBy("conv_id", "turn", "role", "text").agg(copies.alias("copies"))


def _fault() -> Column:
    blank = ~F.col("text").rlike(f"[^{_SPACE}]")
    return F.when(blank, BLANK).when(~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z"), TRUNCATED).otherwise(SOUND)


_PLAN = "conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _plan_batch(results: list[tuple]) -> pa.RecordBatch:
    names, kinds = [x.split()[0] for x in _PLAN.split(", ")], [pa.int64()] * 8 + [pa.string()]
    return pa.record_batch({n: pa.array(v, k) for n, k, v in zip(names, kinds, zip(*results, strict=True), strict=True)})


def _plan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    now, done, size = None, [], 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "fault", "first", "copies"))
        for conv_id, *row in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.result())
                    size += 100 + len(done[-1][-1])
                now = _Structure(conv_id)
            now.add(*row)
            if size > _BATCH_BYTES:
                yield _plan_batch(done)
                done, size = [], 0
    if now is not None:
        yield _plan_batch([*done, now.result()])


def plan_repairs(rows: DataFrame) -> DataFrame:
    """The structure of each conversation of counted() rows, and its cheapest repair.

    Rows of a conversation stand in the order of turn (nulls first), then role and text. A row's first fault counts:
    blank (white space only), duplicate (role and text seen earlier), truncated (its last other character is not . ! or ?).
    Edits make the roles' initials (s?(ua)+)? : K keeps a row, R gives it the role user or assistant, D deletes it, I inserts
    an empty row of user or assistant. They cost 0, 2, 3 and 2; blank and duplicate rows must go; a truncated row that
    stays costs 1 more. Of equally cheap edits the ASCII-least initials count.

    Texts and roles are judged before Python sees a row: what a task holds of a conversation is one byte for each row and
    costs at its checkpoints; a conversation is one task's, and its rows are sorted by Spark, which spills.
    Returns conv_id (also a null one, and those whose rows all have copies 0), n_rows, gaps (turns missing between the
    least and the greatest one), blank, duplicate, truncated, illegal (neighbours other than su, ua, au), cost, audit.
    """
    there = F.col("copies") > 0
    seen = Window.partitionBy("conv_id", "role", "text", there).orderBy(F.col("turn").asc_nulls_first())
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.substring("role", 1, 1)) - 1
    kind = F.when(kind >= 0, kind).otherwise(OTHER)
    dealt = rows.repartition("conv_id").withColumn("first", F.row_number().over(seen) == 1)
    dealt = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    codes = dealt.select("conv_id", "turn", kind.cast("int").alias("kind"), _fault().alias("fault"), "first", "copies")
    return codes.mapInArrow(_plan, _PLAN)


_REPAIRED = "conv_id long, position long, turn long, role string, text string, edit string"


class _Repaired:
    """Rows of repaired conversations, in batches of bounded size."""

    def __init__(self):
        self.rows, self.size = [], 0

    def add(self, conv_id, position, turn, role, text, edit) -> None:
        self.rows.append((conv_id, position, turn, role, text, edit))
        self.size += len(text) + 60

    def taken(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            names, kinds = [x.split()[0] for x in _REPAIRED.split(", ")], [pa.int64()] * 3 + [pa.string()] * 3
            yield pa.record_batch({n: pa.array(v, k) for n, k, v in zip(names, kinds, zip(*self.rows, strict=True), strict=True)})
            self.rows, self.size = [], 0


class _Walk:
    """A conversation's edits, taken row by row."""

    def __init__(self, conv_id: int | None, audit: str, out: _Repaired):
        self.conv_id, self.audit, self.out, self.at, self.state, self.position = conv_id, audit, out, 0, 0, 0

    def _put(self, turn: int | None, role: str, text: str, edit: str, state: int) -> None:
        self.out.add(self.conv_id, self.position, turn, role, text, edit)
        self.position, self.state = self.position + 1, state

    def inserts(self) -> None:
        while self.audit.startswith("I", self.at):
            self._put(None, _ROLE[self.state], "", "I", _NEXT[self.state])
            self.at += 1

    def row(self, turn: int | None, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self._put(turn, role, text, edit, _KEPT[self.state, KINDS.index(role[0])])
            elif edit == "R":
                self._put(turn, _ROLE[self.state], text, edit, _NEXT[self.state])


def _repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    out, walk = _Repaired(), None
    for batch in batches:
        for some in slices(batch, "text", _BATCH_BYTES, 4096):
            columns = (listed(some.column(c)) if c in ("role", "text") else some.column(c).to_pylist() for c in some.schema.names)
            for conv_id, turn, role, text, copies, audit in zip(*columns, strict=True):
                if audit is not None:  # the plan stands before its conversation's rows
                    if walk is not None:
                        walk.inserts()
                    walk = _Walk(conv_id, audit, out)
                else:
                    walk.row(turn, role, text, copies)
            yield from out.taken(_BATCH_BYTES)
    if walk is not None:
        walk.inserts()
    yield from out.taken(0)


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows that the edits of plan_repairs leave of counted() rows: conv_id, position (from 0), turn (null: inserted), role,
    text, edit (K, R or I). A conversation's rows leave one task in order; texts stream through it."""
    none = F.lit(None)
    plan = plans.select("conv_id", none.cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), "audit")
    whole = plan.unionByName(rows.filter("copies > 0").withColumn("audit", none.cast("string")))
    dealt = whole.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.select("conv_id", "turn", "role", "text", "copies", "audit").mapInArrow(_repair, _REPAIRED)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    done: list[tuple[int | None, str]] = []
    now, digest = None, None
    for batch in batches:
        for conv_id, position, role, text in zip(*(listed(batch.column(c)) if c in ("role", "text") else batch.column(c).to_pylist() for c in ("conv_id", "position", "role", "text")), strict=True):
            if digest is None or position == 0:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield pa.record_batch({"conv_id": pa.array([c for c, _ in done], pa.int64()), "sha256": pa.array([h for _, h in done])})
            done = []
    if digest is not None:
        yield pa.record_batch({"conv_id": pa.array([now], pa.int64()), "sha256": pa.array([digest.hexdigest()])})


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the sha256 of its repaired role:text lines; repaired: what repaired_turns returns, not dealt anew."""
    return repaired.mapInArrow(_digest, "conv_id long, sha256 string")


def repair_conversations(rows: DataFrame, damage: bool = False) -> tuple[DataFrame, DataFrame]:
    """(plan_repairs, repaired_turns) of a table with conv_id, turn, role and text, damaged first if asked.

    A null role or text is one space, so such a text is blank; rows without a conv_id are a conversation; null turns come
    first and count for no gap; equal rows are duplicates; an empty role, like any that does not begin with s, u or a, can
    be replaced or deleted only. An empty table gives none; other columns are not read.
    """
    turns = turns_of(rows)
    held = written(counted(damaged(turns) if damage else turns), "conversation-turns")
    plans = written(plan_repairs(held), "conversation-plans")
    return plans, repaired_turns(held, plans)


def audit_conversations(rows: DataFrame, damage: bool = True) -> DataFrame:
    """The plans of repair_conversations without n_rows, and repaired_sha256 of what they leave (of nothing: the empty string's)."""
    plans, repaired = repair_conversations(rows, damage)
    found = digests(repaired).withColumnRenamed("conv_id", "of_id")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    joined = plans.drop("n_rows").join(found, F.col("conv_id").eqNullSafe(F.col("of_id")), "left")
    return joined.withColumn("repaired_sha256", F.coalesce("sha256", empty)).drop("of_id", "sha256")
