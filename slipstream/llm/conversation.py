"""Conversation structure repair: the cheapest edits that make a conversation an alternation of user and assistant.

The edits of a conversation are spelled as an audit string, one initial for each edit (Keep, Rerole, Delete, Insert). A dynamic
program goes through the rows with one best audit for each of four states of the roles read so far. Audits are not
strings there but nodes of a persistent tree: a node adds one initial to its parent, so all audits share their prefixes, and
keeps binary-lifting ancestors and a rolling hash. Equal costs are decided by a longest-common-prefix search over the
ancestors: equal hashes are taken for equal prefixes only after the nodes themselves have been compared.

Segments. Audits that leave one state and have the same rows behind them never begin with one another as long as insertions are
written before the row that follows them, so which of two is ASCII-least is decided inside a segment of rows. What a segment does
to all that precedes it is therefore a 4 x 4 table of costs and, for each state it is entered in, the order of its four audits.
Such tables are joined from segment to segment, so a conversation of any length is worked on in many tasks.

Rows are dealt out by ranges of (conversation, turn). A conversation that lies inside one range is finished there; the first and the
last one of a range may go on elsewhere, and only these take the way by segments.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm import packed
from slipstream.session import staged

#: What the contract fixes: costs of edits, and the legal roles.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"

SEGMENT = 2048  # rows of a segment
#: States: nothing read, system read, user read, assistant read. A role's initial leads from one state to another.
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ENDS = (0, 3)
STATES = range(4)
_LEGAL = frozenset(("su", "ua", "au"))
_BASE, _MOD = 1_000_003, (1 << 61) - 1


class Audits:
    """A tree of audit strings that share prefixes. Node 0 is the empty audit."""

    def __init__(self):
        self.initial, self.depth, self.hash, self.up = [""], [0], [0], [(0,)]
        self.verified: set[tuple[int, int]] = set()

    def add(self, parent: int, initial: str) -> int:
        """The audit of ``parent`` with one more edit."""
        node = len(self.initial)
        jumps = [parent]  # ancestors 1, 2, 4, 8, ... steps up
        while (far := len(jumps) - 1) < len(self.up[jumps[-1]]) and jumps[-1]:
            jumps.append(self.up[jumps[-1]][far])
        self.initial.append(initial)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(initial)) % _MOD)
        self.up.append(tuple(jumps))
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The prefix of some length."""
        while (rest := self.depth[node] - depth) > 0:
            jumps = self.up[node]
            node = jumps[min(rest.bit_length(), len(jumps)) - 1]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal; equal hashes are verified node by node, once."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        walked = []
        while a != b and (a, b) not in self.verified:
            if self.initial[a] != self.initial[b]:
                return False
            walked.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        self.verified.update(walked)
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether audit ``a`` is ASCII-less than ``b``."""
        length = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, length), self.ancestor(b, length)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        while not self.same(p := self.up[x][0], q := self.up[y][0]):  # lift both to the first edit that differs
            for k in range(min(len(self.up[x]), len(self.up[y])) - 1, 0, -1):
                if not self.same(self.up[x][k], self.up[y][k]):
                    p, q = self.up[x][k], self.up[y][k]
                    break
            x, y = p, q
        return self.initial[x] < self.initial[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.initial[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def _better(audits: Audits, best: list, state: int, cost: int, parent: int, initial: str) -> None:
    """Offer an edit as the best way into a state."""
    held = best[state]
    if held is None or cost <= held[0]:
        node = audits.add(parent, initial)
        if held is None or cost < held[0] or audits.before(node, held[1]):
            best[state] = (cost, node)


def _inserted(audits: Audits, best: list) -> list:
    """The best audits when rows may be inserted; more than two in a row never pay."""
    out = list(best)
    for _ in range(2):
        now = list(out)
        for state in STATES:
            if now[state] is not None:
                for initial, to in STEPS[state].items():
                    if initial != "s":
                        _better(audits, out, to, now[state][0] + INSERT, now[state][1], "I")
    return out


def _row(audits: Audits, best: list, initial: str, must_go: bool, cut: bool) -> list:
    """The best audits after one more row; nothing is inserted behind it."""
    out: list = [None] * len(STATES)
    extra = TRUNCATED if cut else 0
    for state, held in enumerate(_inserted(audits, best)):
        if held is None:
            continue
        cost, node = held
        _better(audits, out, state, cost + DELETE, node, "D")
        if not must_go:
            for legal, to in STEPS[state].items():
                if legal == initial:
                    _better(audits, out, to, cost + KEEP + extra, node, "K")
                if legal != "s":
                    _better(audits, out, to, cost + REROLE + extra, node, "R")
    return out


def segment(rows: list[tuple[str, bool, bool]], entries=STATES) -> list[list[tuple[int, int, str] | None] | None]:
    """For each state that the rows (initial of the role, must be deleted, truncated) are entered in: for each state after them
    (cost, rank of its audit, audit), or None where it cannot be reached."""
    table: list = []
    for entry in STATES:
        if entry not in entries:
            table.append(None)
            continue
        audits = Audits()
        best: list = [None] * len(STATES)
        best[entry] = (0, 0)
        for row in rows:
            best = _row(audits, best, *row)
        order = sorted((s for s in STATES if best[s]), key=functools.cmp_to_key(lambda a, b: -1 if audits.before(best[a][1], best[b][1]) else 1))
        table.append([best[s] and (best[s][0], order.index(s), audits.text(best[s][1])) for s in STATES])
    return table


Bound = list  # for each state None or (cost, rank of the audit up to here)
START: Bound = [(0, 0), None, None, None]


def carried(bound: Bound, table) -> tuple[Bound, list[int | None]]:
    """(best costs and ranks behind a segment, for each state the state that its best audit enters the segment in)."""
    found: list = [None] * len(STATES)
    for entry in STATES:
        if bound[entry] is not None:
            for to in STATES:
                if table[entry][to] is not None:
                    cost, rank = bound[entry][0] + table[entry][to][0], (bound[entry][1], table[entry][to][1])
                    if found[to] is None or (cost, rank) < found[to][:2]:
                        found[to] = (cost, rank, entry)
    ranks = sorted(f[1] for f in found if f)
    return [f and (f[0], ranks.index(f[1])) for f in found], [f and f[2] for f in found]


#: Insertions that end a conversation, by the state before them.
TAILS = {0: "", 1: "II", 2: "I", 3: ""}


def ended(bound: Bound) -> tuple[int, int]:
    """(cost, state before the last insertions) of the cheapest, ASCII-least whole audit."""
    cost, _, state = min((bound[s][0] + INSERT * len(TAILS[s]), bound[s][1], s) for s in STATES if bound[s])
    return cost, state


def applied(audit: str, rows: Iterator[tuple[str, str]], state: int) -> Iterator[tuple[str, str] | int]:
    """The repaired rows (role, text), and the state after them at last."""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit in "RI":
            role = ASSISTANT if state == 2 else USER
        state = STEPS[state][role[:1]]
        yield role, text
    yield state


class Joined:
    """Digest of lines joined by line feeds, line by line."""

    def __init__(self):
        self.digest, self.first = hashlib.sha256(), True

    def add(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after a repeatable damage by crc32 of `conv_id:turn` (a null is one space) modulo 20: 0 drops a row, 1 empties its text, 2
    takes out its `[.!?]`, 3 repeats it, 4 makes it the user's. Null roles and texts are one space. Columns: conv_id, turn, role, text, n
    (how often the row stands there: a dropped one 0 times, with neither role nor text, so that its conversation is still known)."""

    def spelled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat_ws(":", spelled("conv_id"), spelled("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", spelled("role").alias("role"), spelled("text").alias("text"), fate.alias("_fate"))
    text = F.when(F.col("_fate") <= 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 0, "").when(F.col("_fate") == 4, USER).otherwise(F.col("role"))
    n = F.when(F.col("_fate") == 0, 0).when(F.col("_fate") == 3, 2).otherwise(1).cast("bigint")
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), n.alias("n"))


def as_they_are(rows: DataFrame) -> DataFrame:
    """The columns that `repair` takes, of undamaged rows; null roles and texts are one space."""
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", "turn", *spelled, F.lit(1).cast("bigint").alias("n"))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_DONE = pa.schema([*((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_DONE_SQL = ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"
_SPACES = b" \t\n\v\f\r"
_ORDER = ("conv_id", "turn", "role", "text")


def faults(role: str, text: str, seen: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated, or nothing."""
    bare = text.encode().strip(_SPACES)
    return "blank" if not bare else "duplicate" if seen else "truncated" if bare[-1:] not in (b".", b"!", b"?") else ""


class Tally:
    """The counts of a conversation, row by row or segment by segment in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None  # initials of the first and last row, lowest and highest turn

    def row(self, turn: int | None, initial: str, fault: str) -> None:
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.append([0, 0, 0, 0, int(turn is not None), initial, initial, turn, turn])

    def append(self, other: list) -> None:
        """What follows: the values of another tally."""
        blank, duplicate, truncated, illegal, turns, first, last, low, high = other
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.illegal += illegal
        if first is not None:
            if self.last is not None and self.last + first not in _LEGAL:
                self.illegal += 1
            self.first, self.last = first if self.first is None else self.first, last
        if low is not None:
            self.turns += turns - (self.high == low)  # rows come in the order of turns
            self.low, self.high = low if self.low is None else self.low, high

    def values(self) -> list:
        return [self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.first, self.last, self.low, self.high]

    def counts(self, cost: int) -> list[int]:
        """The values of `_COUNTS`."""
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost]


def finish(rows: list[tuple]) -> tuple:
    """What `_DONE` holds of a whole conversation, from its rows (turn, role, text, how often)."""
    tally, plan, seen = Tally(), [], set()
    for turn, role, text, n in rows:
        for _ in range(n):
            fault = faults(role, text, (role, text) in seen)
            seen.add((role, text))
            tally.row(turn, role[:1], fault)
            plan.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    bound, steps = START, []
    for i in range(0, len(plan), SEGMENT):
        table = segment(plan[i : i + SEGMENT], [s for s in STATES if bound[s]])
        bound, back = carried(bound, table)
        steps.append((table, back))
    cost, state = ended(bound)
    audit = [TAILS[state]]
    for table, back in reversed(steps):
        audit.append(table[back[state]][state][2])
        state = back[state]
    audit = "".join(reversed(audit))
    joined = Joined()
    originals = ((role, text) for _, role, text, n in rows for _ in range(n))
    for line in applied(audit, originals, 0):
        if not isinstance(line, int):
            joined.add(*line)
    return *tally.counts(cost), audit, joined.digest.hexdigest()


def _records(batches, *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _merged(rows: DataFrame) -> DataFrame:
    """Equal rows of a batch become one, so that a row of which there are very many does not weigh on the task it is sent to."""
    schema = rows.schema

    def merge(batches):
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).group_by(list(_ORDER)).aggregate([("n", "sum")])
                yield from table.rename_columns([*_ORDER, "n"]).to_batches()

    return rows.mapInArrow(merge, schema)


def _dealt_in_order(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Rows dealt out by ranges of their order. Of long texts the first characters decide, so that borders are short."""
    by = [F.col("conv_id"), F.col("turn"), F.substring("role", 1, 16), F.substring("text", 1, 32)]
    dealt = rows.repartitionByRange(*by) if n is None else rows.repartitionByRange(n, *by)
    return dealt.sortWithinPartitions(*_ORDER)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _sized(records: Iterator[tuple], names: list[str], types: list, rows: int = 2000, letters: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Records as batches of bounded size."""
    held, size = [], 0
    for record in records:
        held.append(record)
        size += sum(len(v) for v in record if isinstance(v, str))
        if len(held) >= rows or size >= letters:
            yield _batch(held, names, types)
            held, size = [], 0
    if held:
        yield _batch(held, names, types)


def _typed(batches) -> tuple[Iterator, pa.Schema | None]:
    """The batches, and their schema where there are any."""
    batches = iter(batches)
    first = next(batches, None)
    return (itertools.chain([first], batches), first.schema) if first is not None else (iter(()), None)


def _type(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()


def _inside(rows: DataFrame) -> DataFrame:
    """Conversations that begin and end in one range are finished; rows of the others come out as they are, with ``open`` true."""
    names = ["conv_id", "open", "turn", "role", "text", "n", *_DONE.names]

    def run(batches):
        batches, schema = _typed(batches)
        if schema is None:
            return
        types = [schema.field("conv_id").type, pa.bool_(), schema.field("turn").type, pa.string(), pa.string(), pa.int64(), *_DONE.types]
        yield from _sized(sorted_out(_records(batches, *_ORDER, "n")), names, types)

    def sorted_out(records):
        rest = (None,) * len(_DONE)
        current, held, opening = None, None, True
        for conv, *row in records:
            if held is None or conv != current:
                if held is not None and not opening:
                    yield conv_done(current, held)
                opening = held is None  # the first one may have begun in the range before
                current, held = conv, []
            if opening:
                yield (conv, True, *row, *rest)
            elif held and held[-1][:3] == row[:3]:
                held[-1][3] += row[3]
            else:
                held.append(row)
        for row in held or ():  # the last one may go on in the next range
            yield (current, True, *row, *rest)

    def conv_done(conv, held):
        return (conv, False, None, None, None, None, *finish(held))

    return rows.mapInArrow(run, f"conv_id {_type(rows, 'conv_id')}, open boolean, turn {_type(rows, 'turn')}, role string, text string, n bigint, {_DONE_SQL}")


def _seen(rows: DataFrame) -> DataFrame:
    """Equal rows as one, and ``known``: whether a row with the same role and text comes earlier in the conversation."""
    lines = rows.groupBy(*_ORDER).agg(F.sum("n").alias("n")).withColumn("_hash", F.md5("text"))
    turn = F.struct(F.col("turn").isNotNull().alias("is"), "turn")  # null turns come first
    first = lines.where("n > 0").groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("_hash").alias("_text")).agg(F.min(turn).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("_hash") == F.col("_text"))
    found = lines.join(first, same, "left")
    return found.select(*_ORDER, "n", F.coalesce(turn != F.col("_first"), F.lit(False)).alias("known"))


_CUT = ["conv_id", "part", "seq", "kind", "pos", "role", "text", "n", "summary"]


def _cut_sql(rows: DataFrame) -> str:
    return f"conv_id {_type(rows, 'conv_id')}, part int, seq int, kind int, pos int, role string, text string, n bigint, summary string"


def _cut_types(schema: pa.Schema) -> list:
    return [schema.field("conv_id").type, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string()]


def _segments(rows: DataFrame) -> DataFrame:
    """Rows in order, cut into segments: kind 0 sums a segment up (its tally and its table), kind 1 are its rows."""

    def run(batches):
        batches, schema = _typed(batches)
        if schema is not None:
            part = TaskContext.get().partitionId()
            yield from _sized(cut(_records(batches, *_ORDER, "n", "known"), part), _CUT, _cut_types(schema))

    def cut(records, part):
        for conv, own in itertools.groupby(records, key=lambda r: r[0]):
            seq, tally, plan = 0, Tally(), []
            for _, turn, role, text, n, known in own:
                while n:
                    take = min(n, SEGMENT - len(plan))
                    yield conv, part, seq, 1, len(plan), role, text, take, None
                    for _ in range(take):
                        fault = faults(role, text, known)
                        known = True
                        tally.row(turn, role[:1], fault)
                        plan.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
                    n -= take
                    if len(plan) == SEGMENT:
                        yield conv, part, seq, 0, -1, None, None, None, json.dumps([tally.values(), segment(plan)])
                        seq, tally, plan = seq + 1, Tally(), []
            if plan or not seq:
                yield conv, part, seq, 0, -1, None, None, None, json.dumps([tally.values(), segment(plan)])

    return rows.mapInArrow(run, _cut_sql(rows))


def _forward(cut: DataFrame) -> DataFrame:
    """For each segment the state and audit by which each state behind it is reached best; the last one of a conversation also
    has its counts and the state in which it ends. A conversation's segments stream through one task, one at a time."""

    def run(batches):
        batches, schema = _typed(batches)
        if schema is not None:
            yield from _sized(walk(_records(batches, "conv_id", "part", "seq", "summary")), _CUT, _cut_types(schema))

    def walk(records):
        for conv, own in itertools.groupby(records, key=lambda r: r[0]):
            bound, tally, before = START, Tally(), None
            for _, part, seq, summary in own:
                if before:
                    yield before
                values, table = json.loads(summary)
                tally.append(values)
                bound, back = carried(bound, table)
                ways = [b is not None and [b, table[b][s][2]] for s, b in enumerate(back)]
                before = (conv, part, seq, 0, -1, None, None, None, json.dumps([ways, None]))
            cost, state = ended(bound)
            yield *before[:-1], json.dumps([ways, [state, tally.counts(cost)]])

    rows = cut.where("kind = 0").select("conv_id", "part", "seq", "summary")
    return packed.dealt(rows, "conv_id", "part", "seq").mapInArrow(run, _cut_sql(cut))


def _backward(ways: DataFrame) -> DataFrame:
    """The audit of each segment (in ``text``) and the state it is entered in (in ``n``), from the end of each conversation."""

    def run(batches):
        batches, schema = _typed(batches)
        if schema is not None:
            yield from _sized(walk(_records(batches, "conv_id", "part", "seq", "summary")), _CUT, _cut_types(schema))

    def walk(records):
        state = None
        for conv, part, seq, summary in records:
            steps, end = json.loads(summary)
            tail = ""
            if end:
                state, tail = end[0], TAILS[end[0]]
            state, audit = steps[state]
            yield conv, part, seq, 0, -1, None, audit + tail, state, end and json.dumps(end[1])

    n = int(ways.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("part").desc(), F.col("seq").desc()]
    return ways.repartition(n, "conv_id").sortWithinPartitions(*order).mapInArrow(run, _cut_sql(ways))


def _applied(pieces: DataFrame, rows: DataFrame, turns: bool) -> DataFrame:
    """Segments' audits over their rows: the repaired turns, or what `_DONE` holds. Nothing but a conversation's audit is kept; its
    digest is one over all its rows, so they stream through one task."""

    def run(batches):
        batches, schema = _typed(batches)
        if schema is None:
            return
        kind = schema.field("conv_id").type
        records = _records(batches, *_CUT)
        if turns:
            yield from _sized(spoken(records), ["conv_id", "position", "role", "text"], [kind, pa.int64(), pa.string(), pa.string()])
        else:
            yield from _sized(summed(records), ["conv_id", *_DONE.names], [kind, *_DONE.types])

    def lines(own, audits):
        """The repaired rows of a conversation; the audits and the counts of its segments are put into ``audits``."""
        for _, records in itertools.groupby(own, key=lambda r: r[1:3]):
            *_, audit, state, counts = next(records)
            audits.append((audit, counts))
            originals = ((role, text) for *_, role, text, n, _ in records for _ in range(n))
            for line in applied(audit, originals, state):
                if not isinstance(line, int):
                    yield line

    def spoken(records):
        for conv, own in itertools.groupby(records, key=lambda r: r[0]):
            for position, (role, text) in enumerate(lines(own, [])):
                yield conv, position, role, text

    def summed(records):
        for conv, own in itertools.groupby(records, key=lambda r: r[0]):
            joined, audits = Joined(), []
            for line in lines(own, audits):
                joined.add(*line)
            yield conv, *json.loads(audits[-1][1]), "".join(a for a, _ in audits), joined.digest.hexdigest()

    schema = f"conv_id {_type(rows, 'conv_id')}, " + ("position bigint, role string, text string" if turns else _DONE_SQL)
    both = pieces.unionByName(rows, True)
    # rows of one place are in the order of `_ORDER`
    order = ["conv_id", "part", "seq", "kind", "pos", *(c for c in ("turn",) if c in both.columns), "role", "text"]
    return packed.dealt(both, *order).select(*_CUT).mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation.

    ``rows``: conv_id, turn, role, text, n, as `damaged` or `as_they_are` give them. A conversation's rows come by turn, null turns
    first, then by role and text; a row stands there n times. A row's first fault counts: blank (no character but space and U+0009
    to U+000D), duplicate (role and text seen earlier), truncated (the last such character is none of `.!?`). Keeping a row costs 0,
    making it the user's or the assistant's 3, deleting it 4 (blank and duplicate rows must go), inserting an empty turn of
    either 3; a truncated row that is not deleted costs 3 more. The initials of the roles that are left spell `(s?(ua)+)?`.
    Null conversations are one conversation; an empty table gives no rows; a conversation whose rows all stand there 0 times
    has zeros, no audit and the digest of nothing. Of the cheapest audits the ASCII-least one is taken.

    Result, one row for each conv_id: gaps (turns missing between the lowest and the highest), blank, duplicate, truncated, illegal (neighbours
    whose roles do not begin with su, ua or au), cost, audit, repaired_sha256 (`role:text` joined by line feeds).
    """
    found = staged(_inside(_dealt_in_order(_merged(rows.select(*_ORDER, "n")))), "conversations")
    done = found.where("NOT open").select("conv_id", *_DONE.names)
    cut = staged(_segments(_dealt_in_order(_seen(found.where("open").select(*_ORDER, "n")))), "segments")
    return done.unionByName(_applied(_backward(_forward(cut)), cut.where("kind = 1"), False))


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the turns that are left of the conversations after the audits that `repair` has found."""
    none = "CAST(NULL AS STRING)"
    pieces = found.selectExpr("conv_id", "0 AS part", "0 AS seq", "0 AS kind", "-1 AS pos", f"{none} AS role", "audit AS text", "0L AS n", f"{none} AS summary")
    own = rows.where("n > 0").selectExpr("conv_id", "0 AS part", "0 AS seq", "1 AS kind", "0 AS pos", "role", "text", "n", f"{none} AS summary", "turn")
    return _applied(pieces, own, True)
