"""Repair of conversations by divide and conquer over four states (Hirschberg, 1975).

A repaired conversation is empty or an optional system row and pairs of a user and an assistant row.
Rows are kept (0), given another role (1), deleted (2, the only choice for blank and repeated rows), or
inserted without text (5); a truncated row that is not deleted adds 5. The state is the role of the last
row put out: none, system, user or assistant. A row's edit, after the inserts in front of it, leads from
one state to another, so a stretch of rows is a table of 4 x 4 least costs.

Least-cost edits are found without a table over all rows: costs go forward from the first row and
backward from the last, four numbers each, and meet in the middle; crossings of least total cost stay
open, and the halves are done in turn, so that the numbers held are a few per halving. Of equal scripts
the one whose letters (K, R, D, I) are ASCII-least is wanted. Letters and rows fix the states, and no
script of a stretch is the beginning of another, so the left half alone tells which open crossing that is.

On Spark, rows are sorted by ranges of (conversation, turn), so a long conversation is cut over tasks,
and each task cuts its rows into blocks of bounded size. A conversation that lies in one block is
repaired there. The blocks of all others are put together in four passes that hold a few numbers per
block: their cost tables, from the last block to the first; what each start leads to; from the first to
the last; and their lines in order, digested as they pass.

Rows of equal turn stay in the order read, nulls of ``turn`` first; role and text that are null are one
space. A row with an empty role has no initial and can't be kept. Rows that repeat are duplicates. Every
conversation of the table has a result, the null one too; other columns are ignored, an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.llm.common import schema_with
from respondry.sources.workspace import written

SPACE = " \t\n\x0b\x0c\r"
#: States, by what was put out last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
INFINITE = 1 << 60
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Rows and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 20
#: Scripts of so many rows at most are remembered by a Python worker.
SHORT = 24

#: A row's code: three times its initial (s, u, a, other) plus its fault.
INITIALS = "sua"
FINE, LOST, CUT = range(3)
#: What may follow a state: the state a system, user or assistant row leads to.
FOLLOWS = ({SYSTEM, USER}, {USER}, {ASSISTANT}, {USER})
#: Where an inserted row, or one that gets the role due, leads.
DUE = (USER, USER, ASSISTANT, USER)


def _steps(code: int) -> list[list[tuple[int, str]]]:
    """Per pair of states the least cost of one row's edit and of inserts before it, and its letters."""
    initial, fault = divmod(code, 3)
    table = [[(INFINITE, "")] * 4 for _ in range(4)]
    for start in range(4):
        state = start
        for inserts in range(4):
            edits = [(DELETE, "D", state)]
            if fault != LOST:
                extra = TRUNCATED if fault == CUT else 0
                edits.append((REROLE + extra, "R", DUE[state]))
                if initial < 3 and initial + 1 in FOLLOWS[state]:
                    edits.append((extra, "K", initial + 1))
            for cost, letter, end in edits:
                table[start][end] = min(table[start][end], (cost + INSERT * inserts, "I" * inserts + letter))
            state = DUE[state]
    return table


STEPS = [_steps(code) for code in range(12)]
COSTS = [[[cell[0] for cell in row] for row in steps] for steps in STEPS]
#: Inserts that end a conversation, by its last state.
ENDING = ("", "II", "I", "")
END_COSTS = tuple(INSERT * len(x) for x in ENDING)


def forward(codes: bytes, costs: list[int]) -> list[int]:
    """Least costs of the states after the rows, from those before."""
    a, b, c, d = costs
    for code in codes:
        one, two, three, four = COSTS[code]
        a, b, c, d = (min(a + one[i], b + two[i], c + three[i], d + four[i]) for i in range(4))
    return [a, b, c, d]


def backward(codes: bytes, costs: list[int]) -> list[int]:
    """Least costs still to come before the rows, from those after."""
    a, b, c, d = costs
    for code in reversed(codes):
        a, b, c, d = (min(a + w, b + x, c + y, d + z) for w, x, y, z in COSTS[code])
    return [a, b, c, d]


def crossing_table(codes: bytes) -> list[int]:
    """The 4 x 4 least costs of a stretch of rows, row by row."""
    starts = ([0 if i == s else INFINITE for i in range(4)] for s in range(4))
    return [min(x, INFINITE) for start in starts for x in forward(codes, start)]


def least(codes: bytes, start: int, ends: tuple[int, ...]) -> tuple[str, int]:
    """The audit-least of the cheapest scripts, and its last state; ``ends`` are the costs after the rows."""
    return _remembered(codes, start, ends) if len(codes) <= SHORT else _least(codes, start, ends)


def _least(codes: bytes, start: int, ends: tuple[int, ...]) -> tuple[str, int]:
    if not codes:
        return "", start
    if len(codes) == 1:
        options = ((cost + ends[end], letters, end) for end, (cost, letters) in enumerate(STEPS[codes[0]][start]))
        _, letters, end = min(options)
        return letters, end
    middle = len(codes) // 2
    before = forward(codes[:middle], [0 if i == start else INFINITE for i in range(4)])
    after = backward(codes[middle:], list(ends))
    best = min(map(int.__add__, before, after))
    open_ = tuple(b if a + b == best else INFINITE for a, b in zip(before, after))
    left, state = least(codes[:middle], start, open_)
    right, end = least(codes[middle:], state, ends)
    return left + right, end


_remembered = lru_cache(maxsize=100_000)(_least)


def applied(audit: str, start: int, codes: bytes, roles: list[str], texts: list[str]) -> tuple[list[str], int]:
    """The repaired ``role:text`` lines of a script, and its cost."""
    lines, cost, state, row = [], 0, start, 0
    for letter in audit:
        if letter == "I":
            state, cost = DUE[state], cost + INSERT
            lines.append("user:" if state == USER else "assistant:")
            continue
        if letter == "D":
            cost += DELETE
        else:
            extra = TRUNCATED if codes[row] % 3 == CUT else 0
            if letter == "R":
                state, cost = DUE[state], cost + REROLE + extra
                lines.append(("user:" if state == USER else "assistant:") + texts[row])
            else:
                state, cost = codes[row] // 3 + 1, cost + extra
                lines.append(f"{roles[row]}:{texts[row]}")
        row += 1
    return lines, cost


def fault(text: str) -> int:
    """FINE, LOST (blank) or CUT (truncated) as the text alone says."""
    text = text.rstrip(SPACE)
    if not text:
        return LOST
    return FINE if text[-1] in ".!?" else CUT


def damaged(rows: DataFrame, modulus: int = 20) -> DataFrame:
    """``conv_id, turn, role, text, dropped, row``: the rows with faults planted by crc32 of ``conv_id:turn``."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % modulus).alias("draw"))
    draw = F.col("draw")
    rows = rows.select(
        "conv_id", "turn",
        F.when(draw == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(draw <= 1, "").when(draw == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (draw == 0).alias("dropped"),
        F.monotonically_increasing_id().alias("row"),
        F.array_repeat(F.lit(0), F.when(draw == 3, 2).otherwise(1)).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


COUNTED = ("blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
RESULTS = pa.schema([("gaps", pa.int64()), *((c, pa.int64()) for c in COUNTED), ("audit", pa.string()), ("repaired_sha256", pa.string())])
#: An open block: its place, its rows, and the digest of each row's role and text.
OPEN = "part int, seq int, turns array<long>, initials array<string>, roles array<string>, texts array<string>, faults binary, digests array<binary>"
OPENS = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int32()), ("turns", pa.list_(pa.int64())), ("initials", pa.list_(pa.string())),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.binary()), ("digests", pa.list_(pa.binary())),
    ]
)


class Block:
    """Rows of one conversation that lie together."""

    def __init__(self, conversation):
        self.conversation, self.chars = conversation, 0
        self.turns, self.roles, self.texts = [], [], []

    def add(self, turn, role, text):
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(role) + len(text)

    def full(self) -> bool:
        return len(self.texts) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def digests(self) -> list[bytes]:
        return [hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest() for r, t in zip(self.roles, self.texts)]


def coded(roles: list[str], faults: bytes, repeated: list[bool]) -> bytes:
    """Codes of rows from what their texts say and whether they were seen earlier."""
    place = {x: i for i, x in enumerate(INITIALS)}
    return bytes(3 * place.get(r[:1], 3) + (LOST if again else f) for r, f, again in zip(roles, faults, repeated))


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def whole(block: Block) -> tuple:
    """The result of a conversation that is one block."""
    faults = bytes(map(fault, block.texts))
    seen: set[tuple[str, str]] = set()
    repeated = []
    for pair in zip(block.roles, block.texts):
        repeated.append(pair in seen)
        seen.add(pair)
    codes = coded(block.roles, faults, repeated)
    audit, state = least(codes, NONE, END_COSTS)
    audit += ENDING[state]
    lines, cost = applied(audit, NONE, codes, block.roles, block.texts)
    blank = sum(f == LOST for f in faults)
    known = [t for t in block.turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (
        gaps, blank, sum(a and f != LOST for a, f in zip(repeated, faults)), sum(c % 3 == CUT for c in codes),
        illegal([r[:1] for r in block.roles]), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def _blocks(conversation_type: pa.DataType):
    """Sorted rows to results of conversations that end inside the task, and to blocks of those that may not."""
    schema = pa.schema([("conv_id", conversation_type), *RESULTS, *OPENS])

    def out(done: list[tuple], opened: list[tuple[Block, int]], part: int) -> pa.RecordBatch:
        n, m = len(done), len(opened)
        columns = [pa.array([x[0] for x in done] + [b.conversation for b, _ in opened], conversation_type)]
        for i, field in enumerate(RESULTS):
            columns.append(pa.array([x[1][i] for x in done] + [None] * m, field.type))
        each = [
            (part, seq, b.turns, [r[:1] for r in b.roles], b.roles, b.texts, bytes(map(fault, b.texts)), b.digests())
            for b, seq in opened
        ]
        for i, field in enumerate(OPENS):
            columns.append(pa.array([None] * n + [x[i] for x in each], field.type))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(rows) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        block, seq, first = None, 0, True
        done: list[tuple] = []
        for batch in rows:
            columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped")]
            for conversation, turn, role, text, dropped in zip(*columns, strict=True):
                if block is None:
                    block = Block(conversation)
                elif conversation != block.conversation:
                    if first or seq:
                        yield out([], [(block, seq)], part)
                    else:
                        done.append((block.conversation, whole(block)))
                    block, seq, first = Block(conversation), 0, False
                elif block.full():
                    yield out([], [(block, seq)], part)
                    block, seq = Block(conversation), seq + 1
                if not dropped:
                    block.add(turn, role, text)
            if done:
                yield out(done, [], part)
                done = []
        if block is not None:
            yield out([], [(block, seq)], part)

    return run


PLACE = ["conv_id", "part", "seq"]


def _joined(first: DataFrame, second: DataFrame, kind: str = "inner") -> DataFrame:
    """Two tables of open blocks by their place."""
    second = second.withColumnsRenamed({c: f"_{c}" for c in PLACE})
    condition = F.lit(True)
    for c in PLACE:
        condition &= first[c].eqNullSafe(second[f"_{c}"])
    return first.join(second, condition, kind).drop(*[f"_{c}" for c in PLACE])


def _in_order(blocks: DataFrame, backwards: bool = False) -> DataFrame:
    """The blocks of a conversation one after the other in one task: a few numbers each."""
    direction = F.desc if backwards else F.asc
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", direction("part"), direction("seq"))


def _seen_earlier(blocks: DataFrame) -> DataFrame:
    """Per open block the ``earlier`` digests of its rows that an earlier block of its conversation has."""
    each = blocks.select(*PLACE, F.explode(F.array_distinct("digests")).alias("digest"))
    place = F.struct("part", "seq")
    first = each.groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("_conv_id"), F.col("digest").alias("_digest"), "first")
    again = each.join(first, each["conv_id"].eqNullSafe(first["_conv_id"]) & (each["digest"] == first["_digest"]))
    again = again.where(F.col("first") < place)
    return again.groupBy(*PLACE).agg(F.collect_list("digest").alias("earlier"))


def _analysed(batches):
    """Codes, counts and cost tables of blocks."""
    for batch in batches:
        found = []
        columns = [batch[c].to_pylist() for c in ("turns", "initials", "faults", "digests", "earlier")]
        for turns, initials, faults, digests, earlier in zip(*columns, strict=True):
            seen, repeated = set(earlier or ()), []
            for x in digests:
                repeated.append(x in seen)
                seen.add(x)
            codes = coded(initials, faults, repeated)
            known = [t for t in turns if t is not None]
            found.append((
                codes, crossing_table(codes), sum(f == LOST for f in faults),
                sum(a and f != LOST for a, f in zip(repeated, faults)), sum(c % 3 == CUT for c in codes), illegal(initials),
                initials[0] if initials else None, initials[-1] if initials else None,
                known[0] if known else None, known[-1] if known else None, len(set(known)),
            ))
        types = [pa.binary(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]
        names = [x.split()[0] for x in ANALYSED.split(", ")]
        added = [pa.array([x[i] for x in found], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in PLACE), *added], names=[*PLACE, *names])


ANALYSED = (
    "codes binary, costs array<long>, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, first_turn long, last_turn long, distinct_turns long"
)


def _ends(batches):
    """From the last block to the first: the least costs that follow each block."""
    before, costs = object(), None
    for batch in batches:
        found = []
        for conversation, table in zip(batch["conv_id"].to_pylist(), batch["costs"].to_pylist(), strict=True):
            if conversation != before:
                before, costs = conversation, list(END_COSTS)
            found.append(costs)
            costs = [min(INFINITE, *(table[4 * s + e] + costs[e] for e in range(4))) for s in range(4)]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in PLACE), pa.array(found, pa.list_(pa.int64()))], names=[*PLACE, "ends"])


def _reached(batches):
    """The script of a block and the state it leads to, from each of the four states before it."""
    for batch in batches:
        found = [
            [least(codes, start, tuple(ends)) for start in range(4)]
            for codes, ends in zip(batch["codes"].to_pylist(), batch["ends"].to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch[c] for c in PLACE), pa.array([[x[0] for x in four] for four in found], pa.list_(pa.string())),
                pa.array([[x[1] for x in four] for four in found], pa.list_(pa.int32())),
            ],
            names=[*PLACE, "audits", "reached"],
        )


def _starts(batches):
    """From the first block to the last: the state before each block."""
    before, state = object(), NONE
    for batch in batches:
        found = []
        for conversation, reached in zip(batch["conv_id"].to_pylist(), batch["reached"].to_pylist(), strict=True):
            if conversation != before:
                before, state = conversation, NONE
            found.append(state)
            state = reached[state]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in PLACE), pa.array(found, pa.int32())], names=[*PLACE, "start"])


def _lines(batches):
    """The script, cost, end state and repaired lines of blocks."""
    for batch in batches:
        found = []
        columns = [batch[c].to_pylist() for c in ("audits", "reached", "start", "codes", "roles", "texts")]
        for audits, reached, start, codes, roles, texts in zip(*columns, strict=True):
            lines, cost = applied(audits[start], start, codes, roles, texts)
            found.append((audits[start], reached[start], cost, "\n".join(lines).encode(), len(lines)))
        types = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
        added = [pa.array([x[i] for x in found], t) for i, t in enumerate(types)]
        kept = [c for c in batch.schema.names if c in (*PLACE, *COUNTED, *EDGES)]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *added], names=[*kept, "audit", "state", "cost", "lines", "n_lines"])


EDGES = ("first_initial", "last_initial", "first_turn", "last_turn", "distinct_turns")


class Assembled:
    """A conversation put together block after block."""

    def __init__(self):
        self.counts = dict.fromkeys(COUNTED, 0)
        self.audits, self.sha, self.any, self.state = [], hashlib.sha256(), False, NONE
        self.initial = self.low = self.high = None
        self.turns = 0

    def _write(self, lines: bytes) -> None:
        self.sha.update(b"\n" + lines if self.any else lines)
        self.any = True

    def add(self, block: dict) -> None:
        for name in COUNTED:
            self.counts[name] += block[name]
        if block["first_initial"] is not None:
            if self.initial is not None:
                self.counts["illegal"] += illegal([self.initial, block["first_initial"]])
            self.initial = block["last_initial"]
        if block["first_turn"] is not None:
            self.turns += block["distinct_turns"] - (block["first_turn"] == self.high)
            self.low = block["first_turn"] if self.low is None else self.low
            self.high = block["last_turn"]
        self.audits.append(block["audit"])
        self.state = block["state"]
        if block["n_lines"]:
            self._write(block["lines"])

    def result(self) -> tuple:
        ending = ENDING[self.state]
        lines, cost = applied(ending, self.state, b"", [], [])
        if lines:
            self._write("\n".join(lines).encode())
        self.counts["cost"] += cost
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.counts.values(), "".join(self.audits) + ending, self.sha.hexdigest())


def _assembled(conversation_type: pa.DataType):
    schema = pa.schema([("conv_id", conversation_type), *RESULTS])

    def run(batches):
        before, made = None, None

        def out():
            cells = [before, *made.result()]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(cells, schema)], schema=schema)

        for batch in batches:
            for block in batch.to_pylist():
                if made is None or block["conv_id"] != before:
                    if made is not None:
                        yield out()
                    before, made = block["conv_id"], Assembled()
                made.add(block)
        if made is not None:
            yield out()

    return run


def _put_together(blocks: DataFrame, conversation_type: pa.DataType) -> DataFrame:
    """Results of the conversations of open blocks."""
    place = blocks.select(*PLACE)
    light = _joined(blocks.select(*PLACE, "turns", "initials", "faults", "digests"), _seen_earlier(blocks), "left")
    analysed = written(light.mapInArrow(_analysed, schema_with(place, ANALYSED)), "analysed")
    ends = _in_order(analysed.select(*PLACE, "costs"), backwards=True).mapInArrow(_ends, schema_with(place, "ends array<long>"))
    reached = _joined(analysed.select(*PLACE, "codes"), ends)
    reached = reached.mapInArrow(_reached, schema_with(place, "audits array<string>, reached array<int>"))
    reached = written(reached, "reached")
    starts = _in_order(reached.select(*PLACE, "reached")).mapInArrow(_starts, schema_with(place, "start int"))
    rows = _joined(_joined(_joined(blocks.select(*PLACE, "roles", "texts"), analysed.drop("costs")), reached), starts)
    kept = place.schema.names + [f.name for f in analysed.schema if f.name in (*COUNTED, *EDGES)]
    done = rows.mapInArrow(_lines, schema_with(rows.select(*kept), "audit string, state int, cost long, lines binary, n_lines long"))
    return _in_order(done).mapInArrow(_assembled(conversation_type), schema_with(blocks.select("conv_id"), RESULT))


def repaired(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (see :func:`damaged`): faults, the cheapest edits and the repaired text's digest."""
    conversation_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[dict(rows.dtypes)["conv_id"]]
    order = ["conv_id", "turn", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = schema_with(rows.select("conv_id"), f"{RESULT}, {OPEN}")
    found = rows.drop("row").mapInArrow(_blocks(conversation_type), schema)
    found = written(found, "conversations")
    done = found.where("part IS NULL").select("conv_id", *RESULTS.names)
    opened = found.where("part IS NOT NULL").drop(*RESULTS.names)
    return done.unionByName(_put_together(opened, conversation_type))
