"""Repair of conversation structure by Hirschberg's divide and conquer.

The roles of a repaired conversation are nothing, or an optional system turn and
then user and assistant in turns: four states (start, behind system, behind user,
behind assistant) and a row of edits. A row is kept, given the other role, or
deleted; missing turns are inserted. The cheapest edits are found in linear space:
the cost of reaching each state from the front and the cost of finishing from each
state meet in the middle, the best crossing is fixed, both halves are solved alike.

Of equally cheap edits the audit (their initials in order) that is least in ASCII
wins. A crossing lies right behind the edit of a row, so no audit up to it begins
another one, and audits to different states differ. Hence the front vector carries,
next to the cost of a state, the place of the state's least audit among the four:
of the crossings with the least total cost the one with the first place is right,
whatever follows.

A conversation may be of any length. All rows are sorted over all tasks and cut
into blocks of at most 2^BLOCK_BITS rows. A block is summed up by its costs from
each state to each state, with the places; the same divide and conquer over the
blocks of a conversation (one row per block) fixes the states at their borders,
then every block is solved by itself. Only the digest of the repaired text, which
is one running hash by its nature, passes a conversation row by row through one
task, and only the audit, one letter per edit, is one value per conversation.

Cases: ``damage`` and ``repair`` read a null role or text as one space, a null
conversation id is a conversation of its own, a null turn comes first. Rows of one
turn are ordered by role, then by the digest of role and text; repeated rows are
duplicates. Only the first letter of a role counts; a role that begins with none of
s, u, a is given another or deleted. An empty table gives an empty result. Further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import lookup_join, written

#: Fixed values of the contract: costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Fixed values of the contract: marks that end a text, white space.
ENDS, BLANK = "[.!?]", r"[\x20\x09-\x0D]"
#: Rows of a block are 2^BLOCK_BITS at most.
BLOCK_BITS = 14

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEVER = 1 << 60
#: The state behind a turn of this initial, by the state before; elsewhere it is not allowed.
_NEXT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: Role of an inserted or changed turn by the state before.
_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_BEHIND = {state: _NEXT[role[0]][state] for state, role in _ROLE.items()}
#: Inserts that end a conversation from each state.
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_FINISH = [INSERT * len(ENDING[state]) for state in STATES]
#: Kinds of rows: initial, then lower case if sound and upper case if truncated; "-" must be deleted.
KINDS = "-suaoSUAO"


class Step:
    """What a row, or a block of rows, does to the four states.

    ``cost[p][q]`` is the least cost from state p to state q, ``place[p][q]`` the
    place of its least audit among those from p.
    """

    __slots__ = ("cost", "place")

    def __init__(self, cost: list[list[int]], place: list[list[int]]):
        self.cost, self.place = cost, place


def _edits(kind: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state behind) -> cost and least audit of one row."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    truncated = TRUNCATED if kind.isupper() else 0
    for before in STATES:
        at = before
        for inserts in range(3):  # two inserts lead back to where one could be
            choices = [(DELETE, "D", at)]
            if kind != "-":
                choices.append((REROLE + truncated, "R", _BEHIND[at]))
                behind = _NEXT.get(kind.lower(), {}).get(at)
                if behind is not None:
                    choices.append((KEEP + truncated, "K", behind))
            for cost, initial, behind in choices:
                found = (cost + INSERT * inserts, "I" * inserts + initial)
                best[before, behind] = min(best.get((before, behind), found), found)
            at = _BEHIND[at]
    return best


EDITS = {kind: _edits(kind) for kind in KINDS}


def _row_step(kind: str) -> Step:
    edits = EDITS[kind]
    cost = [[edits.get((p, q), (NEVER, ""))[0] for q in STATES] for p in STATES]
    place = []
    for p in STATES:
        order = sorted(STATES, key=lambda q: edits[p, q][1] if (p, q) in edits else "~")  # noqa: B023
        place.append([order.index(q) for q in STATES])
    return Step(cost, place)


ROW_STEPS = {kind: _row_step(kind) for kind in KINDS}


def _forward(steps: Sequence[Step], entry: int) -> tuple[list[int], list[int]]:
    """Cost of each state behind ``steps``, and the place of its least audit."""
    cost = [NEVER] * 4
    place = [0] * 4
    cost[entry] = 0
    for step in steps:
        made = []
        for q in STATES:
            made.append(min((cost[p] + step.cost[p][q], place[p], step.place[p][q]) for p in STATES))
        order = sorted(STATES, key=lambda q: (made[q][0] >= NEVER, made[q][1:]))  # noqa: B023
        cost = [min(made[q][0], NEVER) for q in STATES]
        for rank, q in enumerate(order):
            place[q] = rank
    return cost, place


def _backward(steps: Sequence[Step], leave: list[int]) -> list[int]:
    """Cost to finish from each state before ``steps``, given the cost behind them."""
    for step in reversed(steps):
        leave = [min(c + more for c, more in zip(step.cost[p], leave, strict=True)) for p in STATES]
    return leave


def crossings(steps: Sequence[Step], entry: int, leave: list[int]) -> list[int]:
    """The state behind each step on the cheapest way, the least audit of those. Linear space."""
    if not steps:
        return []
    middle = len(steps) // 2
    if not middle:
        step = steps[0]
        return [min(STATES, key=lambda q: (step.cost[entry][q] + leave[q], step.place[entry][q]))]
    cost, place = _forward(steps[:middle], entry)
    rest = _backward(steps[middle:], leave)
    at = min(STATES, key=lambda q: (cost[q] + rest[q], place[q]))
    only = [0 if q == at else NEVER for q in STATES]
    return crossings(steps[:middle], entry, only) + crossings(steps[middle:], at, leave)


def summed(kinds: str) -> Step:
    """One step for all rows of a block."""
    ways = [_forward([ROW_STEPS[k] for k in kinds], p) for p in STATES]
    return Step([w[0] for w in ways], [w[1] for w in ways])


@lru_cache(maxsize=1 << 14)
def _short_audit(kinds: str, entry: int, leave: int) -> str:
    only = [0 if q == leave else NEVER for q in STATES]
    states = crossings([ROW_STEPS[k] for k in kinds], entry, only)
    return "".join(EDITS[k][p, q][1] for k, p, q in zip(kinds, [entry, *states], states, strict=False))


def audit(kinds: str, entry: int, leave: int) -> str:
    """Initials of the edits of a block between two states; those of short blocks are remembered."""
    return _short_audit(kinds, entry, leave) if len(kinds) <= 32 else _short_audit.__wrapped__(kinds, entry, leave)


def total_cost(kinds: str, edits: str) -> int:
    """The cost of an audit."""
    rows = (e for e in edits if e != "I")
    kept = sum({"K": KEEP, "R": REROLE}[e] + TRUNCATED * k.isupper() for k, e in zip(kinds, rows, strict=True) if e != "D")
    return kept + INSERT * edits.count("I") + DELETE * edits.count("D")


def damage(turns: DataFrame) -> DataFrame:
    """Break some rows in known ways, chosen by a checksum of conversation and turn.

    Columns conv_id, turn, role, text. One twentieth each: dropped, emptied, robbed
    of all ``.!?``, repeated, given the role user.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(20)).alias("_how"),
    ).filter("_how <> 0")
    how = F.col("_how")
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text"))
    times = F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("_times")
    )
    return rows.withColumn("_time", F.explode("_times")).select("conv_id", "turn", "role", "text")


def _ordered(turns: DataFrame) -> DataFrame:
    """The rows sorted over all tasks and written, with ``pos`` rising in that order.

    ``conv`` stands for the conversation id and is never null. ``key`` tells role and
    text; ``mark`` is the kind of the row unless it is a duplicate.
    """
    space = F.lit(" ")
    rows = turns.select(
        "conv_id",
        F.coalesce(F.col("conv_id").cast("string"), space).alias("conv"),
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    # the length keeps role and text apart
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    initial = F.substring("role", 1, 1)
    sound = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    last = F.right(F.regexp_replace("text", BLANK + r"+\z", ""), F.lit(1))
    mark = F.when(last == "", "-").when(last.rlike(ENDS), sound).otherwise(F.upper(sound))
    # the row's place in the input comes last: equal rows of one turn are dealt out, too
    rows = rows.select("*", key.alias("key"), initial.alias("initial"), mark.alias("mark"), F.monotonically_increasing_id().alias("_at"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key"), F.col("_at")]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(rows.drop("_at").withColumn("pos", F.monotonically_increasing_id()))


def _kinds(rows: DataFrame) -> DataFrame:
    """(conv, block, pos, initial, kind, fault) of every row, without the texts."""
    narrow = rows.select("conv", "key", "pos", "initial", "mark")
    # blank rows are blank whether seen before or not; counted before they are joined
    sound = narrow.filter("mark <> '-'")
    copies = sound.groupBy("conv", "key").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    copies = written(copies.filter("_n > 1").select("conv", "key", "_first"))
    seen = lookup_join(narrow, copies, ["conv", "key"], "left", stored=True).withColumn(
        "_again", (F.col("mark") != "-") & F.coalesce(F.col("pos") > F.col("_first"), F.lit(False))
    )
    fault = (
        F.when(F.col("mark") == "-", "blank").when(F.col("_again"), "duplicate").when(F.col("mark").rlike("[A-Z]"), "truncated")
    )
    return seen.select(
        "conv",
        F.shiftright("pos", BLOCK_BITS).alias("block"),
        "pos",
        "initial",
        F.when(F.col("_again"), "-").otherwise(F.col("mark")).alias("kind"),
        fault.alias("fault"),
    )


_STEP = "array<bigint>"


def _block_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the costs and places of each block; blocks of the same short kinds share them."""
    short = lru_cache(maxsize=1 << 14)(summed)
    for batch in batches:
        steps = []
        for kinds in batch.column("kinds").to_pylist():
            step = short(kinds) if len(kinds) <= 32 else summed(kinds)
            steps.append([v for table in (step.cost, step.place) for row in table for v in row])
        yield batch.append_column("step", pa.array(steps, pa.list_(pa.int64())))


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: the states before and behind each of its blocks."""
    schema = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("last", pa.bool_())])
    for batch in batches:
        made: list[tuple] = []
        for conv, blocks in zip(batch.column("conv").to_pylist(), batch.column("blocks").to_pylist(), strict=True):
            steps = [
                Step([b["step"][4 * p : 4 * p + 4] for p in STATES], [b["step"][16 + 4 * p : 20 + 4 * p] for p in STATES])
                for b in blocks
            ]
            states = crossings(steps, START, _FINISH)
            for place, (block, entry, leave) in enumerate(zip(blocks, [START, *states], states, strict=False)):
                made.append((conv, block["block"], entry, leave, place == len(blocks) - 1))
        columns = list(zip(*made, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _block_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("kinds", "entry", "leave", "last")
        edits, costs = [], []
        for kinds, entry, leave, last in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            found = audit(kinds, entry, leave)
            ending = ENDING[leave] if last else ""
            costs.append(total_cost(kinds, found) + INSERT * len(ending))
            edits.append(found + ending)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array(edits, pa.string()), pa.array(costs, pa.int64())],
            ["conv", "block", "edits", "cost"],
        )


class _Repairer:
    """Applies edits to rows that come one by one."""

    def __init__(self) -> None:
        self.state, self.queue, self.place = START, "", 0

    def expect(self, edits: str) -> list[tuple[str, str]]:
        """The edits of the next rows; returns turns inserted at the end of what came before."""
        left = list(self.finish())
        self.queue, self.place = edits, 0
        return left

    def _insert(self) -> Iterator[tuple[str, str]]:
        while self.queue[self.place : self.place + 1] == "I":
            self.place += 1
            role = _ROLE[self.state]
            self.state = _BEHIND[self.state]
            yield role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._insert()
        edit = self.queue[self.place]
        self.place += 1
        if edit == "R":
            role = _ROLE[self.state]
        if edit != "D":
            self.state = _NEXT[role[0]][self.state]
            yield role, text

    def finish(self) -> Iterator[tuple[str, str]]:
        yield from self._insert()


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[tuple[str, str]]]]:
    """Per conversation its id and its repaired turns, as the sorted rows go by."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in ("conv", "edits", "role", "text")), strict=True)

    def turns(found: Iterator[tuple]) -> Iterator[tuple[str, str]]:
        repairer = _Repairer()
        for _, edits, role, text in found:
            yield from repairer.row(role, text) if edits is None else repairer.expect(edits)
        yield from repairer.finish()

    for conv, found in groupby(rows(), key=lambda r: r[0]):
        yield conv, turns(found)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, digests = [], []
    for conv, turns in _streams(batches):
        running = hashlib.sha256()
        for place, (role, text) in enumerate(turns):
            running.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        ids.append(conv)
        digests.append(running.hexdigest())
        if len(ids) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(digests)], ["conv", "repaired_sha256"])
            ids, digests = [], []
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(digests, pa.string())], ["conv", "repaired_sha256"])


def _repaired_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    held: list[tuple] = []
    size = 0
    for conv, turns in _streams(batches):
        for place, (role, text) in enumerate(turns):
            held.append((conv, place, role, text))
            size += len(text) + 32
            if size > 8_000_000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
                held, size = [], 0
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


class Repair:
    """The repair of all conversations of ``turns`` (conv_id, turn, role, text)."""

    def __init__(self, turns: DataFrame):
        self.rows = _ordered(turns)
        self.kinds = written(_kinds(self.rows))
        in_order = F.array_sort(F.collect_list(F.struct("pos", "kind", "initial")))  # 2^BLOCK_BITS rows at most
        blocks = self.kinds.groupBy("conv", "block").agg(in_order.alias("r"))
        initials = F.transform("r", lambda x: x["initial"])
        legal = ("su", "ua", "au")
        broken = lambda a, b: F.when(F.concat(a, b).isin(*legal), 0).otherwise(1)
        inside = F.zip_with(
            F.slice(initials, 1, F.size("r") - 1), F.slice(initials, 2, F.size("r") - 1), lambda a, b: broken(a, b)
        )
        blocks = blocks.select(
            "conv",
            "block",
            F.array_join(F.transform("r", lambda x: x["kind"]), "").alias("kinds"),
            F.when(F.size("r") > 1, F.aggregate(inside, F.lit(0), lambda s, x: s + x)).otherwise(0).cast("bigint").alias("broken"),
            F.get(initials, F.lit(0)).alias("first"),
            F.get(initials, F.size("r") - 1).alias("last_initial"),
        )
        schema = f"conv string, block bigint, kinds string, broken bigint, first string, last_initial string, step {_STEP}"
        self.blocks = written(blocks.mapInArrow(_block_steps, schema))
        # one entry per block of a conversation
        listed = self.blocks.groupBy("conv").agg(
            F.array_sort(F.collect_list(F.struct("block", "step", "broken", "first", "last_initial"))).alias("blocks")
        )
        between = F.zip_with(
            F.slice("blocks", 1, F.size("blocks") - 1),
            F.slice("blocks", 2, F.size("blocks") - 1),
            lambda a, b: broken(a["last_initial"], b["first"]),
        )
        across = F.when(F.size("blocks") > 1, F.aggregate(between, F.lit(0), lambda s, x: s + x)).otherwise(0)
        inner = F.aggregate("blocks", F.lit(0).cast("bigint"), lambda s, b: s + b["broken"])
        self.illegal = listed.select("conv", (inner + across).cast("bigint").alias("illegal"))
        borders = listed.select("conv", F.transform("blocks", lambda b: F.struct(b["block"], b["step"])).alias("blocks"))
        borders = borders.mapInArrow(_borders, "conv string, block bigint, entry int, leave int, last boolean")
        solved = self.blocks.select("conv", "block", "kinds").join(borders, ["conv", "block"])
        self.audits = written(solved.mapInArrow(_block_audits, "conv string, block bigint, edits string, cost bigint"))

    def _stream(self) -> DataFrame:
        """The edits of each block before its rows, conversation by conversation, in order."""
        none = F.lit(None).cast("string")
        edits = self.audits.select(
            "conv", F.shiftleft("block", BLOCK_BITS).alias("pos"), F.lit(0).alias("kind"), "edits", none.alias("role"), none.alias("text")
        )
        rows = self.rows.select("conv", "pos", F.lit(1).alias("kind"), none.alias("edits"), "role", "text")
        # a block number may be shared by the end of one conversation and the start of the next: conv comes first
        rows = edits.unionByName(rows).withColumn("block", F.shiftright("pos", BLOCK_BITS))
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(parts, "conv").sortWithinPartitions("conv", "block", "kind", "pos").select("conv", "edits", "role", "text")

    def turns(self) -> DataFrame:
        """(conv_id, turn, role, text): the repaired conversations, turns numbered from 0."""
        ids = self.rows.groupBy("conv").agg(F.first("conv_id", ignorenulls=True).alias("conv_id"))
        made = self._stream().mapInArrow(_repaired_turns, "conv string, turn bigint, role string, text string")
        return made.join(ids, "conv").select("conv_id", "turn", "role", "text")

    def report(self, original: DataFrame) -> DataFrame:
        """One row for each conversation id of ``original``, also of those without rows now."""
        space = F.lit(" ")
        every = original.select("conv_id").distinct().select("conv_id", F.coalesce(F.col("conv_id").cast("string"), space).alias("conv"))
        gaps = self.rows.groupBy("conv").agg(
            (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("bigint").alias("gaps")
        )
        count = lambda name: F.sum(F.when(F.col("fault") == name, 1).otherwise(0)).cast("bigint").alias(name)
        faults = self.kinds.groupBy("conv").agg(*[count(n) for n in ("blank", "duplicate", "truncated")])
        in_order = F.array_sort(F.collect_list(F.struct("block", "edits")))
        edits = self.audits.groupBy("conv").agg(
            F.sum("cost").alias("cost"), F.array_join(F.transform(in_order, lambda b: b["edits"]), "").alias("audit")
        )
        digests = self._stream().mapInArrow(_digests, "conv string, repaired_sha256 string")
        found = every
        for part in (gaps, faults, self.illegal, edits, digests):
            found = found.join(part, "conv", "left")
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        return found.select(
            "conv_id",
            *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the repaired conversations."""
    return Repair(turns).turns()


def report(turns: DataFrame, original: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``original`` (conv_id) names conversations that count even without rows.
    """
    return Repair(turns).report(turns if original is None else original)
