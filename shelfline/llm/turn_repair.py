"""Conversation structure repair: a generalised LR parser with weighted edits over the role grammar.

    conversation -> turns | nothing      turns -> turns u a | head u a      head -> s | nothing

u, a and s are the first letters of a role. Every row is kept (0), reroled to user or assistant (2) or
deleted (3); empty user or assistant turns may be inserted anywhere (2). Blank rows and repeats of an
earlier role and text must be deleted; a kept or reroled row that breaks off costs 1 more. The parser
holds all stacks at once in one graph, equal stack tops are merged by the smaller (cost, audit), where
the audit is the initials of the edits (K, R, D, I), and the cheapest accepted stack wins, ties by audit.

Rows of a conversation are taken by turn (nulls first), then role and text. A null role or text is one
space, a null conv_id is a conversation of its own; repeated rows follow each other and only the first
may stay. A conversation without rows has no repaired rows; an empty table gives an empty result. Extra
columns are ignored. One task reads a conversation as a sorted stream: it holds the live stacks and the
rows whose edit is still open, which are given out as soon as all live stacks agree. Stacks that cost
more than BOUND above the cheapest can never win and go. So one very long conversation needs no more
memory than a short one, but its rows pass through one task, since its digest is one chain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.texts import fresh_name, table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
BROKEN_OFF = 1
END = "end"  # never a token: tokens have one letter at most
ROLES = {"u": "user", "a": "assistant"}

# The parse table of the grammar above. Shifts by state and token; reductions by state and
# lookahead as (symbols popped, symbol pushed); states after a pushed symbol.
SHIFT = {(0, "s"): 1, (2, "u"): 3, (3, "a"): 4, (5, "u"): 6, (6, "a"): 7}
REDUCE = {(0, "u"): (0, "head"), (1, "u"): (1, "head"), (4, "u"): (3, "turns"), (4, END): (3, "turns"), (7, "u"): (3, "turns"), (7, END): (3, "turns")}
GOTO = {(0, "head"): 2, (0, "turns"): 5}
ACCEPT = {0, 5}

# Any stack reaches what another can still accept by two inserts or by deleting one row more.
BOUND = 6
# Rows after which settled edits are given out.
SETTLE = 64

EDITS = "conv_id {id}, turn {turn}, role string, text string, fault string, edit string, new_role string, cost bigint"
BLANK = " \t\n\x0b\x0c\r"


class Step:
    """One edit of a stack's history."""

    __slots__ = ("edit", "row", "role", "cost", "before")

    def __init__(self, edit: str, row: tuple | None, role: str | None, cost: int, before: Step | None):
        self.edit, self.row, self.role, self.cost, self.before = edit, row, role, cost, before


def since(one: Step | None, other: Step | None) -> tuple[str, str]:
    """Audits of two histories from where they part."""
    seen, step = {}, one
    while step is not None:
        seen[id(step)] = step
        step = step.before
    right = []
    while other is not None and id(other) not in seen:
        right.append(other.edit)
        other = other.before
    left, step = [], one
    while step is not other:
        left.append(step.edit)
        step = step.before
    return "".join(reversed(left)), "".join(reversed(right))


def cheaper(one: tuple[int, Step | None], other: tuple[int, Step | None]) -> bool:
    if one[0] != other[0] or one[1] is other[1]:
        return one[0] < other[0]
    left, right = since(one[1], other[1])
    return left < right


class Stacks:
    """Graph of all live stacks: state -> (cost, history); below a state is the state it was shifted on."""

    def __init__(self) -> None:
        self.below: dict[int, int] = {}  # the grammar puts each state on one other state only
        self.tops: dict[int, tuple[int, Step | None]] = {0: (0, None)}

    def add(self, tops: dict, state: int, cost: int, history: Step | None) -> bool:
        if state in tops and not cheaper((cost, history), tops[state]):
            return False
        tops[state] = (cost, history)
        return True

    def after(self, state: int, token: str) -> int | None:
        """The state after all reductions that `token` asks for and its shift; the end stays unshifted."""
        while (state, token) not in SHIFT:
            if token == END and state in ACCEPT:
                return state
            if (state, token) not in REDUCE:
                return None
            popped, symbol = REDUCE[state, token]
            for _ in range(popped):
                state = self.below[state]
            above = GOTO[state, symbol]
            self.below[above] = state
            state = above
        above = SHIFT[state, token]
        self.below[above] = state
        return above

    def insert(self) -> None:
        """Adds the stacks reached by inserted turns; each costs something, so this ends."""
        queue = list(self.tops)
        while queue:
            state = queue.pop()
            cost, history = self.tops[state]
            for token, role in ROLES.items():
                above = self.after(state, token)
                step = Step(INSERT, None, role, COST[INSERT], history)
                if above is not None and self.add(self.tops, above, cost + COST[INSERT], step):
                    queue.append(above)

    def row(self, row: tuple, role: str, fault: str) -> None:
        self.insert()
        tops: dict[int, tuple[int, Step | None]] = {}
        extra = BROKEN_OFF if fault == "truncated" else 0
        for state, (cost, history) in self.tops.items():
            self.add(tops, state, cost + COST[DELETE], Step(DELETE, row, None, COST[DELETE], history))
            if fault in ("blank", "duplicate"):
                continue
            choices = [(KEEP, role[:1], role)] + [(REROLE, token, new) for token, new in ROLES.items()]
            for edit, token, new in choices:
                above = self.after(state, token)
                if above is not None:
                    self.add(tops, above, cost + COST[edit] + extra, Step(edit, row, new, COST[edit] + extra, history))
        least = min(cost for cost, _ in tops.values())
        self.tops = {state: top for state, top in tops.items() if top[0] <= least + BOUND}

    def settled(self) -> list[Step]:
        """Takes off the edits that all live stacks share."""
        lines = []
        for _, step in self.tops.values():
            line = []
            while step is not None:
                line.append(step)
                step = step.before
            lines.append(line[::-1])
        same = 0
        while all(len(line) > same for line in lines) and len({id(line[same]) for line in lines}) == 1:
            same += 1
        for line in lines:
            if len(line) > same:
                line[same].before = None
        if same:
            self.tops = {state: (cost, None if len(line) == same else step) for (state, (cost, step)), line in zip(self.tops.items(), lines)}
        return lines[0][:same]

    def finish(self) -> list[Step]:
        """The rest of the best accepted history."""
        self.insert()
        best = None
        for state, top in self.tops.items():
            if self.after(state, END) is not None and (best is None or cheaper(top, best)):
                best = top
        steps, step = [], best[1]
        while step is not None:
            steps.append(step)
            step = step.before
        return steps[::-1]


def fault_of(text: str, repeated: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated or none."""
    last = text.rstrip(BLANK)[-1:]
    if not last:
        return "blank"
    if repeated:
        return "duplicate"
    return "" if last in ".!?" else "truncated"


def parse(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted rows (conv_id, turn, role, text, later) to repaired rows in order, as in EDITS."""
    stacks = conv = before = None
    taken = 0

    def given(steps):
        for s in steps:
            turn, role, text, fault = s.row or (None, None, None, None)
            yield conv[0], turn, role, text, fault, s.edit, s.role, s.cost

    for conv_id, turn, role, text, later in rows:
        if conv != (conv_id,):
            if stacks is not None:
                yield from given(stacks.finish())
            stacks, conv, before, taken = Stacks(), (conv_id,), None, 0
        fault = fault_of(text, later or before == (turn, role, text))
        before = (turn, role, text)
        stacks.row((turn, role, text, fault), role, fault)
        taken += 1
        if taken % SETTLE == 0:
            yield from given(stacks.settled())
    if stacks is not None:
        yield from given(stacks.finish())


def _batches(rows: Iterator[tuple], types: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str)) + 64
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _read(batches, names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def repair(conversations: DataFrame) -> DataFrame:
    """One row per row or inserted turn, in order within each conversation and each in one partition.

    conv_id, turn, role and text as read (null for inserted turns), fault (blank, duplicate, truncated or
    empty), edit (K, R, D, I), new_role (null where deleted) and the edit's cost. Texts are moved once,
    by conversation, and once more where the list of repeats is too long to broadcast; repeats are found
    by digests that are counted before they move."""
    c = conversations
    rows = c.select(c["conv_id"], c["turn"], *[F.coalesce(c[n].cast("string"), F.lit(" ")).alias(n) for n in ("role", "text")])
    kinds = dict(rows.dtypes)
    marked = rows.withColumn("mark", F.sha2("text", 256))
    again = marked.groupBy("conv_id", "role", "mark").agg(F.min("turn").alias("first"), F.count("turn").alias("known"), F.count("*").alias("n")).where("n > 1")
    again = again.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("mark").alias("_mark"), F.when(F.col("known") == F.col("n"), F.col("first")).alias("first"), "n")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("mark") == F.col("_mark"))
    later = F.col("n").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    read = marked.join(again, same, "left").select("conv_id", "turn", "role", "text", later.alias("later"))
    names = ["conv_id", "turn", "role", "text", "later"]
    out = EDITS.format(id=kinds["conv_id"], turn=kinds["turn"])

    def work(batches):
        first = next(batches, None)
        if first is None:
            return
        id_type, turn_type = first.schema.field("conv_id").type, first.schema.field("turn").type
        types = [id_type, turn_type, pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]

        def all_batches():
            yield first
            yield from batches

        yield from _batches(parse(_read(all_batches(), names)), types, [p.split()[0] for p in out.split(", ")])

    return read.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text").mapInArrow(work, out)


SUMMARY = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()


class Figures:
    """What op11 reports of one conversation, from its repaired rows in order."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.cost, self.illegal = conv_id, [], 0, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.initial = None
        self.turns, self.digest, self.started = 0, hashlib.sha256(), False

    def add(self, turn, role, text, fault, edit, new_role, cost):
        self.audit.append(edit)
        self.cost += cost
        if edit != INSERT:
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.turns += turn != self.high
                self.high = turn
            if fault:
                self.faults[fault] += 1
            if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = role[:1]
        if edit != DELETE:
            self.digest.update(("\n" * self.started + f"{new_role}:{text or ''}").encode("utf-8", "surrogatepass"))
            self.started = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def summaries(repaired: DataFrame) -> DataFrame:
    """SUMMARY of every conversation of repair()'s result, read in its own order without moving it."""

    def figures(rows):
        held = None
        for conv_id, *rest in rows:
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    yield held.row()
                held = Figures(conv_id)
            held.add(*rest)
        if held is not None:
            yield held.row()

    def work(batches):
        names = ["conv_id", "turn", "role", "text", "fault", "edit", "new_role", "cost"]
        types = [pa.int64()] * 7 + [pa.string()] * 2
        yield from _batches(figures(_read(batches, names)), types, [p.split()[0] for p in SUMMARY.split(", ")])

    return repaired.mapInArrow(work, SUMMARY)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(`conv_id:turn`) % 20 names (nulls: one space)."""
    c = conversations
    spaced = lambda name: F.coalesce(c[name].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    copy = fresh_name(c, "_copy")
    rows = c.select(c["conv_id"].cast("bigint").alias("conv_id"), c["turn"].cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias(copy))
    return rows.select("conv_id", "turn", "role", "text")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after damage."""
    conversations = table(spark, sf_dir, "conversations")
    return every_conversation(conversations, summaries(repair(damaged(conversations))))


def every_conversation(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """`found` with zeros, an empty audit and the empty digest for conversations that have lost all rows."""
    ids = conversations.select(conversations["conv_id"].cast("bigint").alias("_id")).distinct()
    rows = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    filled = {n: F.coalesce(F.col(n), F.lit(0).cast("bigint")) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    filled |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(NOTHING))}
    return rows.select(F.col("_id").alias("conv_id"), *[column.alias(n) for n, column in filled.items()])


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(state: str, letter: str, cost: str, text: str | None = None) -> str:
    added = f"{state}.t" if text is None else f"{state}.t || CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {text}"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {added}}}"


def _when(condition: str, option: str) -> str:
    return f"CASE WHEN {condition} THEN {option} ELSE {_NEVER} END"


_NEVER = "{'c': CAST(1000000000000 AS BIGINT), 'a': '', 't': ''}"
_INSERTED = f"""
    SELECT * REPLACE ({_least("a", _edit("u", "I", "2", "'assistant:'"))} AS a) FROM (
        SELECT * REPLACE ({_least("u", *[_edit(x, "I", "2", "'user:'") for x in "esa"])} AS u) FROM STACKS
    )"""
_NEED_USER = _least("e", "s", "a")

# A plain table of the four ends a role sequence can have: nothing, s, ...u and ...a.
OP11_SQL = f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
            lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
    FROM conversations
), kinds AS (
    SELECT *, xor(crc, 4294967295) % 20 AS kind FROM keyed
), copies AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds
), placed AS (
    SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM copies
), judged AS (
    SELECT *, left(role, 1) AS r, coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
             WHEN place > min(place) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
             WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM judged GROUP BY conv_id
), walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS place, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS e, {_NEVER} AS s, {_NEVER} AS u, {_NEVER} AS a FROM counted
    UNION ALL
    SELECT conv_id, place,
        {_edit("e", "D", "3")} AS e,
        {_least(_edit("s", "D", "3"), _when("may AND r = 's'", _edit("e", "K", "more", "role || ':' || text")))} AS s,
        {_least(_edit("u", "D", "3"), _when("may AND r = 'u'", _edit("o", "K", "more", "role || ':' || text")), _when("may", _edit("o", "R", "2 + more", "'user:' || text")))} AS u,
        {_least(_edit("a", "D", "3"), _when("may AND r = 'a'", _edit("u", "K", "more", "role || ':' || text")), _when("may", _edit("u", "R", "2 + more", "'assistant:' || text")))} AS a
    FROM (
        SELECT w.conv_id, j.place, e, s, u, a, r, role, text, fault NOT IN ('blank', 'duplicate') AS may, CAST(fault = 'truncated' AS BIGINT) AS more, {_NEED_USER} AS o
        FROM ({_INSERTED.replace("STACKS", "walk")}) w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
    )
), ends AS (
    SELECT conv_id, {_least("e", "a")} AS best FROM ({_INSERTED.replace("STACKS", "(SELECT w.* FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place)")})
), ids AS (
    SELECT DISTINCT conv_id FROM conversations
)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM ids i LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN ends d ON d.conv_id IS NOT DISTINCT FROM i.conv_id
"""
