"""Repair of the structure of conversations by the cheapest edits.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. The cost that is
left from each state of that pattern is a vector of four numbers. Rows lie in
segments, in the order of the table. A segment's costs between states are one
small matrix, so vectors at the borders of segments follow without its rows; they
are the checkpoints. Inside a segment, vectors are stored at every square root
of its length only and computed again, block by block, while walking forward.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollwright.llm.common import columns, cut

#: States: nothing yet, after system, after user, after assistant. The role that follows each.
FOLLOWING = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: What is left to pay at the end of a conversation, by inserts only.
END = (0, 4, 2, 0)
NEVER = 1 << 20
INSERT, REROLE, DELETE = 2, 2, 3
#: A row as a number: which initial (s, u, a, another), whether it must go, whether it is truncated.
INITIALS = "sua"
OTHER, MUST_GO, TRUNCATED = 3, 4, 8
LEGAL = ("su", "ua", "au")
#: Rows of a segment: two to this power.
SEGMENT_BITS = 12
#: Characters of role and text that order rows of one turn, before a hash of the whole.
HEAD = 64

Vector = tuple[int, int, int, int]


@cache
def moves(code: int, after: Vector) -> tuple[Vector, int, tuple[tuple[str, int], ...]]:
    """The vector before a row, less its minimum; that minimum; edits and next state from each state.

    Vectors less their minimum take few values, so each kind of row meets few of them.
    """
    fixed = []
    for state in range(4):
        ways = {"D": (DELETE + after[state], state)}
        if not code & MUST_GO:
            more = 1 if code & TRUNCATED else 0
            kind, to = code & OTHER, FOLLOWING[state]
            if (kind == 0 and state == 0) or (kind in (1, 2) and to == kind + 1):
                ways["K"] = (more + after[kind + 1], kind + 1)
            ways["R"] = (REROLE + more + after[to], to)
        fixed.append(ways)
    bare = [min(cost for cost, _ in ways.values()) for ways in fixed]
    best = [0, 0, min(bare[2], INSERT + bare[3]), min(bare[3], INSERT + bare[2])]
    best[0], best[1] = (min(bare[s], INSERT + best[2]) for s in (0, 1))
    found = []
    for state in range(4):
        edits, done = "", False
        while not done:
            for letter in "DIKR":
                if letter == "I" and INSERT + best[FOLLOWING[state]] == best[state]:
                    edits, state = edits + "I", FOLLOWING[state]
                    break
                if letter in fixed[state] and fixed[state][letter][0] == best[state]:
                    edits, state, done = edits + letter, fixed[state][letter][1], True
                    break
        found.append((edits, state))
    least = min(best)
    return tuple(min(b - least, NEVER) for b in best), least, tuple(found)


def backward(codes: bytes, after: Vector) -> tuple[Vector, int]:
    """The vector before all rows, less its minimum, and that minimum."""
    total = 0
    for code in reversed(codes):
        after, least, _ = moves(code, after)
        total += least
    return after, total


def matrix(codes: bytes) -> list[int]:
    """Costs from each state before the rows to each one after them, row by row."""
    found = [[0] * 4 for _ in range(4)]
    for to in range(4):
        vector, total = backward(codes, tuple(0 if s == to else NEVER for s in range(4)))
        for state in range(4):
            found[state][to] = min(NEVER, vector[state] + total) if vector[state] < NEVER else NEVER
    return [cost for row in found for cost in row]


def before_segment(costs: list[int], after: Vector) -> tuple[Vector, int]:
    best = [min(costs[4 * s + t] + after[t] for t in range(4)) for s in range(4)]
    least = min(best)
    return tuple(min(b - least, NEVER) for b in best), least


def walk(codes: bytes, extra: list[int], after: Vector) -> tuple[list[str], list[int]]:
    """The cheapest, then ASCII-least edits from each of the four states, and the states they end in.

    ``extra`` says how many copies of a row follow it; they are all deleted.
    """
    step = max(1, isqrt(len(codes)))
    stored = {}
    vector = after
    for place in range(len(codes), 0, -1):
        if place % step == 0 or place == len(codes):
            stored[place] = vector
        vector = moves(codes[place - 1], vector)[0]
    parts: list[list[str]] = [[] for _ in range(4)]
    states = list(range(4))
    for begin in range(0, len(codes), step):
        end = min(begin + step, len(codes))
        block = [stored[end]]
        for place in range(end - 1, begin, -1):
            block.append(moves(codes[place], block[-1])[0])
        for place in range(begin, end):
            edits = moves(codes[place], block[end - 1 - place])[2]
            copies = "D" * extra[place]
            for i, state in enumerate(states):
                letters, states[i] = edits[state]
                parts[i].append(letters + copies)
    return ["".join(p) for p in parts], states


# --- tables ------------------------------------------------------------------


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Faults by a hash of conversation and turn: a row dropped, emptied, without stops, twice or with role user.

    Null ids, turns, roles and texts count as one space; turns stay null.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named(conv_col), F.lit(":"), named(turn_col)).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), "role", "text", kind.alias("_kind"))
        .filter("_kind <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
            F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text).alias("text"),
            F.explode(times).alias("_copy"),
        )
        .drop("_copy")
    )


ORDER = ("turn", "role_head", "text_head", "mark")


def keyed(df: DataFrame) -> DataFrame:
    """Rows with what orders them in their conversation; equal rows have one mark."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    named = df.select("conv", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return named.select(
        "conv", "turn", F.left("role", F.lit(HEAD)).alias("role_head"), F.left("text", F.lit(HEAD)).alias("text_head"),
        F.sha2(whole.cast("binary"), 256).alias("mark"), "role", "text",
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Distinct narrow rows with their number and ``at``, which rises in the order of the table.

    Equal rows are counted before they are moved, so no key is too large for a sort by ranges.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    narrow = rows.select("conv", *ORDER, F.left("role", F.lit(1)).alias("initial"), blank.alias("blank"), ended.alias("ended"))
    counted = narrow.groupBy("conv", *ORDER).agg(
        F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("ended").alias("ended"),
        F.count("*").alias("rows"),
    )
    dealt = counted.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
    return cut(dealt.withColumn("at", F.monotonically_increasing_id()))


def with_repeats(ordered: DataFrame) -> DataFrame:
    """``seen``: an earlier row of the conversation has the same role and text."""
    firsts = (
        ordered.filter("not blank").groupBy("conv", "mark")
        .agg(F.min("at").alias("first_at"), F.count("*").alias("turns")).filter("turns > 1")
        .select(F.col("conv").alias("_conv"), F.col("mark").alias("_mark"), "first_at")
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("mark") == F.col("_mark"))
    seen = F.coalesce(F.col("at") > F.col("first_at"), F.lit(False))
    return ordered.join(firsts, same, "left").select(*ordered.columns, seen.alias("seen"))


@dataclass
class Segment:
    """What the rows of a segment add up to."""

    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    first_initial: str = ""
    last_initial: str = ""
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    codes: bytearray = field(default_factory=bytearray)
    extra: list[int] = field(default_factory=list)

    def add(self, turn: int | None, initial: str, blank: bool, ended: bool, seen: bool, rows: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        if self.codes:
            self.illegal += self.last_initial + initial not in LEGAL
        else:
            self.first_initial = initial
        self.illegal += rows - 1 if initial + initial not in LEGAL else 0
        self.last_initial = initial
        if blank:
            self.blank += rows
        else:
            self.duplicate += rows if seen else rows - 1
            self.truncated += not seen and not ended
        at = INITIALS.find(initial) if initial else -1
        code = at if at >= 0 else OTHER
        self.codes.append(code | (MUST_GO if blank or seen else 0) | (0 if ended else TRUNCATED))
        self.extra.append(rows - 1)

    def append(self, other: Segment) -> None:
        """Take the figures of the segment that follows."""
        joined = self.last_turn is not None and self.last_turn == other.first_turn
        self.turns += other.turns - joined
        self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if other.last_turn is None else other.last_turn
        self.illegal += other.illegal + (self.last_initial + other.first_initial not in LEGAL)
        self.last_initial = other.last_initial
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


FIGURES = (
    "first_turn long, last_turn long, turns long, first_initial string, last_initial string, "
    "blank long, duplicate long, truncated long, illegal long"
)
NAMES = [f.split()[0] for f in FIGURES.split(", ")]
KEY = "turn long, role_head string, text_head string, mark string"


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def arrow_schema(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    """``conv`` of the type it has in the table, and the given columns; as DDL and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema

    full = f"conv {df.schema['conv'].dataType.simpleString()}, {ddl}"
    return full, to_arrow_schema(df.sparkSession.createDataFrame([], full).schema)


def segments(flagged: DataFrame) -> DataFrame:
    """A row for each segment: key of its first row, figures, codes, matrix."""
    ddl, schema = arrow_schema(flagged, f"segment long, {KEY}, {FIGURES}, codes binary, extra array<long>, matrix array<int>")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        name, key, held = None, None, None
        for conv, at, turn, role_head, text_head, mark, initial, blank, ended, seen, rows in rows_of(batches):
            if held is None or name != (conv, at >> SEGMENT_BITS):
                if held is not None:
                    yield (*name, *key, *(getattr(held, n) for n in NAMES), bytes(held.codes), held.extra, matrix(held.codes))
                name, key, held = (conv, at >> SEGMENT_BITS), (turn, role_head, text_head, mark), Segment()
            held.add(turn, initial, blank, ended, seen, rows)
        if held is not None:
            yield (*name, *key, *(getattr(held, n) for n in NAMES), bytes(held.codes), held.extra, matrix(held.codes))

    dealt = flagged.repartition("conv", F.shiftright("at", SEGMENT_BITS)).sortWithinPartitions("conv", "at")
    wanted = dealt.select("conv", "at", *ORDER, "initial", "blank", "ended", "seen", "rows")
    return wanted.mapInArrow(lambda batches: batched(gather(batches), schema), ddl)


def with_checkpoints(parts: DataFrame) -> DataFrame:
    """Adds the vector after each segment and the cost of all from the first state before it on."""
    ddl, schema = arrow_schema(parts, f"segment long, {KEY}, {FIGURES}, codes binary, extra array<long>, after array<int>, cost long")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known, after, total = None, END, 0
        for row in rows_of(batches):
            conv, costs, extra = row[0], row[-1], row[-2]
            if known is None or known[0] != conv:
                known, after, total = (conv,), END, 0
            vector, least = before_segment(costs, after)
            total += least + DELETE * sum(extra)
            yield (*row[:-1], list(after), total + vector[0])
            after = vector

    dealt = parts.repartition("conv").sortWithinPartitions("conv", F.desc("segment"))
    return dealt.mapInArrow(lambda batches: batched(follow(batches), schema), ddl)


def with_edits(parts: DataFrame) -> DataFrame:
    """Adds the edits of each segment from each state, and where they end; segments are dealt out anew."""
    ddl, schema = arrow_schema(parts, f"segment long, {KEY}, {FIGURES}, cost long, edits array<string>, ends array<int>")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for row in rows_of(batches):
            codes, extra, after, cost = row[-4:]
            yield (*row[:-4], cost, *walk(codes, extra, tuple(after)))

    return parts.repartition("conv", "segment").mapInArrow(lambda batches: batched(edit(batches), schema), ddl)


@dataclass
class Conversation:
    """A conversation while its rows pass in order."""

    conv: object
    figures: Segment | None = None
    cost: int = 0
    state: int = 0
    emitted: int = 0
    audit: list[str] = field(default_factory=list)
    ahead: deque[tuple[str, int]] = field(default_factory=deque)
    place: int = 0

    def meet(self, segment: dict) -> None:
        """The edits of the next segment, from the state that the ones before it end in."""
        figures = Segment(**{n: segment[n] for n in NAMES})
        if self.figures is None:
            self.figures, self.cost = figures, segment["cost"]
        else:
            self.figures.append(figures)
        edits = segment["edits"][self.state]
        self.audit.append(edits)
        self.ahead.append((edits, self.state))
        self.state = segment["ends"][self.state]

    def at(self) -> tuple[str, int]:
        while self.place == len(self.ahead[0][0]):
            self.ahead.popleft()
            self.place = 0
        return self.ahead[0]

    def pass_row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What stands for the row in the repaired conversation, with what is inserted before it."""
        while True:
            edits, state = self.at()
            letter, self.place = edits[self.place], self.place + 1
            to = state if letter == "D" else FOLLOWING[state]
            if letter == "K":
                to = INITIALS.index(role[0]) + 1
                yield role, text
            elif letter == "R":
                yield ROLES[to], text
            elif letter == "I":
                yield ROLES[to], ""
            self.ahead[0] = (edits, to)
            if letter != "I":
                return

    def close(self) -> Iterator[tuple[str, str]]:
        while self.state not in (0, 3):
            self.state = FOLLOWING[self.state]
            self.audit.append("I")
            yield ROLES[self.state], ""


def passes(rows: DataFrame, every: DataFrame, ddl: str, emit: type) -> DataFrame:
    """All rows, after their conversation and before the rows of each segment its edits, through ``emit``."""
    parts = with_edits(with_checkpoints(segments(with_repeats(in_order(rows)))))
    inside = F.struct(*(c for c in parts.columns if c not in ("conv", "turn", "role_head", "text_head", "mark")))
    nothing = F.lit(None)
    empty = nothing.cast(parts.select(inside.alias("s")).schema["s"].dataType)

    def of(df: DataFrame, key: list[Column], kind: int, *more: Column) -> DataFrame:
        names = ("role", "text", "part")
        return df.select("conv", *key, F.lit(kind).alias("kind"), *(c.alias(n) for c, n in zip(more, names, strict=True)))

    own = [F.col(c) for c in ORDER]
    none = [nothing.cast(t).alias(c) for c, t in zip(ORDER, ("long", "string", "string", "string"), strict=True)]
    text = nothing.cast("string")
    together = (
        of(every.select("conv").distinct(), none, 0, text, text, empty)
        .unionByName(of(parts, own, 1, text, text, inside))
        .unionByName(of(rows, own, 2, F.col("role"), F.col("text"), empty))
    )
    # the conversation itself sorts first: its role_head is null, and that of its rows is not
    dealt = together.repartition("conv").sortWithinPartitions("conv", "turn", "role_head", "text_head", "mark", "kind")
    full, schema = arrow_schema(rows, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        sink = None
        for conv, kind, role, whole, part in rows_of(batches):
            if kind == 0:
                if sink is not None:
                    yield from sink.end()
                sink = emit(Conversation(conv))
            elif kind == 1:
                sink.state.meet(part)
            else:
                for turn in sink.state.pass_row(role, whole):
                    yield from sink.turn(*turn)
        if sink is not None:
            yield from sink.end()

    wanted = dealt.select("conv", "kind", "role", "text", "part")
    return wanted.mapInArrow(lambda batches: batched(run(batches), schema), full)


class Digest:
    """One row a conversation: figures, audit and the hash of the repaired text, which is never held whole."""

    def __init__(self, state: Conversation) -> None:
        self.state, self.hash, self.first = state, hashlib.sha256(), True

    def turn(self, role: str, text: str) -> tuple:
        line = f"{role}:{text}" if self.first else f"\n{role}:{text}"
        self.hash.update(line.encode("utf-8", "surrogatepass"))
        self.first = False
        return ()

    def end(self) -> Iterator[tuple]:
        for turn in self.state.close():
            self.turn(*turn)
        s = self.state
        f = s.figures or Segment()
        yield (
            s.conv, f.gaps, f.blank, f.duplicate, f.truncated, f.illegal, s.cost, "".join(s.audit), self.hash.hexdigest(),
        )


class Turns:
    """One row a turn of the repaired conversation."""

    def __init__(self, state: Conversation) -> None:
        self.state, self.place = state, 0

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        yield self.state.conv, self.place, role, text
        self.place += 1

    def end(self) -> Iterator[tuple]:
        for turn in self.state.close():
            yield from self.turn(*turn)


def source(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return keyed(columns(df, conv=conv_col, turn=turn_col, role=role_col, text=text_col))


def report(
    df: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation.

    Rows are taken by turn, null turns first; rows of one turn by role and text (their first
    ``HEAD`` characters, then a hash of the whole), so equal rows are neighbours. A null role or text counts
    as one space, rows without conversation are one conversation without id. A row's first fault
    counts: blank, seen before in the conversation, not ended by a stop. Keep (K) costs 0, Rerole (R) 2,
    Delete (D) 3, Insert (I) 2, and a row kept truncated 1 more; of the cheapest edits those
    whose initials come first in ASCII are taken. ``every`` may name further conversations: without rows they
    have zeros, no edits and the hash of an empty text. Other columns are left out; an empty table gives no rows.
    """
    rows = source(df, conv_col, turn_col, role_col, text_col)
    named = rows if every is None else columns(every, conv=conv_col)
    ddl = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return passes(rows, named, ddl, Digest).withColumnRenamed("conv", "conv_id")


def repaired(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turn, role, text`` of the repaired conversations, turns numbered from 0."""
    rows = source(df, conv_col, turn_col, role_col, text_col)
    return passes(rows, rows, "turn long, role string, text string", Turns).withColumnRenamed("conv", "conv_id")


def oracle() -> str:
    """The report on damaged ``conversations`` in SQL: both walks as recursive queries."""
    return """
WITH RECURSIVE remainders AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n, list_transform(range(8), lambda z: 0::BIGINT)),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_prepend(4294967295, list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, remainders
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64),
    sha256(length(role)::VARCHAR || ':' || role || text), copy) AS i
  FROM damaged
), facts AS (
  SELECT *, left(role, 1) AS initial,
    NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM numbered
), priced AS (
  SELECT conv_id, i, role, text, initial, blank OR seen AS gone, open::INT AS more FROM facts
), figures AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate,
    count(*) FILTER (NOT blank AND NOT seen AND open) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM facts GROUP BY conv_id
), left_over AS (
  SELECT conv_id, n AS i, [0, 4, 2, 0] AS v FROM figures
  UNION ALL
  SELECT conv_id, i - 1, [least(f[1], 2 + least(f[3], 2 + f[4])), least(f[2], 2 + least(f[3], 2 + f[4])),
    least(f[3], 2 + f[4]), least(f[4], 2 + f[3])]
  FROM (
    SELECT l.conv_id, l.i, [
      least(3 + v[1], CASE WHEN NOT gone THEN 2 + more + v[3] END, CASE WHEN NOT gone AND initial = 's' THEN more + v[2] END,
        CASE WHEN NOT gone AND initial = 'u' THEN more + v[3] END),
      least(3 + v[2], CASE WHEN NOT gone THEN 2 + more + v[3] END, CASE WHEN NOT gone AND initial = 'u' THEN more + v[3] END),
      least(3 + v[3], CASE WHEN NOT gone THEN 2 + more + v[4] END, CASE WHEN NOT gone AND initial = 'a' THEN more + v[4] END),
      least(3 + v[4], CASE WHEN NOT gone THEN 2 + more + v[3] END, CASE WHEN NOT gone AND initial = 'u' THEN more + v[3] END)
    ] AS f
    FROM left_over l JOIN priced p ON p.conv_id IS NOT DISTINCT FROM l.conv_id AND p.i = l.i
  )
), walked AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, 0 AS k, '' AS letter, '' AS line FROM figures
  UNION ALL
  SELECT conv_id, CASE letter WHEN 'I' THEN i ELSE i + 1 END,
    CASE letter WHEN 'D' THEN s WHEN 'K' THEN kept ELSE follows END, k + 1, letter,
    CASE letter WHEN 'K' THEN role || ':' || text WHEN 'R' THEN named || ':' || text WHEN 'I' THEN named || ':' END
  FROM (
    SELECT *, CASE follows WHEN 2 THEN 'user' ELSE 'assistant' END AS named,
      CASE WHEN a IS NOT NULL AND 3 + a[s + 1] = b[s + 1] THEN 'D' WHEN 2 + b[follows + 1] = b[s + 1] THEN 'I'
        WHEN kept > 0 AND more + a[kept + 1] = b[s + 1] THEN 'K' ELSE 'R' END AS letter
    FROM (
      SELECT w.conv_id, w.i, w.s, w.k, p.role, p.text, p.more, here.v AS b, after.v AS a, [2, 2, 3, 2][w.s + 1] AS follows,
        CASE WHEN p.gone THEN 0 WHEN p.initial = 's' AND w.s = 0 THEN 1 WHEN p.initial = 'u' AND w.s <> 2 THEN 2
          WHEN p.initial = 'a' AND w.s = 2 THEN 3 ELSE 0 END AS kept
      FROM walked w JOIN left_over here ON here.conv_id IS NOT DISTINCT FROM w.conv_id AND here.i = w.i
      LEFT JOIN left_over after ON after.conv_id IS NOT DISTINCT FROM w.conv_id AND after.i = w.i + 1
      LEFT JOIN priced p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i + 1
      WHERE a IS NOT NULL OR w.s NOT IN (0, 3)
    )
  )
), repaired AS (
  SELECT conv_id, string_agg(letter, '' ORDER BY k) AS audit,
    coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (k > 0), '') AS whole
  FROM walked GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN left_over l ON l.conv_id IS NOT DISTINCT FROM o.conv_id AND l.i = 0
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
