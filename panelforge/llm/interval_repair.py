"""Repair of conversation structure by weighted interval parsing.

The grammar of repaired conversations is in Chomsky normal form. A nonterminal says what the
kept, reroled and inserted turns of a span look like, and each of its derivations can be cut
at any place, so spans of whole blocks combine by the same rules as spans of rows:

``N`` nothing, ``S`` a system turn, ``UU`` u(au)*, ``UA`` (ua)+, ``AU`` (au)+, ``AA`` a(ua)*,
``SU`` and ``SA`` a system turn before UU or UA. A conversation is N, UA or SA.

A cell holds, for each nonterminal, the least (cost, audit) of a span. Two audits of one span,
nonterminal and cost never begin with one another (the longer one would hold more insertions
and cost more), so the least stays the least when something is put before or after it.

1. Rows are damaged and judged by column expressions; equal rows of a turn are combined.
2. Light rows without text are sorted by (conversation, turn) over range partitions. Each
   partition parses its part of a conversation in blocks, and the parts, at most one a
   partition, are parsed again: a hot conversation spreads over tasks.
3. Texts are sorted by conversation behind a row with its audit, and stream through the
   edits into a running hash, so no conversation is held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import map_arrow, require
from panelforge.session import land

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows, or cells of finished blocks, that one interval table takes.
BLOCK = 8
#: Characters that count as blank, as a pattern.
SPACE = r"\x20\x09-\x0D"

NAMES = ("N", "S", "UU", "UA", "AU", "AA", "SU", "SA")
N, S, UU, UA, AU, AA, SU, SA = range(8)
RULES = (
    (N, N, N),
    *((x, x, N) for x in range(1, 8)), *((x, N, x) for x in range(1, 8)),
    (UU, UU, AU), (UU, UA, UU), (UA, UU, AA), (UA, UA, UA),
    (AU, AU, AU), (AU, AA, UU), (AA, AU, AA), (AA, AA, UA),
    (SU, S, UU), (SU, SU, AU), (SU, SA, UU), (SA, S, UA), (SA, SU, AA), (SA, SA, UA),
)
ACCEPTED = (N, UA, SA)
#: What one inserted turn makes of a span, put before (the right side of a rule) or after it.
BEFORE = tuple((x, z) for x, y, z in RULES if y in (UU, AA))
AFTER = tuple((x, y) for x, y, z in RULES if z in (UU, AA))

Entry = tuple[int, str]
Cell = tuple[Entry | None, ...]


def _closed(cell: list[Entry | None]) -> Cell:
    """The cell with every turn inserted before or after the span that makes something cheaper."""

    changed = True
    while changed:
        changed = False
        for moves, before in ((BEFORE, True), (AFTER, False)):
            for x, y in moves:
                if cell[y] is not None:
                    cost, audit = cell[y]
                    if cell[x] is None or cost + INSERT <= cell[x][0]:
                        entry = (cost + INSERT, "I" + audit if before else audit + "I")
                        if cell[x] is None or entry < cell[x]:
                            cell[x], changed = entry, True
    return tuple(cell)


@lru_cache(maxsize=32)
def leaf(symbol: str) -> Cell:
    """Cell of one row: ``x`` must go; ``s``, ``u``, ``a``, ``o`` name its role, capitals mark truncated rows."""

    cell: list[Entry | None] = [None] * 8
    cell[N] = (DELETE, "D")
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = {"s": S, "u": UU, "a": AA}.get(symbol.lower())
        for x in (UU, AA):
            cell[x] = (extra + REROLE, "R")
        if kept is not None:
            cell[kept] = (extra, "K")
    return _closed(cell)


def _joined(pairs: list[tuple[Cell, Cell]]) -> Cell:
    """Least entries over all ways to cut a span in two, closed under insertion."""

    cell: list[Entry | None] = [None] * 8
    for left, right in pairs:
        for x, y, z in RULES:
            a, b = left[y], right[z]
            if a is not None and b is not None:
                cost, best = a[0] + b[0], cell[x]
                if best is None or cost < best[0] or (cost == best[0] and a[1] + b[1] < best[1]):
                    cell[x] = (cost, a[1] + b[1])
    return _closed(cell)


def parse(cells: list[Cell]) -> Cell:
    """Cell of the whole span, from a table of all spans filled by their length."""

    spans = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, len(cells) + 1):
        for i in range(len(cells) - length + 1):
            j = i + length
            spans[i, j] = _joined([(spans[i, k], spans[k, j]) for k in range(i + 1, j)])
    return spans[0, len(cells)]


@lru_cache(maxsize=1 << 15)
def _span(symbols: str) -> Cell:
    """Cell of a few rows; equal spans of all conversations of a worker share one cell."""

    if len(symbols) == 1:
        return leaf(symbols)
    return _joined([(_span(symbols[:k]), _span(symbols[k:])) for k in range(1, len(symbols))])


def parse_rows(symbols: str) -> Cell:
    """Cell of at most ``BLOCK`` rows, by interval tables that are filled by span length."""

    for length in range(2, len(symbols)):
        for i in range(len(symbols) - length + 1):
            _span(symbols[i : i + length])
    return _span(symbols)


class Spans:
    """Rows that stream by, parsed block by block; holds fewer than ``BLOCK`` cells a level."""

    def __init__(self) -> None:
        self.symbols, self.levels = "", []

    def add(self, symbols: str) -> None:
        self.symbols += symbols
        while len(self.symbols) > BLOCK:
            self._push(parse_rows(self.symbols[:BLOCK]), 0)
            self.symbols = self.symbols[BLOCK:]

    def _push(self, cell: Cell, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(cell)
        if len(self.levels[level]) == BLOCK:
            self._push(parse(self.levels[level]), level + 1)
            self.levels[level] = []

    def cell(self) -> Cell | None:
        """Cell of all rows; none without rows."""

        left = [c for level in reversed(self.levels) for c in level] + ([parse_rows(self.symbols)] if self.symbols else [])
        return fold(left)


def fold(cells: list[Cell]) -> Cell | None:
    """Cell of spans side by side, in tables of at most ``BLOCK`` of them."""

    while len(cells) > 1:
        cells = [parse(cells[i : i + BLOCK]) for i in range(0, len(cells), BLOCK)]
    return cells[0] if cells else None


def repair_of(cell: Cell | None) -> Entry:
    """Cost and audit of the cheapest repair; ties go to the least audit."""

    return (0, "") if cell is None else min(cell[x] for x in ACCEPTED if cell[x] is not None)


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``copies`` (0: dropped, 2: repeated) of each row after damage.

    The kind of damage is crc32 of ``conv:turn`` modulo 20; null counts as one space in each column.
    """

    space = F.lit(" ")
    said, spoken = (F.coalesce(F.col(c).cast("string"), space) for c in (role, text))
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    return (
        df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), said.alias("role"), spoken.alias("text"), (F.crc32(key) % 20).alias("kind"))
        .select(
            "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
        )
    )


def as_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same columns for rows that are judged as they are; null role or text counts as one space."""

    return df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))], F.lit(1).alias("copies"),
    )


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))


def _judged(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: ``conv``, ``turn``, ``digest``, ``initial``, ``copies``, ``blank``, ``cut``, ``seen``.

    ``seen`` tells that the conversation has the same role and text in an earlier turn.
    """

    light = rows.select(
        "conv", "turn", _digest().alias("digest"), "copies", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"), (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"),
    )
    grouped = land(
        light.groupBy("conv", "turn", "digest", "initial", "blank", "cut").agg(F.sum("copies").alias("copies")), "judged-turns"
    )
    firsts = (
        grouped.where("copies > 0").groupBy("conv", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))  # a null turn is the least
        .where("n > 1").select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first")
    )
    same = grouped["conv"].eqNullSafe(F.col("c")) & (grouped["digest"] == F.col("d"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return grouped.join(land(firsts, "said-before"), same, "left").withColumn("seen", later).drop("c", "d", "first")


PART = (
    "conv {0}, part bigint, first string, last string, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, costs array<bigint>, audits array<string>"
)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _parsed_parts(judged: DataFrame) -> DataFrame:
    """One row per conversation and range partition: what its rows say and the cell of their span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state, schema = TaskContext.get().partitionId(), None, None

        def finished(done: list[dict]) -> pa.RecordBatch:
            for row in done:
                cell = row.pop("spans").cell()
                row["costs"] = None if cell is None else [e and e[0] for e in cell]
                row["audits"] = None if cell is None else [e and e[1] for e in cell]
            return pa.RecordBatch.from_pylist(done, schema)

        for batch in batches:
            if schema is None:
                whole, text = pa.int64(), pa.string()
                schema = pa.schema(
                    [("conv", batch.schema.field("conv").type), ("part", whole), ("first", text), ("last", text)]
                    + [(n, whole) for n in ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")]
                    + [("costs", pa.list_(whole)), ("audits", pa.list_(text))]
                )
            done = []
            for conv, turn, initial, copies, blank, cut, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state["conv"] != conv:
                    if state is not None:
                        done.append(state)
                    state = {
                        "conv": conv, "part": part, "first": None, "last": None, "low": None, "high": None, "turns": 0,
                        "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "spans": Spans(),
                    }
                if not copies:
                    continue
                if turn is not None and turn != state["high"]:
                    state["low"] = turn if state["low"] is None else state["low"]
                    state["high"], state["turns"] = turn, state["turns"] + 1
                if state["last"] is not None:
                    state["illegal"] += (state["last"], initial) not in LEGAL
                state["illegal"] += copies - 1  # equal roles side by side
                state["first"], state["last"] = initial if state["first"] is None else state["first"], initial
                if blank:
                    state["blank"] += copies
                    state["spans"].add("x" * copies)
                elif seen:
                    state["duplicate"] += copies
                    state["spans"].add("x" * copies)
                else:
                    symbol = initial if initial in ("s", "u", "a") else "o"
                    state["duplicate"] += copies - 1
                    state["truncated"] += cut
                    state["spans"].add((symbol.upper() if cut else symbol) + "x" * (copies - 1))
            if done:
                yield finished(done)
        if state is not None:
            yield finished([state])

    order = ["conv", "turn", "digest"]
    ordered = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = judged.schema["conv"].dataType.simpleString()
    return map_arrow(
        ordered.select("conv", F.col("turn").cast("bigint"), "initial", "copies", "blank", "cut", "seen"), run, PART.format(kind)
    )


VERDICT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _verdicts(parts: DataFrame) -> DataFrame:
    """One row per conversation: its faults, cost and audit, from its parts in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                parts.sort(key=lambda p: p["part"])
                sums = {n: sum(p[n] for p in parts) for n in ("blank", "duplicate", "truncated", "illegal")}
                live = [p for p in parts if p["costs"] is not None]
                sums["illegal"] += sum((a["last"], b["first"]) not in LEGAL for a, b in zip(live, live[1:]))
                timed = [p for p in live if p["low"] is not None]
                turns = sum(p["turns"] for p in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
                gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
                cells = [tuple(None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"])) for p in live]
                cost, audit = repair_of(fold(cells))
                out.append((gaps, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], cost, audit))
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *[pa.array(c, pa.int64()) for c in columns[:6]], pa.array(columns[6], pa.string())],
                names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
            )

    kind = parts.schema["conv"].dataType.simpleString()
    together = parts.groupBy("conv").agg(F.collect_list(F.struct(*parts.columns[1:])).alias("parts"))  # one a partition
    return map_arrow(together, run, f"conv {kind}, {VERDICT}")


class Edited:
    """Applies an audit to rows that stream by; gets the repaired rows as ``write(role, text)`` calls."""

    def __init__(self, audit: str, write) -> None:
        self.audit, self.at, self.due, self.write = audit, 0, "user", write

    def insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self._produce(self.due, "")

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._produce(role, text)
        elif edit == "R":
            self._produce(self.due, text)

    def _produce(self, role: str, text: str) -> None:
        self.due = "assistant" if role[:1] == "u" else "user"
        self.write(role, text)


class _Hash:
    def __init__(self) -> None:
        self.digest, self.lines = hashlib.sha256(), 0

    def __call__(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1


def _finished(verdicts: DataFrame, rows: DataFrame) -> DataFrame:
    """``verdicts`` with the hash of the repaired conversation; texts stream by behind their verdict."""

    names = [f.split()[0] for f in VERDICT.split(", ")]
    heads = verdicts.withColumns({"kind": F.lit(0), "turn": F.lit(None).cast(rows.schema["turn"].dataType), "digest": F.lit(None).cast("binary"),
                                  "copies": F.lit(0), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    texts = rows.where("copies > 0").withColumns({"kind": F.lit(1), "digest": _digest()})
    texts = texts.withColumns({f.split()[0]: F.lit(None).cast(f.split()[1]) for f in VERDICT.split(", ")})
    order = ["conv", "kind", "turn", "digest"]
    ordered = (
        heads.unionByName(texts).repartition("conv").sortWithinPartitions(*order).select("conv", "kind", "copies", "role", "text", *names)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = edit = schema = None

        def closing() -> dict:
            edit.insertions()
            return head | {"repaired_sha256": edit.write.digest.hexdigest()}

        for batch in batches:
            if schema is None:
                schema = pa.schema([batch.schema.field(n) for n in ("conv", *names)] + [("repaired_sha256", pa.string())])
            done = []
            kinds, roles, texts, copies = (batch.column(n).to_pylist() for n in ("kind", "role", "text", "copies"))
            for i, kind in enumerate(kinds):
                if kind == 0:
                    if head is not None:
                        done.append(closing())
                    head = {n: batch.column(n)[i].as_py() for n in ("conv", *names)}
                    edit = Edited(head["audit"], _Hash())
                else:
                    for _ in range(copies[i]):
                        edit.row(roles[i], texts[i])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if head is not None:
            yield pa.RecordBatch.from_pylist([closing()], schema)

    kind = rows.schema["conv"].dataType.simpleString()
    return map_arrow(ordered, run, f"conv {kind}, {VERDICT}, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """One row per ``conv`` of ``rows`` (see :func:`damaged`): faults, least cost, audit and hash of the repaired rows."""

    parts = land(_parsed_parts(_judged(rows)), "parsed-parts")
    return _finished(land(_verdicts(parts), "repair-verdicts"), rows)


def damaged_and_repaired(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation of ``df``, damaged by :func:`damaged` and repaired by :func:`repaired`.

    The id, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``,
    ``repaired_sha256``. Null turns come first; rows of one turn are ordered by a digest of role
    and text, repeated rows stand side by side. Null role or text counts as one space; rows
    without an id form one conversation without an id. Turns are integers. A conversation that
    loses all its rows has zeros, an empty audit and the hash of nothing; an empty table gives
    an empty result. Other columns are ignored. The hash of a conversation is one sequential
    pass over its texts in one task, in memory that holds its audit and one batch.
    """

    require(df, conv, turn, role, text)
    return repaired(damaged(df, conv, turn, role, text)).withColumnRenamed("conv", conv)
