"""Conversation structure repair (op13): the cheapest edits that make a conversation alternate.

A repaired conversation's role initials read ``(s?(ua)+)?``.  Its edits form a lattice: a node is the
number of rows used and what stands last (nothing, s, u or a); edges keep a row (0), give it the role
due next (3), delete it (4), or insert an empty turn of the role due (3).  Blank rows and rows whose
role and text came before can only be deleted, and a truncated row that stays costs 3 more.

* **Search.**  Dijkstra from both ends: a forward and a reverse heap meet; after that both go on
  until no path as cheap can be missing, so that every crossing of the least cost is seen, and the
  least audit (the edits' letters in order, compared as ASCII) of all crossings is taken.  Heaps
  order equal costs by row, so a label is the least audit of its cost when it is settled.
* **Any length.**  Rows are put in order by a range sort that divides one conversation between
  tasks, and searched as one letter a row, in blocks of at most ``BLOCK`` rows.  A conversation of
  one block (nearly all) is one search.  For a longer one each block is searched from each of the
  four states to each, all blocks at once; the chain of blocks then picks the states between them
  (four numbers a block and state).  Inserted turns belong to the row after them, so no audit of a
  block is the beginning of another, and the least audit of the whole is made of least audits.
* **Writing out.**  Rows and block plans meet by conversation, sorted within the task and read as a
  stream: a task holds one Arrow batch, one block's audits and the audit of its conversation.  The
  hash of a whole conversation can't be divided, so that pass over its texts is one task's.

Nulls: texts, roles and (for the damage hash) ids are one space, a null turn comes first, and a null
conversation id is a conversation like any other.  Rows of one turn are ordered by role and text; a
role whose initial is none of s, u, a can't be kept.  Repeated rows are duplicates.  Columns other
than conv_id, turn, role and text are not looked at.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import forget, modest_batches, table, written

SHIFT = 10
BLOCK = 1 << SHIFT  # rows of one search
BLANKS = " \t\n\x0b\f\r"
ROLE, DELETE, INSERT, CUT = 3, 4, 3, 3  # costs
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # what stands last
AFTER = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
DUE = ("u", "u", "a", "u")  # the role that may be inserted or given after each state
NAMES = {"u": "user", "a": "assistant"}
ENDS = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # what a last block still needs


def edges(symbol: str, state: int):
    """``(letter, cost, next state)`` of the edits that use up a row.

    ``symbol``: b blank, d duplicate, else the role's initial (x: another), upper case where truncated.
    """
    yield "D", DELETE, state
    if symbol in "bd":
        return
    low = symbol.lower()
    extra = CUT if symbol != low else 0
    if state in AFTER.get(low, ()):
        yield "K", extra, AFTER[low][state]
    yield "R", ROLE + extra, AFTER[DUE[state]][state]


def _inserted(state: int) -> int:
    return AFTER[DUE[state]][state]


def cheapest(symbols: str, start: int, goals: tuple[int, ...], trailing: bool) -> tuple[int, str] | None:
    """Least cost and least audit from ``start`` before the first row to one of ``goals`` after the last.

    ``trailing``: whether turns may be inserted after the last row.  None where there is no way.
    """
    n = len(symbols)
    back: dict[tuple[int, int], list] = {}

    def into(i: int, state: int):
        """``(letter, cost, i, state)`` of the edges that end at a node."""
        if (i, state) not in back:
            found = []
            if i:
                found = [(letter, cost, i - 1, s) for s in range(4) for letter, cost, t in edges(symbols[i - 1], s) if t == state]
            if i < n or trailing:
                found += [("I", INSERT, i, s) for s in range(4) if _inserted(s) == state]
            back[i, state] = found
        return back[i, state]

    def out(i: int, state: int):
        if i < n:
            for letter, cost, t in edges(symbols[i], state):
                yield letter, cost, i + 1, t
        if i < n or trailing:
            yield "I", INSERT, i, _inserted(state)

    ahead = [(0, 0, "", start)]
    behind = [(0, -n, "", g) for g in goals]
    done_ahead: dict[tuple[int, int], tuple[int, str]] = {}
    done_behind: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = None
    while ahead and behind:
        if best is not None and ahead[0][0] + behind[0][0] > best[0]:
            break
        if len(done_behind) >= len(goals) and ahead[0][0] <= behind[0][0]:
            cost, i, audit, state = heappop(ahead)
            if (i, state) in done_ahead:
                continue
            done_ahead[i, state] = cost, audit
            for letter, more, j, t in out(i, state):
                if (j, t) in done_behind:
                    rest, tail = done_behind[j, t]
                    total = cost + more + rest
                    if best is None or total <= best[0]:
                        met = (total, audit + letter + tail)
                        best = met if best is None else min(best, met)
                if (j, t) not in done_ahead:
                    heappush(ahead, (cost + more, j, audit + letter, t))
        else:
            cost, i, audit, state = heappop(behind)
            i = -i
            if (i, state) in done_behind:
                continue
            done_behind[i, state] = cost, audit
            for letter, more, j, s in into(i, state):
                if (j, s) in done_ahead:
                    first, head = done_ahead[j, s]
                    total = first + more + cost
                    if best is None or total <= best[0]:
                        met = (total, head + letter + audit)
                        best = met if best is None else min(best, met)
                if (j, s) not in done_behind:
                    heappush(behind, (cost + more, -j, letter + audit, s))
    return best


@lru_cache(maxsize=1 << 14)
def whole(symbols: str) -> tuple[int, str]:
    """Cost and audit of a conversation of one block."""
    return cheapest(symbols, NOTHING, (NOTHING, ASSISTANT), True)


def block_table(symbols: str) -> list[tuple[int, str] | None]:
    """Cost and audit of a block from each state to each (``4 * start + end``)."""
    return [cheapest(symbols, start, (end,), False) for start in range(4) for end in range(4)]


def chain(costs: list[list[int | None]], ranks: list[list[int]]) -> tuple[int, list[int]]:
    """Total cost, and for each block its cell ``4 * start + end``, of the least audit along all blocks."""
    value: list[int | None] = [INSERT * len(ENDS[s]) for s in range(4)]
    picks: list[list[int]] = []
    for cost, rank in zip(reversed(costs), reversed(ranks), strict=True):
        best = [min(((cost[4 * s + e] + value[e], rank[4 * s + e], e) for e in range(4) if cost[4 * s + e] is not None and value[e] is not None), default=None)
                for s in range(4)]
        picks.append([b[2] if b else -1 for b in best])
        value = [b[0] if b else None for b in best]
    state, cells = NOTHING, []
    for pick in reversed(picks):
        cells.append(4 * state + pick[state])
        state = pick[state]
    return value[NOTHING], cells


class Writer:
    """The turns of one repaired conversation, row by row."""

    def __init__(self):
        self.state, self.left = NOTHING, iter(())

    def _insert(self):
        role = DUE[self.state]
        self.state = AFTER[role][self.state]
        return "I", NAMES[role], ""

    def row(self, role: str, text: str):
        """The ``(letter, role, text)`` that come of a row, turns inserted before it first."""
        for letter in self.left:
            if letter == "I":
                yield self._insert()
                continue
            if letter == "K":
                self.state = AFTER[role[:1]][self.state]
                yield letter, role, text
            elif letter == "R":
                due = DUE[self.state]
                self.state = AFTER[due][self.state]
                yield letter, NAMES[due], text
            return

    def end(self, letters: str):
        yield from (self._insert() for _ in [*self.left, *letters])


def order_rows(rows: DataFrame) -> DataFrame:
    """``(at, conv_id, turn, role, text, ...)``: every row's place ``at`` in the order of conversations and turns, its fault and its initial."""
    tie = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("tie"))  # equal rows may part too
    placed = tie.orderBy("conv_id", "turn", "role", "text", "tie").select(F.monotonically_increasing_id().alias("at"), "conv_id", "turn", "role", "text")
    said = F.rtrim("text", F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return written(placed.select("*", F.md5("text").alias("said"), initial.alias("initial"), (said == "").alias("is_blank"),
                                 (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("is_cut")), "repair-rows")


def blocks_of(placed: DataFrame) -> DataFrame:
    """``(conv_id, at, symbols, initials)`` per block of at most ``BLOCK`` rows, ``at`` its first row's."""
    # a row is its conversation's first with this role and text, or a duplicate; combined before the shuffle
    first = placed.groupBy("conv_id", "role", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    marked = placed.select("at", "conv_id", "initial", "is_blank", "is_cut").join(first, "at", "left")
    symbol = F.when(F.col("is_blank"), "b").when(F.col("new").isNull(), "d").when(F.col("is_cut"), F.upper("initial")).otherwise(F.col("initial"))
    each = marked.select("conv_id", F.shiftright("at", SHIFT).alias("block"), F.struct("at", symbol.alias("symbol"), "initial").alias("r"))
    blocks = each.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("r")).alias("r"))  # at most BLOCK
    return written(blocks.select("conv_id", F.col("r")[0]["at"].alias("at"), F.concat_ws("", "r.symbol").alias("symbols"), F.concat_ws("", "r.initial").alias("initials")), "repair-blocks")


PLAN = "conv_id {}, at long, symbols string, initials string, costs array<int>, audits array<string>"


def planned(blocks: DataFrame) -> DataFrame:
    """``blocks`` with the costs and audits of their searches: one where a conversation is one block, else sixteen."""
    several = blocks.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("c"), F.lit(True).alias("several"))
    joined = blocks.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", "at", "symbols", "initials", F.coalesce("several", F.lit(False)).alias("several"))

    def run(batches):
        for batch in batches:
            costs, audits = [], []
            for symbols, many in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
                found = block_table(symbols) if many else [whole(symbols)]
                costs.append([f and f[0] for f in found])
                audits.append([f and f[1] for f in found])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(costs, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))],
                                             ["conv_id", "at", "symbols", "initials", "costs", "audits"])

    kind = blocks.schema["conv_id"].dataType.simpleString()
    return written(joined.mapInArrow(run, PLAN.format(kind)), "repair-plans")


def _streams(placed: DataFrame, plans: DataFrame) -> DataFrame:
    """Conversations whole, in one task each and in order: the plans of all their blocks, then each block's audits and its rows."""
    rank = F.transform(F.sequence(F.lit(0), F.size("audits") - 1), lambda i: F.size(F.filter("audits", lambda x: x < F.col("audits")[i])))
    none = {"costs": "array<int>", "ranks": "array<int>", "audits": "array<string>", "role": "string", "text": "string", "symbols": "string", "initials": "string"}

    def part(df, phase, **given):
        return df.select("conv_id", F.lit(phase).alias("phase"), "at", *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in none.items()])

    heads = part(plans, 0, costs=F.col("costs"), ranks=rank, symbols=F.col("symbols"), initials=F.col("initials"))
    audits = part(plans, 1, audits=F.col("audits"))
    rows = part(placed, 2, role=F.col("role"), text=F.col("text"))
    # a block's audits come right before its first row
    return heads.unionByName(audits).unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", F.col("phase") > 0, "at", "phase")


def _conversations(batches):
    """Walks through ``_streams``: ``(conv_id, facts, turns)`` events; ``turns`` come as they are read, ``facts`` at a conversation's end."""
    current, open_ = object(), False
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            r = dict(zip(names, values, strict=True))
            if not open_ or r["conv_id"] != current:
                if open_:
                    yield current, *_close(facts, writer)
                current, open_ = r["conv_id"], True
                writer, last = Writer(), None
                facts = {"costs": [], "ranks": [], "cells": None, "audit": [], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            if r["phase"] == 0:
                symbols, initials = r["symbols"], r["initials"]
                facts["costs"].append(r["costs"]), facts["ranks"].append(r["ranks"])
                facts["blank"] += symbols.count("b")
                facts["duplicate"] += symbols.count("d")
                facts["truncated"] += sum(map(str.isupper, symbols))
                facts["illegal"] += sum(p not in ("su", "ua", "au") for p in map("".join, zip((last or "") + initials, initials if last else initials[1:], strict=False)))
                last = initials[-1]
            elif r["phase"] == 1:
                if facts["cells"] is None:
                    alone = len(facts["costs"][0]) == 1
                    facts["cost"], cells = (facts["costs"][0][0], [0]) if alone else chain(facts["costs"], facts["ranks"])
                    facts["cells"], facts["alone"] = iter(cells), alone
                audit = r["audits"][next(facts["cells"])]
                facts["audit"].append(audit)
                writer.left = iter(audit)
            else:
                yield current, None, list(writer.row(r["role"], r["text"]))
                if facts["alone"]:
                    continue
    if open_:
        yield current, *_close(facts, writer)


def _close(facts, writer):
    turns = list(writer.end("" if facts["alone"] else ENDS[writer.state]))
    if not facts["alone"]:
        facts["audit"].append("I" * len(turns))
    return facts, turns


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``(conv_id, place, edit, role, text)``, one row a turn, ``edit`` K, R or I."""
    modest_batches(rows.sparkSession)
    placed = order_rows(rows)
    kind = placed.schema["conv_id"].dataType.simpleString()

    def run(batches):
        out, place = [], 0
        for conv, facts, turns in _conversations(batches):
            for letter, role, text in turns:
                out.append((conv, place, letter, role, text))
                place += 1
            if facts:
                place = 0
            if len(out) >= 1000:
                yield _batch(out, names, types)
                out = []
        yield _batch(out, names, types)

    names, types = ["conv_id", "place", "edit", "role", "text"], [_arrow(kind), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _streams(placed, planned(blocks_of(placed))).mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: gaps, faults by kind, illegal neighbours, cost, audit, and the repaired conversation's hash."""
    modest_batches(rows.sparkSession)
    placed = order_rows(rows)
    kind = placed.schema["conv_id"].dataType.simpleString()
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv_id", *counts, "audit", "repaired_sha256"]
    types = [_arrow(kind), *[pa.int64()] * len(counts), pa.string(), pa.string()]

    def run(batches):
        out, digest, sep = [], hashlib.sha256(), b""
        for conv, facts, turns in _conversations(batches):
            for _, role, text in turns:
                digest.update(sep + f"{role}:{text}".encode())
                sep = b"\n"
            if facts:
                out.append((conv, *(facts[c] for c in counts), "".join(facts["audit"]), digest.hexdigest()))
                digest, sep = hashlib.sha256(), b""
            if len(out) >= 1000:
                yield _batch(out, names, types)
                out = []
        yield _batch(out, names, types)

    blocks = blocks_of(placed)
    plans = planned(blocks)
    forget(blocks)
    fixed = _streams(placed, plans).mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")
    turns = placed.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")).select(F.col("conv_id").alias("c"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"))
    return fixed.join(turns, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "gaps", *names[1:])


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Conversations with known faults, by a hash of id and turn: rows dropped, emptied, cut, repeated, given the wrong role."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text(conv), F.lit(":"), text(turn)).cast("binary")) % 20
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    said = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), said.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    turns = table(spark, sf_dir, "conversations")
    report = repair_report(damaged(turns)).withColumnRenamed("conv_id", "c")
    ids = turns.groupBy("conv_id").agg(F.lit(1).alias("one")).drop("one")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return ids.join(report, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
