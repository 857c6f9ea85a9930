"""Cheapest repair of a conversation's structure, by Four-Russians tables.

A conversation's rows become symbols: the role's initial and the row's fault.
The cheapest edits that make the roles read ``(s?(ua)+)?`` are a shortest path
over four states; the vector of costs from each state to the end, less its
least, takes few values.  For every one of them and every block of symbols a
table holds the vector before the block and the cost to add, so a conversation
is read a block at a time, from its end.  The edits are then traced from the
start: each block's inner vectors are worked out backward from its stored end,
and of the cheapest edits the least letter is taken.

Rows are range-partitioned by conversation and turn, so a conversation of any
size spans many tasks.  One that lies within a task's range is finished there.
Any other is cut into pieces; a piece is summed up as the four vectors that it
makes of the four end states, these compose to every piece's true end vector,
and so do the states in which the traces leave the pieces.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, map_arrow, saved, shuffle_partitions

# States of the roles written so far: none, one system, ..user, ..assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 1 << 40
# next state by a kept row's initial, and by a rerole or an insertion
KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WRITTEN = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

# symbols: the row must go; else its initial (s, u, a, other), sound or truncated
INITIALS = "sua?"
GONE = 0
SYMBOLS = 1 + 2 * len(INITIALS)
BLOCK = 4

# a piece holds so many rows or so many characters at most (or one row)
PIECE_ROWS = 16_384
PIECE_CHARS = 1_000_000


def symbol(role: str, fault: str) -> int:
    if fault in ("blank", "duplicate"):
        return GONE
    return 1 + 2 * (INITIALS.find(role[:1]) if role[:1] in ("s", "u", "a") else 3) + (fault == "truncated")


def _options(sym: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row in a state: letter, cost, next state."""
    out = [("D", DELETE, state)]
    if sym != GONE:
        initial, extra = INITIALS[(sym - 1) // 2], TRUNCATED * ((sym - 1) % 2)
        if (state, initial) in KEPT:
            out.append(("K", KEEP + extra, KEPT[state, initial]))
        out.append(("R", REROLE + extra, WRITTEN[state]))
    return out


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs if rows may be inserted first; two are the most that helps."""
    for _ in range(3):
        costs = [min(costs[s], INSERT + costs[WRITTEN[s]]) for s in range(4)]
    return [min(c, FAR) for c in costs]


def before(sym: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end from each state before a row, from those behind it."""
    return tuple(_with_inserts([min(c + costs[t] for _, c, t in _options(sym, s)) for s in range(4)]))


# costs at the end of a conversation: none or an assistant ends well
END = tuple(_with_inserts([0, FAR, FAR, 0]))
# and at the end of a piece that must be left in one given state
UNIT = tuple(tuple(_with_inserts([0 if s == t else FAR for s in range(4)])) for t in range(4))


def _normal(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(FAR if c >= FAR else c - least for c in costs), least


class Tables:
    """Every normalised cost vector that can occur, and per vector and block
    of ``BLOCK`` symbols the vector before the block and the cost to add."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        step, cost = [], []
        for v in (END, *UNIT):
            self._known(_normal(v)[0])
        while len(step) < len(self.vectors):
            made = [_normal(before(s, self.vectors[len(step)])) for s in range(SYMBOLS)]
            step.append([self._known(v) for v, _ in made])
            cost.append([c for _, c in made])
        self.step, self.cost = np.array(step), np.array(cost)
        # blocks one symbol longer: the new symbol stands before the others
        self.block_step, self.block_cost = self.step, self.cost
        for _ in range(block - 1):
            inner, paid = self.block_step, self.block_cost
            self.block_step = np.concatenate([self.step[inner, s] for s in range(SYMBOLS)], axis=1)
            self.block_cost = np.concatenate([paid + self.cost[inner, s] for s in range(SYMBOLS)], axis=1)

    def _known(self, v: tuple[int, ...]) -> int:
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
        return self.number[v]

    def codes(self, symbols: np.ndarray) -> list[int]:
        """Block numbers of the symbols, whose count is a multiple of the block."""
        weights = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        return (symbols.reshape(-1, self.block).astype(np.int64) @ weights).tolist()


@functools.cache
def tables() -> Tables:
    return Tables()


class Reading:
    """Symbols read backward from an end vector: ``costs`` of each state
    before them, and the vector behind each block for the trace."""

    def __init__(self, symbols: np.ndarray, end: tuple[int, ...], t: Tables | None = None):
        self.t = t = t or tables()
        self.symbols = np.asarray(symbols, dtype=np.int64)
        self.odd = len(self.symbols) % t.block       # read singly, at the start
        vector, paid = _normal(tuple(end))
        v = t.number[vector]
        self.codes = t.codes(self.symbols[self.odd:])
        self.ends = []
        for code in reversed(self.codes):
            self.ends.append(v)
            paid += int(t.block_cost[v, code])
            v = int(t.block_step[v, code])
        self.ends.reverse()
        self.odd_end = v
        for s in reversed(self.symbols[:self.odd].tolist()):
            paid += int(t.cost[v, s])
            v = int(t.step[v, s])
        self.costs = tuple(min(c + paid, FAR) for c in t.vectors[v])

    def trace(self, state: int, at_end: bool) -> tuple[str, int]:
        """The least letters of a cheapest way on from ``state``, and the
        state behind them; ``at_end`` adds the insertions that a conversation's
        end needs."""
        out = []
        if self.odd:
            letters, state = _expand(self.t, tuple(self.symbols[:self.odd].tolist()), self.odd_end, state)
            out.append(letters)
        for k, v in enumerate(self.ends):
            a = self.odd + k * self.t.block
            letters, state = _expand(self.t, tuple(self.symbols[a:a + self.t.block].tolist()), v, state)
            out.append(letters)
        while at_end and state in (SYSTEM, USER):
            out.append("I")
            state = WRITTEN[state]
        return "".join(out), state


@functools.lru_cache(maxsize=100_000)
def _expand(t: Tables, symbols: tuple[int, ...], end: int, state: int) -> tuple[str, int]:
    """Letters through one block, least first among the cheapest: the
    vectors inside it are worked out backward from its end."""
    inner = [t.vectors[end]]
    for s in reversed(symbols):
        inner.append(before(s, inner[-1]))
    inner.reverse()
    out = []
    for k, s in enumerate(symbols):
        while True:
            cost = inner[k][state]
            ways = [(letter, t2) for letter, c, t2 in _options(s, state) if c + inner[k + 1][t2] == cost]
            if INSERT + inner[k][WRITTEN[state]] == cost:
                ways.append(("I", WRITTEN[state]))
            letter, state = min(ways)
            out.append(letter)
            if letter != "I":
                break
    return "".join(out), state


def repaired(letters: str, rows: Iterator[tuple[str, str]], state: int) -> Iterator[str]:
    """The lines ``role:text`` that edits from a state make of rows."""
    for letter in letters:
        if letter == "I":
            state = WRITTEN[state]
            yield f"{ROLE_OF[state]}:"
            continue
        role, text = next(rows)
        if letter == "K":
            state = KEPT[state, role[:1]]
            yield f"{role}:{text}"
        elif letter == "R":
            state = WRITTEN[state]
            yield f"{ROLE_OF[state]}:{text}"


# --- rows -----------------------------------------------------------------

_BLANKS = " \t\n\x0b\x0c\r"


def fault(text: str, repeated: bool) -> str:
    said = text.rstrip(_BLANKS)
    if not said:
        return "blank"
    if repeated:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


_RESULT = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
           ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
           ("repaired_sha256", pa.string())]
_PIECE = [("part", pa.int64()), ("piece", pa.int64()), ("symbols", pa.binary()), ("roles", pa.list_(pa.string())),
          ("texts", pa.list_(pa.string())), ("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64()),
          ("vectors", pa.list_(pa.int64()))]
_SCHEMA = pa.schema(_RESULT + _PIECE)
_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string, part long, piece long, symbols binary, roles array<string>, "
        "texts array<string>, least long, most long, turns long, vectors array<long>")


class _Open:
    """The rows of a conversation, or of a piece of it, as they come."""

    def __init__(self, conv_id, piece: int):
        self.conv_id, self.piece, self.chars = conv_id, piece, 0
        self.symbols, self.roles, self.texts = bytearray(), [], []
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.least = self.most = None
        self.turns = 0

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        f = fault(text, repeated)
        if f:
            self.count[f] += 1
        self.symbols.append(symbol(role, f))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(role) + len(text)
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn

    def illegal(self) -> int:
        first = [r[:1] for r in self.roles]
        return sum(a + b not in LEGAL for a, b in zip(first, first[1:]))

    def faults(self) -> dict:
        return {**self.count, "illegal": self.illegal()}

    def finished(self) -> dict:
        way = Reading(np.frombuffer(bytes(self.symbols), np.uint8), END)
        audit, _ = way.trace(NONE, True)
        text = "\n".join(repaired(audit, iter(zip(self.roles, self.texts)), NONE))
        return {"conv_id": self.conv_id, "gaps": _gaps(self.least, self.most, self.turns), **self.faults(),
                "cost": way.costs[NONE], "audit": audit,
                "repaired_sha256": hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()}

    def as_piece(self, part: int) -> dict:
        symbols = np.frombuffer(bytes(self.symbols), np.uint8)
        return {"conv_id": self.conv_id, **self.faults(), "part": part, "piece": self.piece,
                "symbols": bytes(self.symbols), "roles": self.roles, "texts": self.texts, "least": self.least,
                "most": self.most, "turns": self.turns,
                "vectors": [c for end in UNIT for c in Reading(symbols, end).costs]}


def _gaps(least: int | None, most: int | None, turns: int) -> int:
    return 0 if least is None else most - least + 1 - turns


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return batch_of(_SCHEMA, **{n: [r.get(n) for r in rows] for n in _SCHEMA.names})


def _read_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sorted range: conversations inside it are finished, the first
    and the last one and large ones come as pieces."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    now, first, before_row, out, size = None, True, None, [], 0
    for b in batches:
        cols = (b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "earlier"))
        for conv, turn, role, text, n, earlier in zip(*cols):
            if now is None or conv != now.conv_id:
                if now is not None:
                    out.append(now.as_piece(part) if first or now.piece else now.finished())
                    size += now.chars
                    first = False
                now = _Open(conv, 0)
            if n is None:                       # stands for a conversation without rows
                continue
            for copy in range(n):
                if len(now.symbols) >= PIECE_ROWS or now.symbols and now.chars + len(text) > PIECE_CHARS:
                    out.append(now.as_piece(part))
                    size += now.chars
                    now = _Open(conv, now.piece + 1)
                    now.most = out[-1]["most"]  # a turn that goes on is not a new one
                now.add(turn, role, text, earlier or copy > 0)
                if size > PIECE_CHARS:
                    yield _batch(out)
                    out, size = [], 0
            if len(out) >= 4096:
                yield _batch(out)
                out, size = [], 0
    if now is not None:
        out.append(now.as_piece(part))
        yield _batch(out)


def _compose(vectors: np.ndarray, end: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a piece from those behind it: ``vectors[t]`` are the
    costs before it if it must end in state t."""
    return tuple(int(c) for c in np.minimum((vectors + np.array(end)[:, None]).min(axis=0), FAR))


def _chain_ends(rows: pd.DataFrame) -> pd.DataFrame:
    """The end vector of each piece of a conversation, and its totals over
    all pieces with one per conversation (on its first piece)."""
    rows = rows.sort_values(["part", "piece"], ignore_index=True)
    end, ends = END, []
    for v in reversed(rows["vectors"].tolist()):
        ends.append(list(end))
        end = _compose(np.array(v, dtype=np.int64).reshape(4, 4), end)
    rows["end"] = ends[::-1]
    rows["cost"] = end[NONE]
    return rows[["conv_id", "part", "piece", "end", "cost"]]


def _chain_states(rows: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece starts."""
    rows = rows.sort_values(["part", "piece"], ignore_index=True)
    state, states = NONE, []
    for exits in rows["exits"]:
        states.append(state)
        state = int(exits[state])
    rows["state"] = states
    rows["is_last"] = [False] * (len(rows) - 1) + [True]
    return rows[["conv_id", "part", "piece", "state", "is_last"]]


def _on(a: DataFrame, b: DataFrame) -> DataFrame:
    keys = ["conv_id", "part", "piece"]
    b = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    return a.join(b, [a[k].eqNullSafe(b[f"_{k}"]) for k in keys]).drop(*[f"_{k}" for k in keys])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()),
                        ("exits", pa.list_(pa.int64()))])
    for b in batches:
        exits = []
        for s, end in zip(b.column("symbols").to_pylist(), b.column("end").to_pylist()):
            way = Reading(np.frombuffer(s, np.uint8), tuple(end))
            exits.append([way.trace(state, False)[1] if way.costs[state] < FAR else state for state in range(4)])
        yield batch_of(schema, conv_id=b.column("conv_id"), part=b.column("part"), piece=b.column("piece"), exits=exits)


_TRACED = "conv_id long, part long, piece long, cost long, audit string, lines string, initials string, " \
          "blank long, duplicate long, truncated long, illegal long, least long, most long, turns long"


def _trace_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64())
                        for c in _TRACED.split(", ")])
    for b in batches:
        audits, lines, initials = [], [], []
        for s, end, state, last, roles, texts in zip(*(b.column(c).to_pylist() for c in (
                "symbols", "end", "state", "is_last", "roles", "texts"))):
            letters, _ = Reading(np.frombuffer(s, np.uint8), tuple(end)).trace(state, last)
            written = list(repaired(letters, iter(zip(roles, texts)), state))
            audits.append(letters)
            lines.append("\n".join(written) if written else None)
            initials.append((roles[0][:1] or "?") + (roles[-1][:1] or "?") if roles else None)
        made = {"audit": audits, "lines": lines, "initials": initials}
        yield batch_of(schema, **{n: made[n] if n in made else b.column(n) for n in schema.names})


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from their sorted pieces; texts go through the digest
    and are not held."""
    schema = pa.schema(_RESULT)
    row = digest = None

    def close():
        row["gaps"] = _gaps(row.pop("least"), row.pop("most"), row.pop("turns"))
        del row["last"]
        return batch_of(schema, **{n: [{**row, "audit": "".join(row["audit"]),
                                        "repaired_sha256": digest.hexdigest()}[n]] for n in schema.names})

    for b in batches:
        for r in b.to_pylist():
            if row is None or r["conv_id"] != row["conv_id"]:
                if row is not None:
                    yield close()
                row = {"conv_id": r["conv_id"], "cost": r["cost"], "audit": [], "last": "", "least": None,
                       "most": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
                digest, empty = hashlib.sha256(), True
            for c in ("blank", "duplicate", "truncated", "illegal"):
                row[c] += r[c]
            if r["initials"]:
                row["illegal"] += bool(row["last"]) and row["last"] + r["initials"][0] not in LEGAL
                row["last"] = r["initials"][1]
            if r["least"] is not None:
                # a turn that two pieces share counts once
                row["turns"] += r["turns"] - (r["piece"] == 0 and r["least"] == row["most"])
                row["least"] = r["least"] if row["least"] is None else row["least"]
                row["most"] = r["most"]
            row["audit"].append(r["audit"])
            if r["lines"] is not None:
                digest.update((b"" if empty else b"\n") + r["lines"].encode("utf-8", "surrogatepass"))
                empty = False
    if row is not None:
        yield close()


def _clean(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(" "))


def repair(rows: DataFrame, alive: str | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id long, turn long, role,
    text): gaps among its turns, rows that are blank, duplicate or truncated
    (each row's first fault), illegal neighbours, and its cheapest repair: cost,
    audit (K keep, R rerole, D delete, I insert, in order) and
    repaired_sha256 of the repaired ``role:text`` lines.

    Rows are taken by turn, NULL first, equal turns by role and text.  NULL
    roles and texts are one space; rows with a NULL conv_id are one
    conversation; repeated rows are duplicates.  Where the column ``alive`` is
    false a row only names its conversation, which has zeros, an empty audit
    and the digest of nothing if no other row does; other columns are not read;
    empty input gives no rows.

    Only the final digest and audit of a conversation pass through one task,
    a piece at a time: SHA-256 has no parallel form.
    """
    spark = rows.sparkSession
    counted = F.lit(True) if alive is None else F.col(alive)
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        _clean("role").alias("role"), _clean("text").alias("text"), counted.alias("counted"))
    empty = plain.filter(~F.col("counted")).select("conv_id").distinct() \
        .select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("turn", "long"), ("role", "string"), ("text", "string"), ("n", "long"))])
    # copies of a row are neighbours: they travel as one row and its count
    rows = plain.filter("counted").groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = saved(rows, "conversation-rows").withColumn("mark", F.sha2(F.concat_ws(
        ":", F.length("role").cast("string"), "role", "text"), 256))
    # a repeated row's first turn; a NULL turn comes before all others
    firsts = rows.groupBy("conv_id", "mark").agg(
        F.count(F.lit(1)).alias("places"), F.min("turn").alias("first_turn"),
        F.max(F.col("turn").isNull()).alias("from_null")).filter("places > 1") \
        .select(F.col("conv_id").alias("_conv"), F.col("mark").alias("_mark"), "first_turn", "from_null")
    seen = rows.join(firsts, rows["conv_id"].eqNullSafe(firsts["_conv"]) & (rows["mark"] == firsts["_mark"]), "left")
    earlier = F.coalesce(F.col("turn").isNotNull() & (F.col("from_null") | (F.col("turn") > F.col("first_turn"))),
                         F.lit(False))
    keys = ["conv_id", "turn", "role", "text"]
    ordered = seen.select(*keys, "n", earlier.alias("earlier")) \
        .unionByName(empty.withColumn("earlier", F.lit(False))) \
        .repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    read = saved(map_arrow(ordered, _read_range, _DDL), "conversation-pieces")
    done = read.filter("part is null").select(*[n for n, _ in _RESULT])

    pieces = read.filter("part is not null")
    ends = saved(pieces.select("conv_id", "part", "piece", "vectors").groupBy("conv_id").applyInPandas(
        _chain_ends, "conv_id long, part long, piece long, end array<long>, cost long"), "conversation-ends")
    exits = map_arrow(_on(pieces.select("conv_id", "part", "piece", "symbols"), ends), _exits,
                      "conv_id long, part long, piece long, exits array<long>")
    states = saved(exits.groupBy("conv_id").applyInPandas(
        _chain_states, "conv_id long, part long, piece long, state long, is_last boolean"), "conversation-states")
    traced = map_arrow(_on(_on(pieces.drop("cost", "audit"), ends), states), _trace_pieces, _TRACED)
    joined = map_arrow(traced.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece"), _join_pieces,
                       ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _RESULT))
    return done.unionByName(joined)
