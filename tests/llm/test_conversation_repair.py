"""Conversation repair against an exhaustive search over edits."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import conversation_repair as cr
from ledgerline.llm import queries

CORE = "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """rows: (turn, role, text) in order; results but for the id."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen
                      else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.lru_cache(None)
    def best(i, last, inserted):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserted < 3:
            for r in set(follow[last]) & {"u", "a"}:
                c, s, out = best(i, r, inserted + 1)
                ways.append((c + 5, "I" + s, ({"u": "user", "a": "assistant"}[r] + ":", *out)))
        if i < len(rows):
            _, role, text = rows[i]
            c, s, out = best(i + 1, last, 0)
            ways.append((c + 2, "D" + s, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 * (faults[i] == "truncated")
                if role[:1] and role[:1] in follow[last]:
                    c, s, out = best(i + 1, role[:1], 0)
                    ways.append((c + extra, "K" + s, (f"{role}:{text}", *out)))
                for r in set(follow[last]) & {"u", "a"}:
                    c, s, out = best(i + 1, r, 0)
                    new = {"u": "user", "a": "assistant"}[r]
                    ways.append((c + 1 + extra, "R" + s, (f"{new}:{text}", *out)))
        return min(ways, default=(10**9, "", ()))

    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, lines = best(0, "", 0)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        own = convs[conv]
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        if k:
            own.extend([(turn, role, text)] * (2 if k == 3 else 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return sorted(((c, *brute(tuple(sorted(rows, key=order)))) for c, rows in convs.items()), key=str)


def random_table(rng, convs, rows):
    out = []
    for c in range(convs):
        turn = rng.randrange(5)
        for _ in range(rng.randint(1, rows)):
            out.append((c, rng.choice([turn, turn, turn, None]) if c % 7 == 0 else turn,
                        rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                        rng.choice(["Yes.", "No!", "and then", " ", "", None, f"t{rng.randrange(9)}. \n", "é?\xa0"])))
            turn += rng.choice([0, 1, 1, 1, 3])
    return out


def run(spark, table):
    out = cr.repair(queries.damaged(spark.createDataFrame(table, SCHEMA)), alive="alive").select(*CORE)
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"] * 2
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("block", [1, 2, 4])
def test_reading_and_trace_equal_search(block):
    t, rng = cr.Tables(block), random.Random(block)
    assert len(t.vectors) < 500
    for _ in range(400):
        rows = [(k, rng.choice(["system", "user", "assistant", "tool"]), rng.choice([f"x{k}.", f"y{k}", ""]))
                for k in range(rng.randint(0, 9))]
        symbols = np.array([cr.symbol(r, cr.fault(x, False)) for _, r, x in rows], dtype=np.int64)
        way = cr.Reading(symbols, cr.END, t)
        want = brute(tuple(rows))
        assert (way.costs[cr.NONE], way.trace(cr.NONE, True)[0]) == (want[5], want[6])


def test_query_equals_brute_force(spark, tmp_path):
    table = random_table(random.Random(1), 300, 9)
    table += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho"), (900, None, None, None)]
    assert any(zlib.crc32(f"{c}:0".encode()) % 20 == 0 for c in range(1000, 1050))
    table += [(c, 0, "user", "Lost?") for c in range(1000, 1050)]
    df = spark.createDataFrame([(*r, "x") for r in table], SCHEMA + ", symbols string")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    out = queries.op13_conversation_repair(spark, str(tmp_path)).select(*CORE)
    assert sorted(map(tuple, out.collect()), key=str) == expected(table)


def test_conversations_in_pieces(spark, monkeypatch):
    """One conversation with most of the rows, over many tasks and pieces."""
    monkeypatch.setattr(cr, "PIECE_ROWS", 5)
    rng = random.Random(3)
    table = [(77, *r[1:]) for r in random_table(rng, 25, 7)] + random_table(rng, 20, 6)
    table = [(c, (i // 2 if c == 77 else t), r, x) for i, (c, t, r, x) in enumerate(table)]
    assert run(spark, table) == expected(table)


def test_long_text_and_many_copies(spark):
    table = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", "ok.")] + [(2, 5, "user", "same.")] * 60
    got = {r[0]: r for r in run(spark, table)}
    assert [got[1]] + [got[2]] == expected(table)


def test_empty_table(spark):
    assert run(spark, []) == []
