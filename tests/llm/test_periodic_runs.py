"""Runs against their definition, by brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from ledgerline.llm import periodic_runs, queries, recompression

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6, times=4):
    best = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, times * q):
                best.setdefault((s, i - s + q), q)
            i += i == s
    return sorted((s, n, q) for (s, n), q in best.items())


def random_words(rng):
    n, kinds = rng.choice([0, 1, 5, 6, 7, 30, 100, 300]), rng.choice([1, 2, 3, 5, 50])
    w = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        w = w[:a] + [w[a + i % p] for i in range(n - a)]
        if rng.random() < 0.5:
            w[rng.randrange(n)] = b"z"
    return w


def test_runs_equal_brute_force(monkeypatch):
    rng = random.Random(11)
    monkeypatch.setattr(periodic_runs, "QUERIES", 50)
    for _ in range(120):
        docs = [random_words(rng) for _ in range(rng.randint(1, 10))]
        least, times = rng.choice([(6, 4), (6, 4), (2, 2), (9, 3)])
        got = periodic_runs.runs_of(docs, least, times)
        assert [sorted(map(tuple, g.tolist())) for g in got] == [brute(d, least, times) for d in docs]
        for d, g in zip(docs, got):
            drop = {i for s, n, q in g.tolist() for i in range(s + q, s + n)}
            assert np.flatnonzero(~periodic_runs.kept_words(len(d), g)).tolist() == sorted(drop)


def test_extensions_both_ways():
    rng = np.random.default_rng(4)
    for kinds in (1, 2, 4):
        seq = rng.integers(0, kinds, 400)
        seq[200:300] = seq[50:150]
        seq = np.concatenate([[kinds], seq, [kinds + 1]])
        fixed = np.zeros(402, dtype=bool)
        fixed[[0, -1]] = True
        levels = recompression.compress(seq, fixed)
        assert len(levels[-1].symbols) == 3
        a = rng.integers(1, 400, 3000)
        b = rng.integers(1, 400, 3000)
        a, b = np.minimum(a, b), np.maximum(a, b)
        a, b = a[a < b], b[a < b]
        want = [next(k for k in range(402) if seq[x + k] != seq[y + k]) for x, y in zip(a, b)]
        assert recompression.extensions(levels, a, b).tolist() == want
        want = [next(k for k in range(402) if seq[x - k] != seq[y - k]) for x, y in zip(a, b)]
        got = recompression.extensions(recompression.mirrored(levels), 401 - b, 401 - a)
        assert got.tolist() == want


def test_long_documents():
    assert periodic_runs.runs_of([[b"a"] * 60_000])[0].tolist() == [[0, 60_000, 1]]
    w = [b"%d" % (i % 7_000) for i in range(50_000)]
    w[40_000] = b"x"
    assert periodic_runs.runs_of([w, [b"a"] * 9])[0].tolist() == [[0, 40_000, 7_000]]


def expected(doc_id, text):
    w = [x.encode() for x in WORD.findall(text or "")]
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = {i for s, k, q in runs for i in range(s + q, s + k)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha(b"".join(b"%d,%d,%d\n" % r for r in runs)),
            sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(x.decode() for x in random_words(rng)), "extra") for i in range(400)]
    rows += [(5, rows[5][1], None), (5, rows[5][1], None), (None, "a a a a a a a", "x"), (None, None, None),
             (600, None, "x"), (601, "", "x"), (602, "\t\x0b a\xa0a \n", "x"), (603, "la " * 20_000, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    out = queries.op11_periodic_runs(spark, str(tmp_path))
    assert [t for c, t in out.select(cols).dtypes] == ["bigint"] * 6 + ["string"] * 2
    got = sorted(map(tuple, out.select(cols).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t, _ in rows), key=str)
    assert sum(r[1] for r in got) > 50


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.periodic_runs(none).count() == 0
