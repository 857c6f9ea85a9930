"""Packing against a plain best fit, and as an exact round trip of the ids."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing, queries
from ledgerline.llm.packing import CapacityTree, Piece

WINDOW = 4096


def piece(i, n):
    return Piece(i, 0, n, np.arange(n, dtype="<u2"))


def test_capacity_tree_finds_the_tightest():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 64, 100):
        tree, held = CapacityTree(size), []
        for _ in range(600):
            if held and rng.random() < 0.4:
                c = held.pop(int(rng.integers(len(held))))
                tree.add(c, -1)
            else:
                held.append(int(rng.integers(1, size + 1)))
                tree.add(held[-1])
            need = int(rng.integers(1, size + 1))
            assert tree.tightest(need) == min((c for c in held if c >= need), default=None)


def test_best_fit_decreasing_equals_plain_search():
    rng = np.random.default_rng(2)
    for _ in range(30):
        window = int(rng.choice([16, 100, 128]))
        sizes = rng.integers(1, window + 1, int(rng.integers(0, 80))).tolist()
        room, want = [], []
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            fits = [w for w in range(len(room)) if room[w] >= sizes[k]]
            if not fits:
                room.append(window)
                want.append([])
            # of equally tight windows the one that got so tight last
            w = min(fits, key=lambda w: (room[w], -tick[w])) if fits else len(room) - 1
            room[w] -= sizes[k]
            want[w].append(k)
            tick = {**(tick if len(room) > 1 else {}), w: sum(map(len, want))}
        got = packing.best_fit_decreasing([piece(k, n) for k, n in enumerate(sizes)], window)
        assert [[p.doc_id for p in w] for w in got] == want


@pytest.mark.parametrize("tolerance", [0, 3])
def test_fill_leaves_one_window(tolerance):
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = rng.choice([5, 33, 60, 63], int(rng.integers(0, 40))).tolist()
        done, left = packing.fill(packing.best_fit_decreasing([piece(k, n) for k, n in enumerate(sizes)], 64), 64, tolerance)
        assert all(64 - tolerance <= sum(len(p.ids) for p in w) <= 64 for w in done)
        assert sum(len(p.ids) for p in left) < 64
        powers = packing.cut_at_powers(left)
        ids = defaultdict(list)
        for w in [*done, *powers]:
            for p in w:
                ids[p.doc_id].append((p.start, p.ids.tolist()))
        for k, n in enumerate(sizes):
            assert [x for _, part in sorted(ids[k]) for x in part] == list(range(n))
        lengths = [sum(len(p.ids) for p in w) for w in powers]
        assert all(n & (n - 1) == 0 for n in lengths) and lengths == sorted(set(lengths), reverse=True)


def check(rows, docs, end_id):
    """Every id in one piece, sequences without gaps, little padding."""
    lib = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    want = defaultdict(list)
    for i, t in docs:
        want[i].append([*lib.encode(t or "", add_special_tokens=False).ids, end_id])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {i for i, _ in pieces} == set(want)
    for i, texts in want.items():
        if len(texts) == 1:
            ids, own = texts[0], sorted(pieces[i, len(texts[0])], key=lambda r: r.start)
            assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
            assert sum(r.length for r in own) == len(ids)
            assert [r.ids_crc32 for r in own] == \
                [zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) for r in own]
        else:
            assert sum(r.length for n in {len(x) for x in texts} for r in pieces[i, n]) == sum(map(len, texts))
    padding = 0
    for s in sequences.values():
        s.sort()
        assert [a for a, _ in s] == [0, *np.cumsum([n for _, n in s])[:-1].tolist()]
        total = sum(n for _, n in s)
        assert 0 < total <= WINDOW
        padding += 0 if total & (total - 1) == 0 else WINDOW - total
    assert padding <= 8 * len(sequences)


def texts(n):
    rng = np.random.default_rng(7)
    return [(i, " ".join(f"{'Wort' if i % 3 else 'mot'}{int(x)}," for x in rng.integers(0, 5000, int(k))))
            for i, k in enumerate(rng.choice([1, 3, 40, 150, 900], n, p=[.2, .2, .3, .2, .1]))]


def test_query_is_a_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "BUFFER_TOKENS", 30_000)
    docs = texts(500) + [(900, None), (901, ""), (902, "long text " * 30_000), (None, "a b c")]
    rows = [(i, t, "x") for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, pieces string").repartition(7) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_packing(spark, str(tmp_path))
    assert {t for _, t in out.dtypes} == {"bigint"}
    check(out.collect(), docs, 2)


def test_rounds_until_one_task(spark, monkeypatch):
    """Many tasks that each leave something, and buffers of a few windows."""
    monkeypatch.setattr(packing, "BUFFER_TOKENS", 9_000)
    docs = texts(200) + [(5, "same"), (5, "same"), (5, "same")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    check(packing.piece_rows(packing.pack(df, queries.tokenizer_file("word_bpe_49k.json"), end_id=2)).collect(), docs, 2)


def test_empty_table_and_bad_window(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.piece_rows(packing.pack(none, queries.tokenizer_file("word_bpe_49k.json"), 2)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(none, queries.tokenizer_file("word_bpe_49k.json"), 2, window=1000)
