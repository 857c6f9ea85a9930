"""The corpus pipeline's stages, each against brute force on its own input,
and the whole of it on a small corpus."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from ledgerline.llm import crf, mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def words(rng, n, most=4_000):
    return [f"w{int(i)}" for i in rng.integers(0, most, n)]


def corpus():
    rng = np.random.default_rng(21)
    bench = [" ".join(words(rng, 12)) for _ in range(4)] + ["tiny item"]
    rows, toxic = [], {}
    for i in range(240):
        w = words(rng, int(rng.integers(15, 60)))
        if i % 6 == 0:
            w[3:3] = ["scumwort", "vileness"] if i % 12 else ["hatecraft", "scumling"]
        if i % 9 == 1:
            w[5:5] = bench[i % 4].split()
        toxic[i] = int(i % 6 == 0)
        rows.append((i, " ".join(w), ["en", "de", "fr", None][i % 4], f"s{i % 3}"))
    for i in range(240, 300):                      # exact and near copies
        w = rows[i - 200][1].split() * (1 + (i % 2))
        if i % 3 == 0:
            w[-1] = "changed"
        rows.append((i, " ".join(w), "en", "s1"))
    rows += [(7, rows[7][1], "en", "s1"), (7, "another text under the same id", "en", "s1"), (300, None, "en", "s2"),
             (301, "", None, None), (None, "no id but words", "en", "s0"), (None, "no id but words", "de", "s0"),
             (None, None, "en", "s0"), (302, rows[2][1] + " tiny item", "en", "s0"), (303, "lone " * 30_000, "en", "s1")]
    return [(i, t, a, b, len(t or "")) for i, t, a, b in rows], toxic, bench


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, toxic, bench = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(f"b{i}", t) for i, t in enumerate(bench)], "item_id string, text string") \
        .write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, toxic, bench


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def collected(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def test_toxic_stage_keeps_what_the_operator_scores_low(spark, tables):
    folder, rows, toxic, _ = tables
    docs = frame(spark, rows)
    got = collected(cp.drop_toxic(spark, docs, folder))
    model = queries.toxicity_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    low = crf.score(docs, model, spans=False).filter("toxicity < 0.5")
    assert got == sorted((tuple(r[c] for c in COLUMNS) for r in low.collect()), key=str)
    unseen = [i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0]
    ids = {r[0] for r in got}
    assert all((i not in ids) == bool(toxic[i]) for i in unseen)


def shingles(text, size=5):
    w = WORD.findall((text or "").lower())
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def one_of_each_group(rows):
    """doc_ids that stay, and the texts that NULL ids leave."""
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i for i in ids if find(i) == i}


def test_near_copy_stage_equals_brute_force(spark, tables):
    folder, rows, _, _ = tables
    got = collected(cp.drop_near_copies(spark, frame(spark, rows), folder))
    ids = [r[0] for r in got if r[0] is not None]
    assert len(ids) == len(set(ids)) and set(ids) == one_of_each_group(rows)
    assert {r[0] for r in rows} - set(ids) - {None}
    assert set(got) <= set(rows)
    assert sorted(str(r[1]) for r in got if r[0] is None) == ["None", "no id but words"]


def test_benchmark_stage_leaves_no_window(spark, tables):
    folder, rows, _, bench = tables
    got = cp.cut_benchmark(spark, frame(spark, rows), folder)
    assert got.columns == COLUMNS and got.count() == len(rows)
    windows = set()
    for b in bench:
        w = ALNUM.findall(b.lower())
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))}
    kept = sorted(map(tuple, got.collect()), key=str)
    clean = {r for r in rows if not _hit(r[1], windows)}
    assert clean <= set(kept) and len(clean) < len(set(rows))
    assert all(not _hit(r[1], windows) for r in kept)


def _hit(text, windows):
    w = ALNUM.findall((text or "").lower())
    return any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))


def test_mixing_stage_is_the_operators_rows(spark, tables):
    folder, rows, _, _ = tables
    got = collected(cp.mix_sources(spark, frame(spark, rows), folder))
    want = mixing.mixed(frame(spark, rows), cp.MIX).drop("mix_epoch")
    assert got == sorted(map(tuple, want.collect()), key=str) and got and set(got) <= set(rows)


def test_token_stage_is_a_round_trip(spark, tables):
    folder, rows, _, _ = tables
    lib = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    got = sorted(cp.write_tokens(spark, frame(spark, rows), folder).collect(), key=lambda r: r.start)
    want = [(i, np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t, *_ in rows]
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == \
        sorted((i or -1, len(x), zlib.crc32(x.tobytes())) for i, x in want)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_whole_pipeline(spark, tables):
    folder, rows, toxic, _ = tables
    got = cp.run(spark, folder).collect()
    ids = {r.doc_id for r in got}
    assert got and ids <= {r[0] for r in rows}
    unseen = [i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0 and toxic[i]]
    assert unseen and not ids & set(unseen)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(str, docs.collect())) == sorted(map(str, got))


def test_empty_tables(spark, tables):
    folder = tables[0]
    none = frame(spark, [])
    for _, stage in cp.STAGES:
        assert stage(spark, none, folder).count() == 0
