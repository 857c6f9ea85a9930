"""The operators on small hand-made tables: brute force, round trips, edges."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import (
    common,
    components,
    crf,
    decontaminate,
    fm_index,
    jaccard_join,
    katz,
    language_id,
    mixing,
    queries,
    token_counts,
    token_files,
    topk,
    warc,
)
from ledgerline.llm.common import held_out

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(rng, n, vocabulary=400):
    return [f"w{int(i)}" for i in rng.integers(0, vocabulary, n)]


def near_copies(rng, groups, copies, length):
    out = []
    for _ in range(groups):
        base = words(rng, length, 5_000)
        for c in range(copies):
            w = list(base)
            for at in rng.integers(0, length, c % 4):
                w[at] = f"x{int(rng.integers(0, 5_000))}"
            out.append(" ".join(w))
    return out


def shingle_sets(docs, size):
    out = {}
    for i, t in docs:
        w = WORD.findall((t or "").lower())
        out[i] = {tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
    return out


def linked_components(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("size,percent,local", [(4, 85, 4_000_000), (5, 80, 4_000_000), (4, 85, 1_000)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, size, percent, local):
    """With ``local`` = 1,000 the clusters are divided by pivots."""
    monkeypatch.setattr(jaccard_join, "LOCAL_SHINGLES", local)
    rng = np.random.default_rng(3)
    texts = near_copies(rng, 3, 30, 60) + [" ".join(words(rng, 30)) for _ in range(30)]
    texts += [None, "", " \t\n", "one", "ONE", "two words", "a b c d " * 200, "A b c d " * 200]
    docs = list(enumerate(texts))
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(spark.createDataFrame(docs, DOCS), size, percent).collect()}
    sets = shingle_sets(docs, size)
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == linked_components(sets, percent)


@pytest.mark.parametrize("percent", [60, 80, 85, 100])
def test_voronoi_classes_equal_all_pairs(percent):
    """Chains of sets around the radius, groups of copies, sets with a common
    core at every distance, and sets that share nothing."""
    rng = np.random.default_rng(percent)

    def classes_by_pairs(sets):
        docs = {i: set(s.tolist()) for i, s in enumerate(sets)}
        return list(linked_components(docs, percent).values())

    for round_ in range(12):
        sets, core = [], rng.integers(0, 1 << 60, 60)
        for _ in range(rng.integers(1, 5)):
            own = rng.integers(0, 1 << 60, rng.integers(1, 80))
            for _ in range(rng.integers(1, 40)):
                own = np.where(rng.random(len(own)) < rng.choice([0.02, 0.1]), rng.integers(0, 1 << 60, len(own)), own)
                sets.append(own)
        sets += [np.concatenate([core[:rng.integers(1, 60)], rng.integers(0, 1 << 60, rng.integers(0, 40))])
                 for _ in range(rng.integers(0, 60))]
        sets = [np.unique(x.astype(np.uint64)) for x in sets]
        rng.shuffle(sets)
        assert jaccard_join.voronoi_classes(sets, percent).tolist() == classes_by_pairs(sets)


def test_groups_of_copies_are_joined_by_pivots_alone(monkeypatch):
    def refuse(*_):
        raise AssertionError("pivots divide these sets")

    monkeypatch.setattr(jaccard_join, "link_region", refuse)
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        own = rng.integers(0, 1 << 60, 200)
        sets += [np.unique(np.where(rng.random(200) < 0.01, rng.integers(0, 1 << 60, 200), own).astype(np.uint64))
                 for _ in range(30)]
    got = jaccard_join.voronoi_classes(sets, 85)
    assert got.tolist() == [i // 30 * 30 for i in range(360)]


def test_jaccard_blocks_bring_every_possible_link_together(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LOCAL_SHINGLES", 600)
    rng = np.random.default_rng(12)
    sizes = [int(x) for x in np.concatenate([rng.integers(1, 400, 120), np.full(80, 50)])]
    rows = [("r", i, np.arange(n, dtype="<u8").tobytes()) for i, n in enumerate(sizes)]
    regions = spark.createDataFrame(rows, "region string, node long, shingles binary")
    got = [r for pairs in jaccard_join._in_block_pairs(regions, regions.select("region").distinct(), 80)
           for r in pairs.collect()]
    held = {}
    for r in got:
        held.setdefault(r.region, set()).add(r.node)
    for a, b in itertools.combinations(range(len(sizes)), 2):
        if 100 * min(sizes[a], sizes[b]) >= 80 * max(sizes[a], sizes[b]):
            assert any(a in h and b in h for h in held.values())
    blocks = sum(sizes) / 300
    assert len(got) < 0.6 * blocks * len(sizes) and len(set(r.node for r in got)) == len(sizes)


def test_jaccard_join_edges(spark):
    rows = [(5, "a b c d e f"), (5, "p q r s t u"), (7, "p q r s t u"), (9, "a b c d e f"), (None, "a b c d e f")]
    got = sorted((r.doc_id or -1, r.component_id) for r in
                 jaccard_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(-1, None), (5, 5), (5, 5), (7, 5), (9, 5)]
    assert jaccard_join.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0
    extra = spark.createDataFrame([(1, "a b c d e", 3, "x"), (2, "a b c d e", 4, "y")],
                                  DOCS + ", n long, component string")
    assert [tuple(r) for r in jaccard_join.keep_one_per_component(extra).collect()] == [(1, "a b c d e", 3, "x")]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}


def test_component_rounds_are_small_plans(spark):
    """A round reads its edges four times, not once for each direction of each
    use: what the driver plans, ships and keeps follows that."""
    edges = spark.createDataFrame([(2, 1), (3, 2), (9, 8), (9, 3)], "a long, b long")
    out = components._small_star(components._large_star(edges))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 4
    assert sorted(tuple(r) for r in out.collect()) == [(2, 1), (3, 1), (8, 2), (9, 2)]


def test_components_of_random_links(spark):
    rng = np.random.default_rng(12)
    for nodes, links in ((3, 2), (40, 25), (40, 60), (300, 280)):
        edges = rng.integers(0, nodes, (links, 2)).tolist()
        want: dict = {}
        for a, b in (e for e in edges if e[0] != e[1]):
            one = want.setdefault(a, {a}) | want.setdefault(b, {b})
            want |= dict.fromkeys(one, one)
        rows = components.components(spark.createDataFrame([*edges, (None, 1), (2, None)], "a long, b long")).collect()
        assert {r.node: r.component for r in rows} == {i: min(c) for i, c in want.items()} and len(rows) == len(want)


def test_driver_memory_goes_back(spark, monkeypatch):
    """Before and between the rounds of components; a JVM that can't trim its
    C heap does no harm."""
    given, real = [], common.give_back_memory
    monkeypatch.setattr(common, "give_back_memory", lambda: given.append(1) or real())
    common.give_back_driver_memory(spark)
    assert len(given) == 1
    rounds = components.components(spark.createDataFrame([(i, i + 1) for i in range(8)], "a long, b long"))
    assert rounds.count() == 9 and len(given) > 3


def test_warc_round_trip(spark):
    html = ["<p>one</p>", None, "", "<p>one</p>", "é\r\n\r\nbody", "x" * 300_000, "<p>one</p>"]
    rows = [(i, None if i == 4 else f"http://h/{i} a", h, "clash") for i, h in enumerate(html)] + [(None, "u", "solo", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in warc.warc_round_trip(pages).collect()}
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        p = (h or "").encode()
        assert got[i].payload_bytes == len(p)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(p).digest()).decode()
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {0: 6, 3: 6, 1: 2}
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_warc_payloads_come_back_and_damage_is_found(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 50) for i in range(40)],
                                  "page_id long, url string, html string").coalesce(1)
    folder, manifest = warc.write_archives(pages)
    back = warc.read_archives(spark, folder).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in back} == {i: f"page {i} " * 50 for i in range(40)}
    assert sum(r.n_records for r in manifest.collect()) == 40
    record = warc.build_record(1, "u", b"body", warc.sha1_base32(b"body"), None, False, "2024-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"body"
    for broken in (record[:-1], record.replace(b"WARC/1.1", b"WARC/9.9"), record.replace(b"\r\n\r\nbody", b"\r\n\r\nBODY"),
                   record.replace(b"WARC-Type", b"WARC-Kind")):
        with pytest.raises(warc.WarcError):
            warc.parse_record(broken)


def toxic_corpus(rng, n):
    out = []
    for i in range(n):
        w = words(rng, int(rng.integers(20, 80)))
        y = i % 3 == 0
        if y:
            for at in rng.integers(0, len(w), 3):
                w[at] = ["scumwort", "vilebane", "hatefulish"][int(at) % 3]
        out.append((i, " ".join(w), int(y)))
    return out


def test_toxicity_tells_held_out_documents_apart(spark):
    rows = toxic_corpus(np.random.default_rng(5), 300)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], 0, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    model = queries.toxicity_model(docs, labels)
    got = crf.score(docs, model).withColumn("out", held_out("doc_id", 5, 0)).collect()
    unseen = [(r.toxicity >= 0.5) == bool(rows[r.doc_id][2]) for r in got if r.out]
    assert len(unseen) > 30 and np.mean(unseen) > 0.95
    text = {r[0]: r[1] for r in rows}
    found = Counter(text[r.doc_id][s.start:s.end].split()[0][:4] for r in got for s in r.toxic_spans)
    assert sum(found[k] for k in ("scum", "vile", "hate")) > 0.9 * sum(found.values())


def test_toxicity_evidence_is_no_chance(spark):
    """Words that few toxic documents hold by luck are no evidence."""
    rng = np.random.default_rng(15)
    rows = [(" ".join(words(rng, 60, 5_000) + ["scumwort"] * (i < 15)), int(i < 30)) for i in range(90)]
    sample = spark.createDataFrame(rows, "text string, y int")
    got = crf._evidence(sample, {1: 30, 0: 60}, crf.TrainingBounds())
    assert set(got) == {b"wscumwort", b"4scum", b"5scumw", b"6scumwo"}


def test_toxicity_clean_windows_cover_every_token(spark):
    text = " ".join(f"c{i}" for i in range(50))
    sample = spark.createDataFrame([(text, 0), ("short one", 0), ("", 0)], "text string, y int")
    slots, tags, length, y = crf._windows(sample, [], crf.TrainingBounds())
    own = Counter(int(w[j, 0]) for w, n in zip(slots, length) for j in range(n))
    assert own == Counter(crf.slots_of(t.encode())[0][0] for t in text.split() + ["short", "one"])
    assert not tags.any() and not y.any()


def test_toxicity_marginals_equal_enumerated_paths():
    rng = np.random.default_rng(8)
    tr = rng.normal(0, 1, (2, 2))
    tagger = crf.Tagger(np.zeros((1 << crf.HASH_BITS) + 2), tr)
    chains = [rng.normal(0, 2, n) for n in (1, 2, 5, 8, 8)]

    def by_hand(e):
        p, z = np.zeros(len(e)), 0.0
        for path in itertools.product((0, 1), repeat=len(e)):
            s = np.exp(sum(e[i] for i, y in enumerate(path) if y)
                       + sum(tr[a, b] for a, b in zip(path, path[1:])))
            p, z = p + s * np.array(path), z + s
        return p / z

    for e, p in zip(chains, tagger.marginals(chains)):
        assert np.allclose(p, by_hand(e))
    width = max(map(len, chains))
    padded = np.array([np.pad(e, (0, width - len(e))) for e in chains])
    live = np.arange(width) < np.array([len(e) for e in chains])[:, None]
    one, _ = crf._posteriors(padded, tr, live)
    for e, p in zip(chains, one):
        assert np.allclose(p[:len(e)], by_hand(e))


def test_toxicity_never_reads_held_out_labels(spark):
    rows = toxic_corpus(np.random.default_rng(9), 120)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    out = [zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows]
    scores = []
    for flip in (False, True):
        labels = [(r[0], 1 if flip and o else r[2]) for r, o in zip(rows, out)]
        model = queries.toxicity_model(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scores.append(sorted((r.doc_id, r.toxicity) for r in crf.score(docs, model, spans=False).collect()))
    assert sum(out) > 10 and scores[0] == scores[1]


def test_toxicity_long_text_needs_little_memory():
    import tracemalloc
    tagger = crf.Tagger(np.zeros((1 << crf.HASH_BITS) + 2), np.zeros((2, 2)))
    texts = ["ab cd ef gh ij " * 40_000] + ["x y"] * 255
    tracemalloc.start()
    got = [len(p) for g in crf._token_groups(texts) for p in tagger.marginals(tagger.emissions(g))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [200_000] + [2] * 255
    assert peak < 60e6


def test_toxicity_edges(spark):
    rows = toxic_corpus(np.random.default_rng(6), 60)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = crf.train(docs, labels)
    odd = spark.createDataFrame([(1, None, "k"), (2, "", None), (None, "w1 " * 100_000, "k"), (2, "", None)],
                                DOCS + ", toxicity string")
    got = crf.score(odd, model, spans=False)
    assert got.columns == ["doc_id", "text", "toxicity"]
    low = [r.toxicity for r in got.collect()]
    assert len(low) == 4 and all(0 <= x < 0.5 for x in low)
    assert crf.score(odd.limit(0), model).count() == 0
    flat = crf.train(docs, labels.filter("toxic = 0"))
    assert crf.score(docs, flat).filter("toxicity >= 0.5").count() == 0


@pytest.mark.parametrize("block,query_block", [(16_384, 2_048), (37, 2_048), (7, 4)])
def test_top_k_equals_brute_force(spark, block, query_block):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 6))
    x[3] = x[7] = x[11]                                     # ties
    x[20] = 0
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [1.0] * 6)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=10, every=10, block_vectors=block,
                     query_block=query_block)
    m = np.floor(1024 * x).astype(np.int64)
    want = []
    for q in range(0, 150, 10):
        s = m @ m[q]
        best = [j for j in np.lexsort((np.arange(150), -s)) if j != q][:10]
        want += [(q, n + 1, int(j), int(s[j])) for n, j in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_top_k_edges(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(few).collect()]
    assert got == [(0, 1, 1, 1024 * 3072 - 2048 * 1024)]
    assert topk.top_k(few.limit(0)).count() == 0
    rows = [(0, [1.0, 2.0, 4.0], "a"), (1, [1.0], "b"), (1, [1.0], "c"), (2, [], "d"), (3, [0.0, 3.0], "e")]
    odd = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = [tuple(r) for r in topk.top_k(odd.withColumn("score", F.lit(7))).collect()]
    one = 1024 * 1024
    assert got == [(0, 1, 3, 6 * one), (0, 2, 1, one), (0, 3, 1, one), (0, 4, 2, 0)]


def test_top_k_wide_products(spark):
    """Products past 64 bits that cancel are exact; a score past them raises."""
    big = 3.0e9
    rows = [(0, [big, big, 1.0]), (1, [big, -big, 2.0]), (2, [-big, big, 5.0]), (3, [0.0, 0.0, 3.0])]
    cancel = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(cancel).collect()]
    assert got == [(0, 1, 2, 5 << 20), (0, 2, 3, 3 << 20), (0, 3, 1, 2 << 20)]
    for wide in ([(0, [big]), (1, [big])], [(0, [1.0e17]), (1, [1.0])]):
        with pytest.raises(Exception):
            topk.top_k(spark.createDataFrame(wide, "vec_id long, embedding array<double>")).collect()


MIX = mixing.Mix(weights={"domain": {"web": 30}, "lang": {"en": 50}}, domains={"0": "web"})


def test_mixing_budget_and_epochs(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(words(rng, int(rng.integers(1, 60)))), ["en", "de", None][i % 3], f"s{i % 4}" if i % 7 else None, 1)
            for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string, source string, domain int")
    got = mixing.mixed(docs, MIX).collect()
    total = sum(len(r[1].split()) for r in rows)
    taken = sum(len(r.text.split()) for r in got)
    assert 0.7 * total < taken <= 0.8 * total
    assert max(Counter(r.doc_id for r in got).values()) <= MIX.max_epochs
    assert got and set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "domain", "mix_epoch"}
    clash = mixing.mixed(docs.withColumn("mix_epoch", F.lit("mine")), MIX)
    assert clash.columns == ["doc_id", "text", "lang", "source", "domain", "mix_epoch"] and clash.count() == len(got)
    again = mixing.mixed(docs.repartition(7), MIX).collect()
    assert sorted((r.doc_id, r.mix_epoch) for r in got) == sorted((r.doc_id, r.mix_epoch) for r in again)


def test_mixing_edges(spark):
    schema = DOCS + ", lang string, source string"
    assert mixing.mixed(spark.createDataFrame([], schema), MIX).count() == 0
    empty = spark.createDataFrame([(1, None, "en", "s0"), (2, "", None, None)], schema)
    assert mixing.mixed(empty, MIX).count() == 0
    ties = spark.createDataFrame([(1, "a b", "en", "s0")] * 4 + [(None, "a b", "en", "s0")], schema)
    assert mixing.mixed(ties, mixing.Mix(budget_permille=1000)).count() in (1, 4, 5)


def test_mixing_shares_shortages_among_siblings_first(spark):
    nodes = spark.createDataFrame([("p", "a", 10, 100), ("p", "b", 500, 100), ("p", "c", 500, 100), ("q", "a", 5, 50)],
                                  "domain string, lang string, cap long, budget long")
    got = {(r.domain, r.lang): r.grant for r in
           mixing.share_out(nodes, ["domain"], "lang", "budget", mixing.Mix()).collect()}
    assert got == {("p", "a"): 10, ("p", "b"): 45, ("p", "c"): 45, ("q", "a"): 5}


def test_language_id_on_held_out_texts(spark):
    rng = np.random.default_rng(4)
    stems = {"en": ["the", "with", "thing", "which"], "de": ["der", "schön", "nicht", "über"],
             "fr": ["être", "avec", "pour", "qu'il"], "es": ["año", "está", "pero", "donde"], "it": ["gli", "della", "perché", "anche"],
             "nl": ["het", "zijn", "naar", "ook"], "pl": ["się", "jest", "który", "przez"], "pt": ["não", "também", "você", "são"]}
    rows = [(i, " ".join(rng.choice(stems[k], 25)), k) for i in range(400) for k in [sorted(stems)[i % 8]]]
    docs = spark.createDataFrame(rows, DOCS + ", lang string")
    model = language_id.train(docs.filter(~held_out("doc_id", 4, 2)))
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert np.mean([got[i].lang_pred == k for i, _, k in rows if zlib.crc32(str(i).encode()) % 4 == 2]) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (None, "nicht über " * 50_000)], DOCS)
    answers = {r.doc_id: r.lang_pred for r in language_id.predict(odd, model).collect()}
    assert answers == {1: "und", 2: "und", 3: "und", None: "de"}
    assert language_id.predict(odd.limit(0), model).count() == 0
    blank = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, blank).collect()} == {"und"}


def test_katz_counts_and_base(spark):
    rng = np.random.default_rng(8)
    rows = [(i, None if i == 5 else " ".join(words(rng, int(rng.integers(0, 50)), 60))) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)
    tokens = {i: WORD.findall((t or "").lower()) + ["\n"] for i, t in rows}
    out = {i for i in tokens if zlib.crc32(str(i).encode()) % 7 == 2}
    count = Counter(w for i, t in tokens.items() if i not in out for w in t)
    total = sum(count.values())
    got = {r.doc_id: r for r in katz.katz_scores(docs, held_out("doc_id", 7, 2)).collect()}
    assert set(got) == set(tokens)
    for i, t in tokens.items():
        base = sum(np.log10((count[w] + 1) / (total + len(count) + 1)) for w in t)
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == \
            (i in out, len(t), sum(count[w] > 0 for w in t), total)
        assert got[i].base_score == pytest.approx(base)
        assert got[i].score < 0


def test_katz_probabilities_sum_to_one(spark):
    """Every history's probabilities over the vocabulary and the unknown word,
    found from the scores of two-word texts."""
    train = ["a b a b c", "a c b a", "b b a", "c a b d", "a b"] * 3
    vocabulary = ["a", "b", "c", "d", "unseen"]
    ends = [v for v in vocabulary]
    rows = [(i, t) for i, t in enumerate(train)]
    probes = {(h, w): 1_000 + n for n, (h, w) in enumerate(itertools.product(vocabulary[:3], ends))}
    singles = {h: 2_000 + n for n, h in enumerate(vocabulary[:3])}
    all_rows = rows + [(i, f"{h} {w}") for (h, w), i in probes.items()] + [(i, h) for h, i in singles.items()]
    from pyspark.sql import functions as F
    got = {r.doc_id: r.score for r in
           katz.katz_scores(spark.createDataFrame(all_rows, DOCS), F.col("doc_id") >= 1_000).collect()}
    assert all(np.isfinite(v) and v < 0 for v in got.values())
    # a seen continuation is likelier than one never seen
    assert got[probes["a", "b"]] > got[probes["a", "unseen"]]


def katz_by_hand(texts, trained):
    """log10 scores from dictionaries of every word and every pair."""
    tokens = {i: WORD.findall((t or "").lower()) + ["\n"] for i, t in texts}
    one, two, hist = Counter(), Counter(), Counter()
    for i in trained:
        for h, w in zip([None, *tokens[i]], tokens[i]):
            one[w] += 1
            two[h, w] += 1
            hist[h] += 1
    n_r = [np.array([sum(v == r for v in c.values()) for r in range(7)], float) for c in (one, two)]
    d1, d2 = katz.discounts(n_r[0]), katz.discounts(n_r[1])
    total = sum(one.values())
    p1 = {w: c * (d1[c] if c <= 5 else 1) / (total + 1) for w, c in one.items()}
    unknown = 1 - sum(p1.values())
    p2 = {(h, w): c * (d2[c] if c <= 5 else 1) / (hist[h] + 1) for (h, w), c in two.items()}
    left, below = Counter(), Counter()
    for (h, w), v in p2.items():
        left[h] += v
        below[h] += p1[w]
    return {i: sum(np.log10(p2[h, w] if (h, w) in p2 else (1 - left[h]) / (1 - below[h]) * p1.get(w, unknown))
                   for h, w in zip([None, *t], t)) for i, t in tokens.items()}


@pytest.mark.parametrize("head", [0, 3, 65_000])
def test_katz_counts_every_pair(spark, head):
    """Rare words and pairs count whatever the head holds."""
    rng = np.random.default_rng(18)
    rows = [(i, " ".join(f"w{int(v)}" for v in rng.zipf(1.4, int(rng.integers(0, 60))) % 3_000)) for i in range(200)]
    rows += [(200, None), (201, "w1 never1 never2 w1")]
    out = {i for i, _ in rows if i == 201 or zlib.crc32(str(i).encode()) % 7 == 2}
    want = katz_by_hand(rows, [i for i, _ in rows if i not in out])
    from pyspark.sql import functions as F
    held = held_out("doc_id", 7, 2) | (F.col("doc_id") == 201)
    got = {r.doc_id: r.score for r in katz.katz_scores(spark.createDataFrame(rows, DOCS), held, head).collect()}
    assert got == pytest.approx(want)


def test_katz_edges(spark):
    assert katz.katz_scores(spark.createDataFrame([], DOCS), held_out("doc_id", 7, 2)).count() == 0
    odd = spark.createDataFrame([(1, "x " * 100_000), (1, "x " * 100_000), (None, None), (3, "")], DOCS)
    assert katz.katz_scores(odd, held_out("doc_id", 7, 2)).count() == 4


def test_decontamination_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    items = [(i, " ".join(words(rng, n, 30))) for i, n in enumerate([25, 12, 10, 4, 1, 40])] + [(8, None), (9, "?!"), (None, "lonely word")]
    held = [items[0][1], items[1][1].upper().replace(" ", "--"), items[3][1], items[5][1]]
    rows = []
    for i in range(80):
        w = words(rng, int(rng.integers(0, 60)), 2_000)
        if i % 3 == 0:
            w[len(w) // 2:len(w) // 2] = [held[i % 4]]
        rows.append((i, " ".join(w)))
    rows += [(100, None), (101, ""), (102, "a lonely word"), (103, held[0] + " " + held[0])]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = ALNUM.findall((t or "").lower())
        for j in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[j:j + 10]), set()).update(set() if i is None else {str(i)})
    want = {}
    for i, t in rows:
        w, hit, found = ALNUM.findall((t or "").lower()), set(), set()
        for p, o in windows.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j:j + len(p)]) == p:
                    hit |= set(range(j, j + len(p)))
                    found |= o
        want[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    for size in (4_000_000, 200):                            # one block of items, several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = {r.doc_id: tuple(r)[1:] for r in decontaminate.report(docs, bench).collect()}
        assert got == want


def test_decontamination_cut(spark):
    phrase = "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10"
    bench = spark.createDataFrame([(1, phrase)], "item_id long, text string")
    rows = [(1, f"Before, {phrase}! after", "en", 9), (2, phrase, "en", 9), (3, "Clean  text.", None, 9), (4, None, "en", None)]
    docs = spark.createDataFrame(rows, DOCS + ", hit_spans string, n_chars long")
    got = {r.doc_id: r for r in decontaminate.cut(docs, bench).collect()}
    assert set(got) == {1, 3, 4} and got[1].text == "Before, \n! after" and got[1].n_chars == len(got[1].text)
    assert tuple(got[3]) == rows[2] and tuple(got[4]) == rows[3]
    assert decontaminate.cut(docs, bench.limit(0)).count() == 4
    assert decontaminate.cut(docs.limit(0), bench).count() == 0


def test_decontamination_cuts_where_it_marks(spark, monkeypatch):
    """The spans are cut in the task that finds them, so a task has one Python
    worker and the texts go there once, with one block of items and several."""
    rng = np.random.default_rng(4)
    items = [(i, " ".join(words(rng, 12, 40))) for i in range(6)]
    rows = [(i, " ".join(words(rng, 9, 2_000)) + "\n" + items[i % 6][1] + "\nend.", "en") for i in range(20)]
    rows += [(50, items[0][1], "en"), (51, items[1][1] + "!?", None), (52, None, "en"), (52, None, "en"), (None, "", None)]
    docs, bench = spark.createDataFrame(rows, DOCS + ", lang string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted([(i, t.replace(items[i % 6][1], "\n"), g) for i, t, g in rows[:20]] + rows[22:], key=str)
    for size in (4_000_000, 200):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = decontaminate.cut(docs, bench)
        assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_decontamination_shard_in_bounded_memory():
    """A shard's work takes a few bytes a word beside its ids."""
    docs = [np.zeros(1_000, dtype=np.int32) for _ in range(200)]
    docs[7][100:112] = range(1, 13)
    phrases = decontaminate.Phrases([("a", " ".join(f"w{i}" for i in range(12)))], 10)
    tracemalloc.start()
    try:
        spans, items = decontaminate._search_shard(phrases, docs, [])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert spans[7] == [{"start": 100, "end": 112}] and items[7] == ["a"] and not any(spans[:7] + spans[8:])
    assert peak < 24 * 200_000


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(0)
    text = np.concatenate([[0], rng.integers(0, 5, 600)])
    index = fm_index.FMIndex(text, 5)
    patterns = rng.integers(1, 5, (60, 3))
    lo, hi = index.search(patterns, np.full(60, 3))
    for p, a, b in zip(patterns, lo, hi):
        want = [i for i in range(len(text) - 2) if (text[i:i + 3] == p).all()]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


TEXTS = ["Hello world", None, "", "the <|endoftext|> end", "ünïcode 漢字 " * 40, "word " * 30_000, "Hello world", "x" * 20_000]


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer_file("word_bpe_49k.json")
    rows = [(i * 3, t, "clash") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, DOCS + ", start string").repartition(3)
    got = {r.doc_id: r for r in token_files.token_output(docs, path, end_id=1).collect()}
    encoder, at = Tokenizer.from_file(path), 0
    for i, t, _ in rows:
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.token_output(docs.limit(0), path, end_id=1).count() == 0


def test_token_counts_and_cache(spark, tmpdir_fresh):
    from tokenizers import Tokenizer
    path = queries.tokenizer_file("byte_bpe_50k.json")
    encoder = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "Hello world"), (0, "Hello world")]
    docs, cache = spark.createDataFrame(rows, DOCS), tmpdir_fresh + "/cache"
    want = sorted((-1 if i is None else i, len((t or "").encode()), len(encoder.encode(t or "", add_special_tokens=False).ids))
                  for i, t in rows)
    for _ in range(2):
        got = token_counts.token_counts(docs, path, cache).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
        stored = token_counts.open_cache(spark, cache).count()
    assert stored == len({t or "" for t in TEXTS})
    assert token_counts.token_counts(docs.limit(0), path).count() == 0



def test_katz_deals_by_bucket_and_keeps_no_word_table(spark):
    """Keys, occurrences and documents of a bucket in their order; the words'
    counts are deleted once the pairs hold them."""
    from ledgerline.llm import katz
    from ledgerline.session import checkpoint_dir
    rnd = np.random.default_rng(5)
    for n, buckets in ((0, 3), (1, 3), (500, 7), (500, 70_000)):
        at, times = rnd.integers(0, buckets, n), rnd.integers(1, 4, n)
        doc = rnd.integers(0, 9, int(times.sum())).astype("<u2")
        of_doc = np.repeat(at, times)
        got = list(katz._split(at, times, doc))
        assert [x[0] for x in got] == sorted(set(at.tolist()))
        for k, own, n_x, d in got:
            assert own.tolist() == np.flatnonzero(at == k).tolist() and n_x.tolist() == times[at == k].tolist()
            assert d.tolist() == doc[of_doc == k].tolist() and d.dtype == doc.dtype
        assert [(k, x.tolist()) for k, (x,) in katz._parts(at, times)] == [(k, times[at == k].tolist()) for k, *_ in got]
    left = f"{checkpoint_dir(spark)}/ledgerline/katz-words-*"
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(left)
    files = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None)], "doc_id long, text string")
    assert katz.katz_scores(docs, F.col("doc_id") == 2).count() == 3
    assert len(files.globStatus(fs)) == 0


def test_jaccard_codes_are_those_of_unique():
    from ledgerline.llm.jaccard_join import _codes
    rnd = np.random.default_rng(6)
    sets = [np.unique(rnd.integers(0, 60, n).astype(np.uint64) << np.uint64(57)) for n in (1, 9, 40, 3)]
    values, want = np.unique(np.concatenate(sets), return_inverse=True)
    code, n = _codes(sets)
    assert code.tolist() == want.tolist() and n == len(values) and code.dtype == np.int32


@pytest.mark.parametrize("percent", [70, 85, 100])
def test_sets_with_common_shingles_alone_leave_a_large_cluster(spark, percent):
    """Regions by rare shingles keep every link and part sets that share only
    what most of the cluster holds."""
    rng = np.random.default_rng(percent)
    common, rows = rng.integers(0, 1 << 60, 30, dtype=np.uint64), []
    for i in range(60):
        own = rng.integers(0, 1 << 60, 12 + i % 5, dtype=np.uint64)
        for c in range(1 + (i % 3 == 0) * 4):
            s = own.copy()
            s[:c % 4] = rng.integers(0, 1 << 60, c % 4, dtype=np.uint64)
            rows.append((f"r{i % 2}", len(rows), np.unique(np.concatenate([common[:20 + i % 11], s]))))
    rows += [("r1", 7, rows[3][2]), ("r0", len(rows), rows[0][2])]          # a node of two rows; one set in both regions
    members = spark.createDataFrame([(r, n, s.tobytes()) for r, n, s in rows], "region string, node long, shingles binary")
    got = {}
    for r in jaccard_join.rare_shingle_regions(members.repartition(5), percent).collect():
        got.setdefault(r.node, set()).add(r.region)
    for (r, a, x), (q, b, y) in itertools.combinations(rows, 2):
        common_n = len(np.intersect1d(x, y))
        if a != b and r == q and 100 * common_n >= percent * (len(x) + len(y) - common_n):
            assert got[a] == got[b] and len(got[a]) == 1
    if percent > 70:                    # the common part is up to two thirds of a set
        assert max(Counter(r for rs in got.values() for r in rs).values()) < 20


def test_undivided_cluster_is_parted_before_blocks_are_paired(spark, monkeypatch):
    """Sets that share a template but no link: pivot sets do not divide them,
    their rarest shingles do, and no pairs of blocks are joined."""
    monkeypatch.setattr(jaccard_join, "LOCAL_SHINGLES", 500)
    paired = []
    blocks = jaccard_join._in_block_pairs
    monkeypatch.setattr(jaccard_join, "_in_block_pairs", lambda regions, whole, percent: paired.append(whole.count()) or blocks(
        regions, whole, percent))
    rng = np.random.default_rng(8)
    core = words(rng, 20)
    texts = [" ".join(["first", *core, *words(rng, 30, 100_000)]) for _ in range(80)]
    docs = list(enumerate(texts + [t.replace("first", "other") for t in texts[:9]]))
    cut = jaccard_join.Shingler(4)
    members = spark.createDataFrame([("0", i, cut(t).tobytes()) for i, t in docs], "region string, node long, shingles binary")
    links = jaccard_join.verified_links(members, 85).collect()
    assert sum(paired) == 0
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = linked_components(shingle_sets(docs, 4), 85)
    assert {i: found.get(i, i) for i in want} == want and len(set(want.values())) == 80


@pytest.mark.parametrize("size,percent,small", [(4, 85, 16), (5, 80, 16), (5, 80, 2), (4, 60, 3), (2, 100, 3)])
def test_texts_with_common_lines_make_no_cluster(spark, monkeypatch, size, percent, small):
    """Texts that share a line or two, but no link, are not gathered: only
    sets that agree in more parts than are spare are.  No link is lost, also
    where a group of copies or the common lines fill regions."""
    monkeypatch.setattr(jaccard_join, "SMALL_REGION", small, raising=False)
    gathered, real = [], jaccard_join.saved

    def saved(df, name):
        out = real(df, name)
        if name == "cluster-members":
            gathered.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "saved", saved)
    rng = np.random.default_rng(9)
    lines = [" ".join(words(rng, 14, 100_000)) for _ in range(3)]
    texts = [" ".join([lines[i % 3], *words(rng, 40 + i % 30, 100_000), lines[i % 2]]) for i in range(400)]
    copies = near_copies(rng, 8, 2, 60) + near_copies(rng, 1, 30, 90)
    copies += [f"{lines[0]} {lines[1]} {lines[2]} {x}" for x in ("one", "two", "three", "a b c", "a b d")]
    copies += [" ".join(words(rng, n, 3)) for n in range(1, 12) for _ in range(3)]
    docs = list(enumerate(texts + copies))
    got = {r.doc_id: r.component_id for r in
           jaccard_join.jaccard_components(spark.createDataFrame(docs, DOCS).repartition(3), size, percent).collect()}
    assert got == linked_components(shingle_sets(docs, size), percent)
    if percent > 60:                    # the common lines are less than half of a text
        assert gathered[0] <= len(copies) + 40


def test_links_of_small_regions_survive_a_skewed_partition(spark):
    """Spark deals out the partition of a large region over several tasks; the
    small regions beside it stay whole."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    rng = np.random.default_rng(2)
    rows = [("large", i, rng.integers(0, 1 << 60, 40).astype(np.uint64).tobytes()) for i in range(600)]
    for i in range(60):
        own = rng.integers(0, 1 << 60, 20).astype(np.uint64).tobytes()
        rows += [(f"r{i}", 1000 + 2 * i, own), (f"r{i}", 1001 + 2 * i, own)]
    rng.shuffle(rows)
    rows = [(r, int(n), s) for r, n, s in rows]
    members = common.saved(spark.createDataFrame(rows, "region string, node long, shingles binary").repartition(12), "test-sets")
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        chosen = common.saved(members.select("region").distinct(), "test-regions")
        links = jaccard_join._local_links(members.join(chosen, "region", "left_semi"), 85).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(tuple(r) for r in links) == [(1001 + 2 * i, 1000 + 2 * i) for i in range(60)]


def test_katz_pairs_are_summed_and_packed_without_stable_sorts(monkeypatch):
    """Pairs keep their counts and their words' values, at the price of plain sorts."""
    rng = np.random.default_rng(4)
    asked = []
    argsort, unique = np.argsort, np.unique
    monkeypatch.setattr(np, "argsort", lambda *a, **k: asked.append(k.get("kind")) or argsort(*a, **k))
    monkeypatch.setattr(np, "unique", lambda *a, **k: asked.append(k.get("return_index")) or unique(*a, **k))
    h, w = (rng.integers(1, 9, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(2))
    c = rng.integers(1, 50, 400)
    h2, w2, c2 = katz._add_pairs([(h[:150], w[:150], c[:150]), (h[150:], w[150:], c[150:])])
    want = Counter()
    for x, y, n in zip(h.tolist(), w.tolist(), c.tolist()):
        want[x, y] += n
    assert dict(zip(zip(h2.tolist(), w2.tolist()), c2.tolist())) == want and len(h2) == len(want)
    m = katz.Model(np.sort(unique(w)[:3]), np.array([5, 6, 7]), 100, 8, 2, np.zeros(7), 4)
    value = (w2 >> np.uint64(40)).astype(np.int64)
    got = katz._unpack_pairs(m, katz._pack_pairs(m, h2, w2, c2, value))
    assert sorted(zip(*(x.tolist() for x in got))) == sorted(zip(h2.tolist(), w2.tolist(), c2.tolist(), value.tolist()))
    assert not any(asked)
