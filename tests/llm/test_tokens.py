"""Word encoder, Elias-Fano select and token files against the library's own
whole-text ids and against plain decoding."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import elias_fano, token_files, word_encoder
from ledgerline.llm.chunked_tokenizer import ChunkEncoder, read_spec
from ledgerline.llm.queries import tokenizer_file

ODD = ["", " ", "don't can't 'tis we'll ROCK'N'ROLL it's, ,'s '' 's 's's", "<|endoftext|> a<|startoftext|>b <|endoftext|",
       "éte é ́x ≠ a̸b", "naïve ÉCOLE Œuvre ﬁn ẞ İstanbul ΣΑΣ Σ", "1st 22nd x2y a1b2c3",
       "漢字 text漢字mixed кириллица", "a\xa0b c\x85d\x1ce\x0bf\x0cg\th\r\ni", "_foo_bar-baz's",
       "…word… ‘quote’s’ “x”", "x" * 5000, "🙂👍🏽a🙂b", "×÷ a×b÷c", "ª º ² ³ a² bª", "word " * 30_000]


@pytest.fixture(scope="module")
def spec():
    return read_spec(tokenizer_file("word_bpe_49k.json"))


def test_word_encoder_equals_library(spec, monkeypatch):
    monkeypatch.setattr(word_encoder, "MAX_PIECES", 300)
    monkeypatch.setattr(word_encoder, "GROUP_CHARS", 2_000)
    rng = random.Random(5)
    alphabet = "aAzZéÉß'’ .,!<|≯́\n\t 1²ⅣŒœ_-`~漢\xa0İ"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(4_000)]
    enc = word_encoder.WordEncoder(spec)
    lib = Tokenizer.from_str(spec)
    for _ in range(2):
        got = enc.encode(texts)
        assert [enc.ids(g).tolist() for g in got] == \
            [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert len(enc.pieces) <= 300 + 6_000


def test_encoder_is_kept_per_process_and_chosen_by_tokenizer(spec):
    assert word_encoder.encoder_for(spec) is word_encoder.encoder_for(spec)
    assert isinstance(word_encoder.encoder_for(spec), word_encoder.WordEncoder)
    other = word_encoder.encoder_for(read_spec(tokenizer_file("byte_bpe_50k.json")))
    assert isinstance(other, ChunkEncoder)


@pytest.mark.parametrize("n,u", [(0, 0), (1, 0), (1, 5), (5, 3), (1000, 10), (1000, 10**6), (5000, 2**40),
                                 (70, 2**62), (64, 64), (129, 10**6)])
def test_select_equals_decoding(n, u):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, u + 1, n))
    e, _ = elias_fano.EliasFano.from_bytes(elias_fano.EliasFano.encode(v).to_bytes())
    assert e.all().tolist() == v.tolist()
    i = rng.permutation(n)
    assert e.select_many(i).tolist() == v[i].tolist()
    assert [e.select(k) for k in range(min(n, 20))] == v[:20].tolist()
    with pytest.raises(IndexError):
        e.select(n)


def test_file_slices(tmp_path):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 49_000, k).astype("<u2") for k in (1, 0, 700, 3, 20_000, 0, 5)]
    data = b"".join(token_files.pack_file(2, 1, [None, 4, 4, 9, 10, 11, 12], [x.tobytes() for x in ids], np.dtype("<u2")))
    f = token_files.TokenFile(data)
    order = np.array([6, 0, 4, 1, 2])
    start, got = f.slices(order)
    assert [g.tolist() for g in got] == [ids[i].tolist() for i in order]
    assert start.tolist() == [sum(len(x) for x in ids[:i]) for i in order]
    assert f.ids(3).tolist() == ids[3].tolist() and f.doc_ids[0] is None


def test_repeated_and_null_doc_ids(spark, spec):
    lib = Tokenizer.from_str(spec)
    rows = [(None, "b a"), (None, None), (7, "x y z"), (7, "x y z"), (3, ""), (7, "a")]
    got = token_files.token_output(spark.createDataFrame(rows, "doc_id long, text string"),
                                   tokenizer_file("word_bpe_49k.json"), end_id=1).collect()
    want = [(i, [*lib.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == \
        sorted((i or -1, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 3, 7, 7, 7]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
