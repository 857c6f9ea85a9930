"""Ids of whole texts under a word tokenizer, from the ids of their pieces.

A tokenizer that lower-cases, drops white space and ends each word with a
marked token encodes every word on its own, and always cuts between a letter
and an ASCII character that is none.  Texts are cut at those places and at
white space by Arrow's kernels, which also number the distinct pieces of a
group of texts.  Their ids come from a cache; letter runs that it lacks go to
the ``tokenizers`` library in one joined call and are told apart by their
end-of-word tokens, other pieces go one by one.

The cache lives as long as the Python worker, holds a bounded number of pieces
and gives up the oldest half when full.  ``encoder_for`` picks this encoder or,
for other tokenizers, the general one.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.chunked_tokenizer import ChunkEncoder, chunk_mode, spec_digest

# Letters that no normalisation changes but for their case.  A cut before an
# ASCII character or before one of them never parts what would combine.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_AFTER_LETTER = f"([{_LETTERS}])([!-@\\[-`{{-~])"
# but an apostrophe and the letters behind it may be a contraction
_BEFORE_LETTER = f"([!-&(-@\\[-`{{-~])([{_LETTERS}])"
_RUN = re.compile(f"[{_LETTERS}]+")
MAX_PIECES = 400_000
JOINED = 512                      # words of one library call
GROUP_CHARS = 2_000_000

_ENCODERS: dict[str, object] = {}


class WordEncoder:
    """Encodes texts; ids are packed little-endian in the narrowest of 16 and
    32 bits that holds the vocabulary."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        j = json.loads(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t["content"] for t in j.get("added_tokens") or []]
        suffix = j["model"]["end_of_word_suffix"]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.ends[[i for t, i in j["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.pieces: dict[str, bytes] = {"": b""}

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of lower-case letter runs, each one word of the tokenizer."""
        out = {}
        for i in range(0, len(runs), JOINED):
            part = runs[i:i + JOINED]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part) and stops[-1] == len(ids):
                raw, a = ids.tobytes(), 0
                for run, b in zip(part, (stops * self.dtype.itemsize).tolist()):
                    out[run] = raw[a:b]
                    a = b
            else:
                out.update((run, self._library(run)) for run in part)
        return out

    def _learn(self, missing: list[str]) -> None:
        cache = self.pieces
        if len(cache) > MAX_PIECES:
            for p in list(itertools.islice(cache, len(cache) // 2)):
                del cache[p]
            cache[""] = b""
        lower = {p: p.lower() for p in missing if _RUN.fullmatch(p)}
        cache.update(self._runs([r for r in set(lower.values()) if r not in cache]))
        for p in missing:
            cache[p] = cache[lower[p]] if p in lower else self._library(p)

    def _group(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens' strings."""
        cut = pa.array(texts, pa.large_string())
        for pattern, by in (("[\t\n\r]", " "), (_AFTER_LETTER, r"\1 \2"), (_BEFORE_LETTER, r"\1 \2")):
            cut = pc.replace_substring_regex(cut, pattern, by)
        cut = pc.split_pattern(cut, " ")
        numbered = cut.values.dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        ids = [self.pieces.get(p) for p in distinct]
        missing = [p for p, x in zip(distinct, ids) if x is None]
        if missing:
            self._learn(missing)
            ids = [self.pieces[p] if x is None else x for p, x in zip(distinct, ids)]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(ids), self.dtype)
        begin = np.cumsum(size) - size
        which = numbered.indices.to_numpy()
        n = size[which]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        # position in the distinct pieces' ids of every id of the texts
        at = np.repeat(begin[which] - (ends - n), n) + np.arange(total)
        raw = flat[at].tobytes()
        words = cut.offsets.to_numpy()
        stops = (np.append(0, ends)[words] * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip(stops[:-1], stops[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids per whole text, without added special tokens; special
        strings inside a text are handled as the library does by default."""
        out: list = [None] * len(texts)
        plain, size = [], 0
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                out[i] = self._library(t)
            else:
                plain.append(i)
                size += len(t)
            if plain and (size >= GROUP_CHARS or i + 1 == len(texts)):
                for k, x in zip(plain, self._group([texts[k] for k in plain])):
                    out[k] = x
                plain, size = [], 0
        return out

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, dtype=self.dtype)


def encoder_for(spec: str):
    """This process's encoder of a tokenizer: made once per Python worker."""
    key = spec_digest(spec)
    if key not in _ENCODERS:
        words = chunk_mode(spec) == "word" and json.loads(spec)["model"].get("end_of_word_suffix")
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(spec) if words else ChunkEncoder(spec)
    return _ENCODERS[key]
