"""Public tokenizers with a per-chunk cache.

A text is cut only at places where the tokenizer's own pre-tokenisation cuts
it in any case, so the ids of the text are the ids of its chunks joined; each
distinct chunk is encoded once per task by the ``tokenizers`` library.

* ``word``: the pre-tokenizer drops white space and the normaliser works
  within words; a text is cut at every U+0020.
* ``space``: a byte-level pre-tokenizer lets a word take one leading space; a
  text is cut before each single space between two non-space characters.
* ``whole``: any other tokenizer; texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np

SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
CACHE_CHUNKS = 300_000


def read_spec(path: str) -> str:
    """The tokenizer's JSON (a few MB), read on the driver and shipped to the
    tasks, so that executors need no copy of the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def spec_digest(spec: str) -> str:
    import tokenizers
    return hashlib.sha256(f"{tokenizers.__version__}\0{spec}".encode()).hexdigest()


def chunk_mode(spec: str) -> str:
    j = json.loads(spec)
    pre, norm = j.get("pre_tokenizer") or {}, j.get("normalizer")
    added = j.get("added_tokens") or []
    if any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        return "whole"
    if j.get("truncation") or j.get("padding"):
        return "whole"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") \
            and norm is None:
        return "space"
    steps = pre.get("pretokenizers") or []
    kinds = {n.get("type") for n in (norm or {}).get("normalizers", [])}
    if kinds <= {"NFC", "Replace", "Lowercase"} and steps and steps[0].get("type") == "Split" \
            and steps[0].get("behavior") == "Removed" and steps[0].get("invert") \
            and steps[0]["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+"):
        return "word"
    return "whole"


class ChunkEncoder:
    """Encodes texts; ids are packed little-endian in the narrowest of 16 and
    32 bits that holds the vocabulary."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.mode = chunk_mode(spec)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        if self.mode == "word":
            return text.split(" ")
        if self.mode == "space":
            parts = SINGLE_SPACE.split(text)
            parts[1:] = [" " + p for p in parts[1:]]
            return parts
        return [text]

    def _learn(self, chunks) -> None:
        todo = list(chunks)
        if len(self.cache) > CACHE_CHUNKS:
            self.cache.clear()
        for i in range(0, len(todo), 8192):
            part = todo[i:i + 8192]
            for c, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                self.cache[c] = np.array(e.ids, dtype=self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids per text; ``encode_special_tokens`` stays at the
        library's default."""
        if self.mode == "whole":
            return [np.array(e.ids, dtype=self.dtype).tobytes()
                    for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        out = []
        for start, stop in _groups(texts):
            cut = [self.chunks(t) for t in texts[start:stop]]
            distinct = set().union(*cut)
            missing = distinct.difference(self.cache)
            if missing:
                if len(self.cache) > CACHE_CHUNKS:      # cleared: this group's chunks are all needed
                    missing = distinct
                self._learn(missing)
            out.extend(b"".join(map(self.cache.__getitem__, c)) for c in cut)
        return out

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, dtype=self.dtype)


def _groups(texts: list[str], chars: int = 4_000_000):
    """Runs of texts of about ``chars`` characters, so that the lists of
    chunks stay small."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
