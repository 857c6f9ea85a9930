"""Language identification by error-correcting output codes.

Every language has a codeword; for each of its bits a binary classifier over
hashed byte n-grams tells the languages with a 1 from those with a 0.  A text
gets the language whose codeword has the least loss, bits weighted by how well
their classifiers do on the training sample; a small lead over the runner-up
flags the answer as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, map_arrow, texts_of

UNDETERMINED = "und"
SLOTS = 1 << 13
SAMPLE_DOCS = 6_000                # bound of the labelled sample, see train()
AMBIGUOUS_LEAD = 0.2
_LETTER = re.compile(r"[^\W\d_]")
GROUP = 64


def gram_counts(texts: list[str]) -> np.ndarray:
    """(texts, SLOTS) counts of hashed 1- to 3-byte grams of the lower-cased
    whole texts; digits and ASCII punctuation count as one separator."""
    out = np.empty((len(texts), SLOTS), dtype=np.float32)
    for at in range(0, len(texts), GROUP):
        part = [t.lower().encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts[at:at + GROUP]]
        for i, raw in enumerate(part):
            a = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
            b = a[1:] + (a[:-1] << np.uint32(8))
            c = b[1:] + (a[:-2] << np.uint32(16))
            # multiplicative hashing into the high bits
            h = np.concatenate([(b + np.uint32(1 << 24)) * np.uint32(2654435761),
                                c * np.uint32(2246822519)]) >> np.uint32(19)
            out[at + i] = np.bincount(h, minlength=SLOTS)
    return out


_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """(n, bits) of +1 / -1: for up to 6 classes the exhaustive code, beyond
    that a dense random one, picked among several for its least distance."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        # every split into two non-empty sets, once
        cols = [[1 if k == 0 or (m >> (k - 1)) & 1 else -1 for k in range(n)] for m in range(2 ** (n - 1) - 1)]
        return np.array(cols, dtype=float).T
    rng = np.random.default_rng(seed)
    best, least = None, -1
    for _ in range(200):
        c = rng.choice([-1.0, 1.0], size=(n, int(np.ceil(10 * np.log2(n)))))
        c = c[:, np.abs(c.sum(axis=0)) < n]
        d = min(int((c[i] != c[j]).sum()) for i in range(n) for j in range(i))
        if d > least:
            best, least = c, d
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray          # (languages, bits)
    weights: np.ndarray       # (SLOTS, bits): log odds per gram
    scale: np.ndarray         # (bits, 2): logistic calibration of a bit's margin
    trust: np.ndarray         # (bits,): decoding weight of a bit

    def margins(self, counts: np.ndarray) -> np.ndarray:
        n = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return counts @ self.weights / n

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, score, lead) per row: loss-weighted decoding with the
        logistic loss."""
        z = np.clip(margins * self.scale[:, 0] + self.scale[:, 1], -30, 30)
        loss = np.stack([(np.log1p(np.exp(-z * c)) * self.trust).sum(axis=1) for c in self.code], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        lead = np.full(len(z), np.inf) if loss.shape[1] == 1 else \
            np.take_along_axis(loss, order[:, 1:2], 1)[:, 0] - loss.min(axis=1)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return best, (1 / p.sum(axis=1)), lead


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Fit on ``docs`` (doc_id, text, lang): about ``sample_docs`` rows per
    language (all, if there are fewer), chosen by a hash of their id; NULL
    languages and ids and texts without a letter take no part."""
    rows = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], np.ones((0, 1)), np.zeros((SLOTS, 1)), np.ones((1, 2)), np.ones(1))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample_docs / n) * 1_000_000)) for k, n in sizes.items()])
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1_000_000)) < share)
    schema = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            kinds, texts = b.column("lang").to_pylist(), texts_of(b)
            for i in range(0, len(texts), 256):
                c = gram_counts(texts[i:i + 256])
                # each document has the same say
                c = np.rint(c / np.maximum(c.sum(axis=1, keepdims=True), 1) * 1_000_000).astype(np.int64)
                for k, row in zip(kinds[i:i + 256], c):
                    total[k] = total.get(k, 0) + row
        for k, v in total.items():
            at = np.flatnonzero(v)
            yield batch_of(schema, lang=[k] * len(at), slot=at, n=v[at])

    table = np.zeros((len(langs), SLOTS))
    place = {k: i for i, k in enumerate(langs)}
    # at most languages x SLOTS rows
    for r in map_arrow(sample, count, "lang string, slot int, n long").groupBy("lang", "slot") \
            .agg(F.sum("n").alias("n")).collect():
        table[place[r.lang], r.slot] = r.n
    p = (table + 1e-6 * table.sum(axis=1, keepdims=True) + 1) / (table.sum(axis=1, keepdims=True) * (1 + 1e-6 * SLOTS) + SLOTS)
    code = codewords(len(langs))
    up = np.stack([p[code[:, b] > 0].mean(axis=0) for b in range(code.shape[1])], axis=1)
    down = np.stack([p[code[:, b] < 0].mean(axis=0) if (code[:, b] < 0).any() else np.full(SLOTS, 1 / SLOTS)
                     for b in range(code.shape[1])], axis=1)
    draft = LanguageModel(langs, code, (np.log(up) - np.log(down)).astype(np.float32),
                          np.tile([1.0, 0.0], (code.shape[1], 1)), np.ones(code.shape[1]))
    return _calibrated(draft, sample)


def _calibrated(m: LanguageModel, sample: DataFrame) -> LanguageModel:
    """Per bit a logistic slope and offset and, as its weight, how much better
    than chance it tells the sample's two sides apart."""
    shipped = sample.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("m", pa.list_(pa.float64()))])
        for b in batches:
            texts = texts_of(b)
            for i in range(0, len(texts), 256):
                z = shipped.value.margins(gram_counts(texts[i:i + 256]))
                yield batch_of(schema, lang=b.column("lang").slice(i, 256), m=z.astype(float).tolist())

    rows = map_arrow(sample, run, "lang string, m array<double>").collect()
    z = np.array([r.m for r in rows], dtype=float)
    truth = m.code[[m.languages.index(r.lang) for r in rows]]
    scale, trust = [], []
    for b in range(m.code.shape[1]):
        y = (truth[:, b] + 1) / 2
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        s, o = 1.0, 0.0
        a = np.column_stack([z[:, b], np.ones(len(z))])
        w = np.array([s, o])
        for _ in range(40):
            q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            g = a.T @ (weight * (q - y)) + 1e-3 * (w - [1.0, 0.0])
            h = (a * (weight * q * (1 - q))[:, None]).T @ a + 1e-3 * np.eye(2)
            w = w - np.linalg.solve(h, g)
        right = ((a @ w > 0) == (y == 1)).astype(float)
        scale.append(w)
        trust.append(max(0.05, 2 * np.average(right, weights=weight) - 1))
    return LanguageModel(m.languages, m.code, m.weights, np.array(scale), np.array(trust))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous per row of ``docs``
    (doc_id, text), from the text alone.  NULL texts and texts without a letter
    are ``und`` with score 0; so is everything if no language was learned."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("ambiguous", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            texts = texts_of(b)
            for i in range(0, len(texts), 256):
                part = texts[i:i + 256]
                letters = np.array([_LETTER.search(t) is not None for t in part]) & bool(m.languages)
                best, score, lead = m.decode(m.margins(gram_counts(part))) if m.languages else \
                    (np.zeros(len(part), int), np.zeros(len(part)), np.zeros(len(part)))
                yield batch_of(schema, doc_id=b.column("doc_id").slice(i, 256),
                               lang_pred=[m.languages[k] if ok else UNDETERMINED for k, ok in zip(best, letters)],
                               score=np.where(letters, score, 0.0), ambiguous=~letters | (lead < AMBIGUOUS_LEAD))

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, lang_pred string, score double, ambiguous boolean")
