"""Toxic spans by a linear-chain conditional random field.

Documents carry labels, tokens do not; token labels are derived first: a
token of a toxic document is labelled toxic if its word, or a stem of it,
keeps to toxic documents in the training sample.  The field has two states
and observes the word, its leading 4, 5 and 6 bytes and its neighbours.
Forward-backward marginals give each token's probability; a document's score
is a logistic function of its largest and summed marginals, fitted on rows that
the evidence and the field were not, at the labels' class shares; its offending
offsets are the runs of tokens with a marginal of at least one half.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.common import batch_of, map_arrow, texts_of

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(b if b in _WORD else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_FIND = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

HASH_BITS = 18
STEMS = (4, 5, 6)
CACHE_WORDS = 150_000
EMPTY_LOGIT = -12.0


# tokens whose words, and padded chains, are held together when scoring
GROUP_TOKENS = 300_000


@dataclass(frozen=True)
class TrainingBounds:
    """The bounded sample that the field is fitted on: about so many labelled
    documents of each class, fewer if they would hold more than about
    ``chars`` characters (chosen by a hash of their id).  Every window of
    2 * ``context`` + 1 tokens of the sample is fitted, in batches."""

    toxic_docs: int = 3_000
    clean_docs: int = 6_000
    chars: int = 12_000_000            # of either class
    context: int = 5
    min_docs: int = 3
    min_log_odds: float = 2.5
    chance: float = 0.05               # of any evidence term at all by luck
    steps: int = 150                   # of the fit, at least
    epochs: int = 2                    # over all windows, at least
    batch: int = 4_096                 # windows of one step


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def terms_of(word: bytes) -> list[bytes]:
    """The word and its stems, each told apart by its kind."""
    return [b"w" + word] + [b"%d" % n + word[:n] for n in STEMS if len(word) > n]


def _slot(kind: bytes, term: bytes) -> int:
    return zlib.crc32(term, zlib.crc32(kind)) & ((1 << HASH_BITS) - 1)


def slots_of(word: bytes) -> tuple[list[int], int, int]:
    """Weight slots of a token's own features and of its use as the previous
    and as the next word."""
    return [_slot(b"o", t) for t in terms_of(word)], _slot(b"p", word), _slot(b"n", word)


# --- training -------------------------------------------------------------

def _sample(labelled: DataFrame, toxic: int, want: int, chars: int) -> tuple[DataFrame, int]:
    """About ``want`` rows of the class, of about ``chars`` characters at
    most, and how many rows it has."""
    rows = labelled.filter(F.col("y") == toxic)
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = min(1.0, want / max(n, 1), chars / max(size, 1))
    return rows.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000)), n


def _evidence(sample: DataFrame, counts: dict[int, int], b: TrainingBounds) -> list[bytes]:
    """Terms that keep to toxic documents: by log odds of document counts, and
    only if that many toxic among a term's documents are too unlikely by chance
    (Chernoff's bound of the binomial tail, over all terms of the sample)."""
    schema = pa.schema([("term", pa.binary()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for x in batches:
            for t, y in zip(texts_of(x), x.column("y").to_pylist()):
                seen[y].update({t for w in set(words_of(t)) for t in terms_of(w)})
        terms = list(set(seen[0]) | set(seen[1]))
        if terms:
            yield batch_of(schema, term=terms, toxic=[seen[1][t] for t in terms],
                           clean=[seen[0][t] for t in terms])

    odds = F.log((F.col("toxic") + 0.5) / (counts[1] + 1)) - F.log((F.col("clean") + 0.5) / (counts[0] + 1))
    share, n = counts[1] / (counts[0] + counts[1]), F.col("toxic") + F.col("clean")
    unlikely = F.col("toxic") * F.log(F.col("toxic") / n / share) \
        + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - share))).otherwise(0.0)
    terms = map_arrow(sample, run, "term binary, toxic long, clean long").groupBy("term") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).persist()
    try:
        least = float(np.log(max(terms.count(), 1) / b.chance))
        rows = terms.filter((F.col("toxic") >= b.min_docs) & (odds >= b.min_log_odds) & (unlikely >= least))
        return sorted(bytes(r.term) for r in rows.select("term").collect())
    finally:
        terms.unpersist()


def _spots(n: int, tag: list[int], y: int, b: TrainingBounds) -> Iterator[tuple[int, int]]:
    """Windows [start, stop) of a document of n tokens: around the evidence of
    a toxic one, side by side over all tokens of a clean one."""
    size = 2 * b.context + 1
    last = -size
    for i in ([i for i, g in enumerate(tag) if g] if y else range(b.context, n + b.context, size)):
        if i - last >= size:
            last, lo = i, max(0, i - b.context)
            yield lo, min(n, lo + size)


def _encoded(tokens: list[bytes], width: int, known: dict) -> np.ndarray:
    """Weight slots of each token of a window: its own features, the bias and
    its neighbours' words; unused places have the slot whose weight is 0."""
    bias = 1 << HASH_BITS
    out = np.full((width, len(STEMS) + 4), bias + 1, dtype=np.int32)
    slots = [known.get(t) or known.setdefault(t, slots_of(t)) for t in tokens]
    for j, (own, _, _) in enumerate(slots):
        f = own + [bias] + ([slots[j - 1][1]] if j else []) + ([slots[j + 1][2]] if j + 1 < len(slots) else [])
        out[j, :len(f)] = f
    return out


def _windows(sample: DataFrame, evidence: list[bytes], b: TrainingBounds) -> tuple[np.ndarray, ...]:
    """Every window of the sample with derived labels: feature slots, tags,
    length and class."""
    shipped = sample.sparkSession.sparkContext.broadcast(set(evidence))
    width = 2 * b.context + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, known = shipped.value, {}
        schema = pa.schema([("y", pa.int32()), ("n", pa.int32()), ("tags", pa.binary()), ("slots", pa.binary())])
        for x in batches:
            for t, y in zip(texts_of(x), x.column("y").to_pylist()):
                w = words_of(t)
                tag = [int(y == 1 and any(f in bad for f in terms_of(v))) for v in w]
                if len(known) > CACHE_WORDS:
                    known.clear()
                n, tags, slots = [], [], []
                for lo, hi in _spots(len(w), tag, y, b):
                    n.append(hi - lo)
                    tags.append(bytes(tag[lo:hi]).ljust(width, b"\0"))
                    slots.append(_encoded(w[lo:hi], width, known).tobytes())
                if n:
                    yield batch_of(schema, y=[y] * len(n), n=n, tags=tags, slots=slots)

    got = map_arrow(sample, run, "y int, n int, tags binary, slots binary").toArrow().combine_chunks()
    raw = {c: b"".join(got.column(c).to_pylist()) for c in ("tags", "slots")}
    return (np.frombuffer(raw["slots"], np.int32).reshape(-1, width, len(STEMS) + 4),
            np.frombuffer(raw["tags"], np.uint8).reshape(-1, width),
            got.column("n").to_numpy(), got.column("y").to_numpy())


def _fit_chain(windows: tuple[np.ndarray, ...], bounds: TrainingBounds) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights (of state 1 over state 0; the last two are the bias and
    an unused 0) and the 2x2 transition weights that maximise the windows'
    conditional likelihood, both classes' windows weighing as much, by Adam
    over batches with an L2 penalty."""
    slots, tags, length, y = windows
    n, n_slots = len(y), (1 << HASH_BITS) + 2
    if not n:
        return np.zeros(n_slots), np.zeros((2, 2))
    # mixed by content, so that batches hold both classes however tasks split the sample
    order = np.argsort(np.array([zlib.crc32(s) for s in slots]), kind="stable")
    each = np.where(y == 1, n / max(2 * (y == 1).sum(), 1), n / max(2 * (y == 0).sum(), 1))
    w, tr = np.zeros(n_slots), np.zeros((2, 2))
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))
    batches = -(-n // bounds.batch)
    for step in range(1, max(bounds.steps, bounds.epochs * batches) + 1):
        own = order[(step - 1) % batches::batches]
        feats, tag, weight = slots[own], tags[own].astype(np.int64), each[own, None]
        live = np.arange(tags.shape[1]) < length[own, None]
        p1, pairs = _posteriors(w[feats].sum(axis=2), tr, live)
        pair = (live[:, 1:] & live[:, :-1]) * weight
        gw = np.bincount(feats.ravel(), np.repeat(((p1 - tag) * live * weight).ravel(), feats.shape[2]), n_slots)
        gw = gw / len(own) + 1e-4 * w
        gw[-1] = 0
        gt = np.array([[(pairs[..., a, c] * pair).sum()
                        - ((tag[:, :-1] == a) * (tag[:, 1:] == c) * pair).sum() for c in (0, 1)]
                       for a in (0, 1)]) / len(own) + 1e-3 * tr
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        mt, vt = 0.9 * mt + 0.1 * gt, 0.99 * vt + 0.01 * gt * gt
        a, c = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= 0.15 * (mw / a) / (np.sqrt(vw / c) + 1e-8)
        tr -= 0.05 * (mt / a) / (np.sqrt(vt / c) + 1e-8)
    return w, tr


def _posteriors(e: np.ndarray, tr: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 and pair marginals of padded windows."""
    n, width = e.shape
    score = np.stack([np.zeros_like(e), np.clip(e, -30, 30)], axis=2)
    alpha, beta = np.zeros((n, width, 2)), np.zeros((n, width, 2))
    alpha[:, 0] = score[:, 0]
    for t in range(1, width):
        a = np.logaddexp(alpha[:, t - 1, :1] + tr[0], alpha[:, t - 1, 1:] + tr[1]) + score[:, t]
        alpha[:, t] = np.where(live[:, t, None], a, alpha[:, t - 1])
    for t in range(width - 2, -1, -1):
        nxt = score[:, t + 1] + beta[:, t + 1]
        b = np.logaddexp(tr[:, 0] + nxt[:, :1], tr[:, 1] + nxt[:, 1:])
        beta[:, t] = np.where(live[:, t + 1, None], b, 0.0)
    both = alpha + beta
    p1 = 1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -60, 60)))
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])[:, None, None, None]
    pairs = alpha[:, :-1, :, None] + tr + (score + beta)[:, 1:, None, :] - z
    return p1, np.exp(np.minimum(pairs, 0))


def _fit_score(x: np.ndarray, y: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Logistic regression of the document label by Newton's steps; classes
    weigh as their ``totals``."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    share = totals[1] / (totals[0] + totals[1])
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (p - y)) + 1e-2 * w
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    return w


# --- inference ------------------------------------------------------------

class Tagger:
    """Emissions from cached word features, marginals by forward-backward on
    the odds of state 1, many documents of like length at a time."""

    def __init__(self, weights: np.ndarray, tr: np.ndarray):
        self.w, self.bias = weights, float(weights[1 << HASH_BITS])
        self.t00, self.t01, self.t10, self.t11 = np.exp(tr).ravel()
        self.place: dict[bytes, int] = {}
        self.table = np.zeros((1024, 3))

    def _learn(self, words) -> None:
        for word in words:
            k = len(self.place)
            if k == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            own, before, after = slots_of(word)
            self.table[k] = self.w[own].sum(), self.w[before], self.w[after]
            self.place[word] = k

    def emissions(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.place) > CACHE_WORDS:
            self.place, self.table = {}, np.zeros((1024, 3))
        self._learn(set().union(*docs).difference(self.place))
        out = []
        for d in docs:
            f = self.table[np.fromiter(map(self.place.__getitem__, d), np.int64, len(d))]
            e = f[:, 0] + self.bias
            e[1:] += f[:-1, 1]
            e[:-1] += f[1:, 2]
            out.append(e)
        return out

    def marginals(self, emissions: list[np.ndarray], group: int = 256) -> list[np.ndarray]:
        out: list = [np.empty(0)] * len(emissions)
        order = sorted(range(len(emissions)), key=lambda i: len(emissions[i]))
        while order:
            # chains of like length, of a bounded padded size together
            width = len(emissions[order[-1]])
            n = max(1, min(group, GROUP_TOKENS // max(width, 1)))
            order, own = order[:-n], order[-n:]
            if width:
                # right-aligned for the forward pass (leading padding has odds
                # that leave the start untouched), so all chains end together
                e = np.ones((width, len(own)))
                first = np.array([width - len(emissions[i]) for i in own])
                for c, i in enumerate(own):
                    e[first[c]:, c] = np.exp(np.clip(emissions[i], -30, 30))
                p = self._odds(e, first)
                for c, i in enumerate(own):
                    out[i] = p[first[c]:, c]
        return out

    def _odds(self, e: np.ndarray, first: np.ndarray) -> np.ndarray:
        width = len(e)
        a = np.empty_like(e)
        a[0] = e[0]
        starts = np.bincount(first, minlength=width)
        for t in range(1, width):
            x = a[t - 1]
            np.multiply(e[t], (self.t01 + self.t11 * x) / (self.t00 + self.t10 * x), out=a[t])
            if starts[t]:
                at = first == t
                a[t, at] = e[t, at]
        b = np.ones(e.shape[1])
        for t in range(width - 2, -1, -1):
            x = e[t + 1] * b
            b = (self.t10 + self.t11 * x) / (self.t00 + self.t01 * x)
            a[t] *= b
        return a / (1 + a)


def _token_groups(texts: list[str]) -> Iterator[list[list[bytes]]]:
    """The texts' words, so many texts at a time that their words are few."""
    group, size = [], 0
    for t in texts:
        group.append(words_of(t))
        size += len(group[-1])
        if size >= GROUP_TOKENS:
            yield group
            group, size = [], 0
    yield group


def _features(marginals: list[np.ndarray]) -> np.ndarray:
    """Largest marginal as log odds, and the expected number of toxic tokens
    among those above one in a hundred."""
    out = np.zeros((len(marginals), 2))
    for i, p in enumerate(marginals):
        top = p.max(initial=0.0)
        out[i] = (np.clip(np.log((top + 1e-9) / (1 - top + 1e-9)), EMPTY_LOGIT, -EMPTY_LOGIT),
                  np.log1p(p[p > 0.01].sum()))
    return out


def _char_spans(text: str, p: np.ndarray) -> list[dict]:
    raw = text.encode("utf-8", "surrogatepass")
    at = [(m.start(), m.end()) for m in _FIND.finditer(raw)]
    spans, open_at = [], None
    for i, hit in enumerate([*(p >= 0.5), False]):
        if hit and open_at is None:
            open_at = i
        elif not hit and open_at is not None:
            a, b = at[open_at][0], at[i - 1][1]
            start = len(raw[:a].decode("utf-8", "surrogatepass"))
            spans.append({"start": start, "end": start + len(raw[a:b].decode("utf-8", "surrogatepass"))})
            open_at = None
    return spans


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    transitions: np.ndarray
    score_weights: np.ndarray


def train(docs: DataFrame, labels: DataFrame, bounds: TrainingBounds = TrainingBounds()) -> ToxicityModel:
    """Fit on the rows of ``labels`` (doc_id, toxic 0/1) whose documents are in
    ``docs`` (doc_id, text); no other label is looked at, not even for the
    classes' shares.  NULL ids and labels take no part, a document with
    several label rows counts as toxic if one says so.  A quarter of the
    sample, by a hash of the id, is kept out of the evidence and the field and
    fits the score; where a class is missing from either part, all rows do both.
    Without both classes the model scores every text 0."""
    size = docs.groupBy("doc_id").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("size"))
    y = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")) \
        .join(size, "doc_id").persist()
    picked = [_sample(y, k, n, bounds.chars) for k, n in ((1, bounds.toxic_docs), (0, bounds.clean_docs))]
    # the sample's ids are bounded by the parameters above
    ids = F.broadcast(picked[0][0].unionByName(picked[1][0]))
    totals = {1: picked[0][1], 0: picked[1][1]}
    apart = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), F.lit(4)) == 0
    sample = docs.select("doc_id", "text").join(ids, "doc_id") \
        .select("text", "y", apart.alias("apart")).persist()
    try:
        parts = {(r.y, r.apart): r["count"] for r in sample.groupBy("y", "apart").count().collect()}
        counts = {y: parts.get((y, False), 0) + parts.get((y, True), 0) for y in (0, 1)}
        if not (counts[0] and counts[1]):
            return ToxicityModel(np.zeros((1 << HASH_BITS) + 2), np.zeros((2, 2)), np.array([-20.0, 0.0, 0.0]))
        fit, rest = sample, sample
        if len(parts) == 4:
            fit, rest = sample.filter(~F.col("apart")), sample.filter("apart")
            counts = {y: parts[y, False] for y in (0, 1)}
        windows = _windows(fit, _evidence(fit, counts, bounds), bounds)
        weights, tr = _fit_chain(windows, bounds)
        shipped = docs.sparkSession.sparkContext.broadcast((weights, tr))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tagger = Tagger(*shipped.value)
            schema = pa.schema([("y", pa.int32()), ("a", pa.float64()), ("b", pa.float64())])
            for x in batches:
                f = np.concatenate([_features(tagger.marginals(tagger.emissions(g))) for g in _token_groups(texts_of(x))])
                yield batch_of(schema, y=x.column("y"), a=f[:, 0], b=f[:, 1])

        got = map_arrow(rest, run, "y int, a double, b double").collect()
        m = np.array([(r.y, r.a, r.b) for r in got], dtype=float)
        return ToxicityModel(weights, tr, _fit_score(m[:, 1:], m[:, 0], totals))
    finally:
        sample.unpersist()
        y.unpersist()


def score(docs: DataFrame, model: ToxicityModel, spans: bool = True) -> DataFrame:
    """Every row of ``docs`` with toxicity (0 to 1) and, if asked for,
    toxic_spans: character offsets [start, end) of the runs of tokens with a
    marginal of at least one half.  NULL and empty texts have no tokens and
    the lowest score."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    text = names["text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        tagger = Tagger(m.weights, m.transitions)
        for x in batches:
            texts = texts_of(x, text)
            p = []
            for group in _token_groups(texts):
                p += tagger.marginals(tagger.emissions(group))
            f = _features(p)
            z = np.clip(m.score_weights[0] + f @ m.score_weights[1:], -30, 30)
            cols = [*x.columns, pa.array(1 / (1 + np.exp(-z)))]
            if spans:
                cols.append(pa.array([_char_spans(t, q) if q.max(initial=0) >= 0.5 else []
                                      for t, q in zip(texts, p)], type=span))
            yield pa.RecordBatch.from_arrays(cols, [*x.schema.names, "toxicity"] + ["toxic_spans"] * spans)

    extra = "toxicity double" + ", toxic_spans array<struct<start:long,end:long>>" * spans
    out = map_arrow(rows, run, StructType([*rows.schema.fields, *StructType.fromDDL(extra).fields]))
    back = [F.col(n).alias(c) for c, n in names.items() if c not in ("toxicity", "toxic_spans")]
    return out.select(*back, "toxicity", *["toxic_spans"] * spans)
