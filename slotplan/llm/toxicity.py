"""Toxicity: a linear-chain CRF tags toxic tokens; marginals give scores and offsets.

Labels are per document, so tokens are labelled first: a token of a toxic training
document is toxic if its word or a beginning of it (4, 5 or 6 bytes) is much more
common in toxic documents and occurs there after many different words (copies of
one passage do not count as evidence). A two-state CRF over hashed word and
beginning features is then trained by maximum likelihood (``fit``). Scoring runs
forward-backward over every whole text: the squared marginals of a text, summed, and the marginals at
their largest, go through a logistic calibration to its score; runs of tokens with
marginals of at least one half are the offending spans.

The training sample is bounded: ``max_toxic`` and ``max_clean`` labelled documents
of at most ``max_bytes`` bytes, those with the smallest id hashes. Every document is
scored whole. Forward-backward is vectorised over lanes of ``LANE`` tokens: the
2x2 products of each lane are combined first, so chains of any length are exact.

Defined cases: null and empty texts get the score of a text without evidence;
null labels are ignored; a document labelled twice is two examples; without
examples of both classes every score is the share of toxic labels (0.5 without
any); repeated rows score alike; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

BITS = 18                  # each feature kind hashes to 2**BITS weights
KINDS = 4                  # the word, and its first 4, 5 and 6 bytes
LANE = 128
MAX_TOXIC, MAX_CLEAN, MAX_BYTES = 1000, 2000, 8_000
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters (UTF-8 bytes)."""
    out = W._LOWER[data]
    after = np.zeros(len(data), dtype=bool)
    after[1:] = data[:-1] == 0xC3
    out[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    return out


def token_features(chunk: W.Chunk) -> np.ndarray:
    """KINDS x tokens matrix of weight positions."""
    data, start, end = _lowered(chunk.data), chunk.start.copy(), chunk.end.copy()
    for _ in range(4):                                   # bare the word of punctuation around it
        more = (end - start > 1) & _PUNCT[data[np.minimum(start, len(data) - 1)]]
        start[more] += 1
        more = (end - start > 1) & _PUNCT[data[end - 1]]
        end[more] -= 1
    room = np.zeros(len(data) + 16, dtype=np.uint8)
    room[:len(data)] = data
    eights = np.lib.stride_tricks.as_strided(room[:8].view(np.uint64), shape=(len(data) + 8,), strides=(1,))
    head = eights[start]
    shift, out = np.uint64(64 - BITS), np.empty((KINDS, len(start)), dtype=np.int64)
    out[0] = (W._word_hashes(data, start, end) >> shift).astype(np.int64)
    for k, size in enumerate((4, 5, 6), 1):
        part = head & W._MASK[np.minimum(end - start, size)]
        out[k] = (W.mix(part + np.uint64(size * 0x9E3779B9)) >> shift).astype(np.int64) + (k << BITS)
    return out


def _products(a, b):
    """Products of 2x2 matrices given as (4, n) arrays, scaled to a largest entry of 1."""
    out = np.stack([a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3],
                    a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]])
    return out / np.maximum(out.max(axis=0), 1e-300)


def forward_backward(score: np.ndarray, first: np.ndarray, trans: np.ndarray, begin: np.ndarray):
    """Chain marginals of concatenated texts.

    ``score``: log-potential of the toxic state per token; ``first``: token starts a
    text; ``trans`` 2x2 and ``begin`` 2 potentials. Returns (alpha, beta), each 2 x n,
    scaled per token.
    """
    n = len(score)
    pot = np.stack([np.where(score > 0, np.exp(-np.maximum(score, 0)), 1.0),
                    np.where(score > 0, 1.0, np.exp(np.minimum(score, 0)))])
    lanes = -(-n // LANE)
    m = np.zeros((4, lanes * LANE))
    m[0], m[3] = 1.0, 1.0                                             # identity pads the end
    for i in (0, 1):
        for j in (0, 1):
            m[2 * i + j, :n] = np.where(first, begin[j], trans[i, j]) * pot[j]
    m = m.reshape(4, lanes, LANE)
    whole = m[:, :, 0]
    for t in range(1, LANE):
        whole = _products(whole, m[:, :, t])
    into, outof = np.empty((2, lanes)), np.empty((2, lanes))
    x, y = 1.0, 1.0
    for k, (p, q, r, s) in enumerate(whole.T.tolist()):
        into[:, k] = x, y
        x, y = x * p + y * r, x * q + y * s
        x, y = x / (x + y), y / (x + y)
    x, y = 1.0, 1.0
    for k, (p, q, r, s) in zip(range(lanes - 1, -1, -1), whole.T.tolist()[::-1]):
        outof[:, k] = x, y
        x, y = p * x + q * y, r * x + s * y
        x, y = x / (x + y), y / (x + y)
    alpha, beta = np.empty((2, lanes, LANE)), np.empty((2, lanes, LANE))
    a, b = into, outof
    for t in range(LANE):
        a = np.stack([a[0] * m[0, :, t] + a[1] * m[2, :, t], a[0] * m[1, :, t] + a[1] * m[3, :, t]])
        a = a / a.sum(axis=0)
        alpha[:, :, t] = a
    for t in range(LANE - 1, -1, -1):
        beta[:, :, t] = b
        b = np.stack([m[0, :, t] * b[0] + m[1, :, t] * b[1], m[2, :, t] * b[0] + m[3, :, t] * b[1]])
        b = b / b.sum(axis=0)
    return alpha.reshape(2, -1)[:, :n], beta.reshape(2, -1)[:, :n]


def marginals(alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    both = alpha * beta
    return both[1] / both.sum(axis=0)


@dataclass
class Crf:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(KINDS << BITS, dtype=np.float32))
    bias: float = -4.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))     # log-potentials
    begin: np.ndarray = field(default_factory=lambda: np.zeros(2))
    calibration: tuple[float, float, float] = (0.0, 0.0, 0.0)
    constant: float | None = None

    def chain(self, feats: np.ndarray, first: np.ndarray):
        score = self.weights[feats].sum(axis=0, dtype=np.float64) + self.bias
        alpha, beta = forward_backward(score, first, np.exp(self.trans), np.exp(self.begin))
        return score, alpha, beta

    def doc_score(self, total: np.ndarray, top: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(total), self.constant)
        a, b, c = self.calibration
        return 1 / (1 + np.exp(-np.clip(a + b * np.log(total + 1e-3) + c * top, -30, 30)))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def _tops(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1)
    full = at[1:] > at[:-1]
    if full.any():
        out[full] = np.maximum.reduceat(values, at[:-1][full])
    return out


def label_tokens(feats: np.ndarray, doc: np.ndarray, before: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Whether each token counts as toxic (``toxic``: label of each document)."""
    n_tox, n_ok = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    bad = np.zeros(feats.shape[1], dtype=bool)
    in_toxic = toxic[doc]
    slots, n_docs = KINDS << BITS, len(toxic)
    hashed = (before >> np.uint64(40)).astype(np.int64)
    for f in feats:
        where, whose = np.divmod(np.unique(f.astype(np.int64) * n_docs + doc), n_docs)
        t = np.bincount(where[toxic[whose]], minlength=slots)
        c = np.bincount(where[~toxic[whose]], minlength=slots)
        varied = np.bincount(np.unique((f[in_toxic].astype(np.int64) << 24) + hashed[in_toxic]) >> 24, minlength=slots)
        odds = np.log((t + 0.5) / (n_tox + 1)) - np.log((c + 0.5) / (n_ok + 1))
        sure = odds - 2.5 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))        # lower bound of the log-odds
        strong = (sure >= np.log(3)) & (c <= 0.02 * n_ok) & (varied >= np.maximum(3, 0.4 * t))
        bad |= strong[f]
    return bad & in_toxic


def fit(texts: list[str], toxic: np.ndarray, share: float, epochs: int = 20, rate: float = 0.5) -> Crf:
    """CRF and calibration from example texts; ``share``: toxic share among all labels."""
    model = Crf()
    if not toxic.any() or toxic.all():
        model.constant = share
        return model
    # begins of zero length keep texts apart even if the first is blank
    parts = [(c.doc + c.first, token_features(c).astype(np.int32), c.hashes()) for c in W.chunks(pa.array(texts, pa.string()))]
    doc, feats, hashes = (np.concatenate(x, axis=-1) for x in zip(*parts))
    del parts
    before = np.concatenate([[np.uint64(0)], hashes[:-1]])
    first = np.ones(len(doc), dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    before[first] = 0
    y = label_tokens(feats, doc, before, toxic)
    yi = y.astype(np.int64)
    # examples without a labelled token teach a toxic text nothing; the clean ones all count
    use = ~toxic[doc] | (np.bincount(doc, weights=y, minlength=len(toxic)) > 0)[doc]
    inner = np.flatnonzero(~first)
    used_inner = inner[use[inner]]
    pairs = np.bincount(2 * yi[used_inner - 1] + yi[used_inner], minlength=4).reshape(2, 2).astype(float)
    starts = np.bincount(yi[first & use], minlength=2).astype(float)
    positions = np.unique(feats)
    compact = np.searchsorted(positions, feats).astype(np.int32)
    w = np.zeros(len(positions))
    sq = {k: v for k, v in (("w", np.full(len(positions), 1e-8)), ("b", 1e-8), ("t", np.full((2, 2), 1e-8)), ("s", np.full(2, 1e-8)))}
    for _ in range(epochs):
        score = w[compact].sum(axis=0) + model.bias
        alpha, beta = forward_backward(score, first, np.exp(model.trans), np.exp(model.begin))
        p = marginals(alpha, beta)
        gap = np.where(use, y - p, 0.0)
        grads = {"w": sum(np.bincount(f, weights=gap, minlength=len(w)) for f in compact) - 0.05 * w, "b": gap.sum()}
        e1 = 1 / (1 + np.exp(-score))
        pot = np.stack([1 - e1, e1])
        joint = alpha[:, None, used_inner - 1] * np.exp(model.trans)[:, :, None] * (pot * beta)[None, :, used_inner]
        grads["t"] = pairs - (joint / joint.sum(axis=(0, 1))).sum(axis=2)
        grads["s"] = starts - np.array([(1 - p)[first & use].sum(), p[first & use].sum()])
        for k, g in grads.items():
            sq[k] = sq[k] + g * g
            step = rate * g / np.sqrt(sq[k])
            if k == "w":
                w += step
            elif k == "b":
                model.bias += float(step)
            elif k == "t":
                model.trans = model.trans + step
            else:
                model.begin = model.begin + step
    model.weights[positions] = w
    _, alpha, beta = model.chain(feats, first)
    p = marginals(alpha, beta)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    model.calibration = _calibrated(_sums(p * p, at), _tops(p, at), toxic, share)
    return model


def _calibrated(total, top, toxic, share) -> tuple[float, float, float]:
    """Logistic fit of the labels, moved to the true share of toxic documents."""
    x = np.stack([np.ones(len(total)), np.log(total + 1e-3), top], axis=1)
    y, beta = toxic.astype(float), np.zeros(3)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = x.T @ (x * (q * (1 - q))[:, None]) + 0.5 * np.eye(3)
        beta += np.linalg.solve(h, x.T @ (y - q) - 0.5 * beta)
    sample = y.mean()
    if 0 < share < 1:
        beta[0] += np.log(share / (1 - share)) - np.log(sample / (1 - sample))
    return tuple(float(b) for b in beta)


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
          max_bytes: int = MAX_BYTES) -> Crf:
    """Fit on a bounded sample. ``labels``: doc_id, toxic (0 or 1), training rows only."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    short = docs.where(F.octet_length("text") <= max_bytes).select("doc_id")
    eligible = known.join(short, "doc_id", "left_semi")
    pick = lambda t, n: eligible.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = pick(1, max_toxic).unionByName(pick(0, max_clean))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.octet_length("text") <= max_bytes)
            .orderBy("doc_id").limit(2 * (max_toxic + max_clean)).collect())
    return fit([r["text"] for r in rows], np.array([r["toxic"] == 1 for r in rows], dtype=bool), share)


def score(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, score and spans (start, end: code points; marginal) of every text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)          # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for b in batches:
            scores, spans = [], []
            for c in W.chunks(b.column(1)):
                if len(c.doc):
                    feats = token_features(c)
                    first = np.ones(len(c.doc), dtype=bool)
                    first[1:] = c.doc[1:] != c.doc[:-1]
                    _, alpha, beta = crf.chain(feats, first)
                    p = marginals(alpha, beta)
                else:
                    p, first = np.zeros(0), np.zeros(0, dtype=bool)
                scores.append(crf.doc_score(_sums(p * p, c.at), _tops(p, c.at)))
                spans += _spans(c, p, first)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])))],
                ["doc_id", "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, spans array<struct<start:int,end:int,marginal:double>>")


def _spans(c: W.Chunk, p: np.ndarray, first: np.ndarray) -> list[list[dict]]:
    """Runs of toxic tokens of each text of a chunk, in code points of the text."""
    out: list[list[dict]] = [[] for _ in range(c.rows)]
    hit = np.flatnonzero(p >= 0.5)
    if not len(hit):
        return out
    points = np.concatenate([[0], np.cumsum((c.data & 0xC0) != 0x80)])
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (np.diff(hit) > 1) | first[hit[1:]]
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(hit)) - 1
    for x, y in zip(hit[lo], hit[hi]):
        row = int(c.doc[x])
        zero = points[c.base[row]]
        out[row].append({"start": int(points[c.start[x]] - zero), "end": int(points[c.end[y]] - zero),
                         "marginal": float(p[x:y + 1].max())})
    return out
