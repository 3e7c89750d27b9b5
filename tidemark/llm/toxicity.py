"""Toxic spans by a linear-chain conditional random field over words.

A two-state chain scores each word by the word itself, its beginnings and its neighbours.
Labels are known per document only, so the tags of words are hidden: a document that isn't
toxic has no toxic word, and a toxic one has at least one.  Forward-backward gives the
expected features of each document, and the probability that it has no toxic word, which
turns them into those under that constraint; the difference of the two is the gradient of
the labels' likelihood.  Words need no list to start from: what tells documents apart
raises some words' weights, and these then explain their documents and leave other words
alone.

The sum of the squared marginals (near the number of toxic words, and near 0 however many
unlikely words a text has) becomes a document score, calibrated on models that haven't seen
the document; runs of likely words are its offending offsets.  Chains end at line ends and
after . ! ? so that they stay short.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, map_batches
from tidemark.llm.labels import labelled_sample, remainder
from tidemark.llm.quality import logistic

PER_CLASS, MAX_CHARS = 1500, 10_000
#: Features are hashed to so many bits; those that stand in fewer different places (pairs of
#: neighbours) of the sample have no weight.  Neighbours are counted and not documents,
#: because all words of a document with copies are in many documents, but always between
#: the same neighbours.
BITS, LEAST_CONTEXTS = 20, 2
#: Lengths in bytes of the beginnings that are features beside the whole word.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Gradients grow with the sample; the pull to 0 is so much for each document of it.
EPOCHS, RATE, RIDGE, LASSO = 100, 0.5, 1e-6, 1e-5
#: The bias to begin with: about one likely word a document.
START = -6.0
#: Added to a document's sum before its logarithm.
LEAST_SUM = 1e-3
#: Text is read in pieces of about this many bytes (whole documents) to bound memory.
PIECE_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[10, 13, 33, 46, 63]] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words of several texts, one after another."""

    hash: np.ndarray  # words by features, uint64: of the whole word (A-Z lower-cased), then of its beginnings (0: it is no longer)
    start: np.ndarray  # byte offsets in the joined texts
    end: np.ndarray
    doc: np.ndarray
    chain: np.ndarray  # grows where a chain begins


def words_of(raws: list[bytes]) -> Words:
    """Runs of letters, digits and non-ASCII bytes."""
    joined = b"\n".join(raws) + b"\n"
    b = np.frombuffer(joined, np.uint8)
    is_word = _WORD[b]
    edge = np.diff(is_word.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        none = np.empty(0, np.int64)
        return Words(np.empty((0, 1 + len(BEGINNINGS)), np.uint64), none, none, none, none)
    bounds = np.cumsum([len(r) + 1 for r in raws])
    doc = np.searchsorted(bounds, start, side="right")
    # polynomial hash over each word: byte times a power of the distance from its start
    offset = np.arange(len(b), dtype=np.int32)
    offset -= np.repeat(start.astype(np.int32), np.diff(np.append(start, len(b)))) if start[0] == 0 else np.repeat(np.append(0, start).astype(np.int32), np.diff(np.concatenate([[0], start, [len(b)]])))
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(1 + int((end - start).max()), 0x100000001B3, np.uint64))
        value = np.where(is_word, _LOWER[b].astype(np.uint64) + np.uint64(7), np.uint64(0)) * power[np.minimum(offset, len(power) - 1)]
        total = np.concatenate([[np.uint64(0)], np.cumsum(value)])
        cols = [total[end] - total[start]]
        for k in BEGINNINGS:
            cols.append(np.where(end - start > k, (total[np.minimum(start + k, end)] - total[start]) * np.uint64(2 * k + 1), np.uint64(0)))
        h = np.stack(cols, axis=1) * _MULT
    h ^= h >> np.uint64(31)
    stops = np.cumsum(_STOP[b])
    chain = stops[start]
    return Words(h, start, end, doc, chain)


def words_in_parts(texts: list[str]) -> Words:
    """words_of() many texts, part by part to bound memory."""
    raws = [t.encode("utf-8", "replace") for t in texts]
    part = np.cumsum([len(r) for r in raws]) // PIECE_BYTES
    found, chains = [], 0
    for k in np.unique(part):
        members = np.flatnonzero(part == k)
        w = words_of([raws[i] for i in members])
        found.append(Words(w.hash, w.start.astype(np.int32), w.end.astype(np.int32), members[w.doc].astype(np.int32), (w.chain + chains).astype(np.int32)))
        chains += int(w.chain.max()) + 1 if len(w.chain) else 0
    return Words(*(np.concatenate([getattr(w, f) for w in found]) for f in ("hash", "start", "end", "doc", "chain")))


def features(w: Words) -> np.ndarray:
    """Features by words: places in the table of weights (0: none), of the whole word, its
    beginnings, and the words before and after it in its document."""
    whole = w.hash[:, 0]
    same = np.diff(w.doc, prepend=-1) == 0
    before = np.where(same, np.roll(whole, 1), np.uint64(0))
    after = np.where(np.roll(same, -1), np.roll(whole, -1), np.uint64(0))
    out = np.empty((2 + w.hash.shape[1], len(whole)), np.int32)
    with np.errstate(over="ignore"):
        for k, h in enumerate([*w.hash.T, before * np.uint64(3), after * np.uint64(5)]):
            out[k] = np.where(h == 0, 0, (h * _MULT) >> np.uint64(64 - BITS))
    return out


def _contexts(w: Words) -> np.ndarray:
    """A hash of each word between its neighbours."""
    whole = w.hash[:, 0]
    with np.errstate(over="ignore"):
        return (np.roll(whole, 1) * np.uint64(7) + whole) * _MULT + np.roll(whole, -1)


@dataclass(frozen=True)
class ToxicModel:
    weight: np.ndarray  # log potential of the toxic state that each feature adds
    bias: float  # that of any word
    move: np.ndarray  # 2 x 2 transition potentials
    slope: float
    offset: float

    def marginals(self, w: Words) -> np.ndarray:
        return marginals(potentials(features(w), self.weight, self.bias), w.chain, self.move)[0]

    def score(self, expected: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(expected + LEAST_SUM) + self.offset, -40, 40)))


def potentials(feature: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    total = np.full(feature.shape[1], bias)
    for row in feature:
        total += weight[row]
    return np.exp(np.clip(total, -30, 30))


def _columns(chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each chain, the longest first."""
    first = np.flatnonzero(np.diff(chain, prepend=chain[0] - 1 if len(chain) else 0))
    length = np.diff(np.append(first, len(chain)))
    order = np.argsort(-length, kind="stable")
    return first[order], length[order]


def marginals(e: np.ndarray, chain: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(word is toxic) for each word by forward-backward, all chains side by side, a
    column of words at a time; also the forward and backward odds.

    With two states the messages are odds: forward r = e * (m01 + r m11) / (m00 + r m10),
    backward s = (m10 + m11 e s) / (m00 + m01 e s)."""
    r, s = np.empty(len(e)), np.empty(len(e))
    if not len(e):
        return r, r, s
    first, length = _columns(chain)
    (m00, m01), (m10, m11) = np.exp(move)
    alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")  # chains with more than t words
    for t, n in enumerate(alive):
        at = first[:n] + t
        r[at] = e[at] if t == 0 else np.minimum(e[at] * (m01 + r[at - 1] * m11) / (m00 + r[at - 1] * m10), 1e100)
    last = first + length - 1
    s[last] = 1.0
    for t, n in enumerate(alive[1:], 1):
        at = last[:n] - t
        es = np.minimum(e[at + 1] * s[at + 1], 1e100)
        s[at] = (m10 + m11 * es) / (m00 + m01 * es)
    odds = r * s
    return odds / (1 + odds), r, s


def log_none(r: np.ndarray, chain: np.ndarray, doc: np.ndarray, move: np.ndarray, n_docs: int) -> np.ndarray:
    """Log probability that a document has no toxic word, from the forward odds."""
    inner = np.diff(chain) == 0
    m = np.exp(move)
    step = np.where(np.append(inner, False), move[0, 0] - np.log(m[0, 0] + r * m[1, 0]), -np.log1p(r))
    return np.bincount(doc, weights=step, minlength=n_docs)


def _chain_weights(feature: np.ndarray, contexts: np.ndarray, chain: np.ndarray, doc: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions that make the documents' labels likely: gradient
    ascent, scaled by past gradients, with weights drawn to 0."""
    _, one = np.unique(contexts, return_index=True)
    places = np.bincount(feature[:, one].ravel(), minlength=1 << BITS)
    places[0] = 0
    used = np.flatnonzero(places >= LEAST_CONTEXTS)
    at = np.zeros(1 << BITS, np.int32)
    at[used] = np.arange(1, len(used) + 1)
    feature = at[feature]
    theta, bias, move = np.zeros(len(used) + 1), START, np.zeros((2, 2))
    past, past_bias, past_move = np.full(len(theta), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    inner = np.flatnonzero(np.diff(chain) == 0)  # words followed by one of the same chain
    for _ in range(EPOCHS):
        e = potentials(feature, theta, bias)
        p, r, s = marginals(e, chain, move)
        none = np.exp(np.minimum(log_none(r, chain, doc, move, len(y)), -1e-9))
        # expectations under the constraint less plain ones, as a share of the plain ones
        pull = np.where(y == 1, np.minimum(none / (1 - none), 1e3), -1.0)
        miss = pull[doc] * p
        grad = sum(np.bincount(row, weights=miss, minlength=len(theta)) for row in feature) - RIDGE * len(doc) * theta
        grad[0] = 0.0
        m, share = np.exp(move), pull[doc[inner]]
        a, b = r[inner], e[inner + 1] * s[inner + 1]
        pairs = [m[0, 0] + np.zeros(len(inner)), m[0, 1] * b, m[1, 0] * a, m[1, 1] * a * b]
        total = sum(pairs)
        grad_move = np.array([(share * x / total).sum() for x in pairs]).reshape(2, 2)
        grad_move[0, 0] -= share.sum()  # without toxic words all pairs are of this kind
        past += grad**2
        past_bias += miss.sum() ** 2
        past_move += grad_move**2
        theta += RATE * grad / np.sqrt(past)
        theta = np.sign(theta) * np.maximum(np.abs(theta) - LASSO * len(y) * RATE / np.sqrt(past), 0.0)
        bias += RATE * miss.sum() / np.sqrt(past_bias)
        move = move + 0.2 * RATE * grad_move / np.sqrt(past_move)
    weight = np.zeros(1 << BITS)
    weight[used] = theta[1:]
    return weight, float(bias), move


def fit(sample: pd.DataFrame) -> ToxicModel:
    """A model of (text, y, weight) rows.  Without rows of one class, or without words,
    every text scores the labelled share of 1 (0.5 without any)."""
    sample = sample[sample["text"].notna()].reset_index(drop=True)
    share = (float(sample.loc[sample["y"] == 1, "weight"].sum()) + 0.5) / (float(sample["weight"].sum()) + 1)
    none = ToxicModel(np.zeros(1 << BITS), 2 * START, np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    if sample["y"].nunique() < 2:
        return none
    w = words_in_parts(list(sample["text"]))
    if not len(w.doc):
        return none
    y, doc, chain, feature, contexts = sample["y"].to_numpy(), w.doc, w.chain, features(w), _contexts(w)
    del w

    def part(of: np.ndarray):
        some = of[doc]
        rank = np.cumsum(of) - 1
        return feature[:, some], contexts[some], chain[some], rank[doc[some]], y[of]

    whole = _chain_weights(feature, contexts, chain, doc, y)
    fold = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0)) % 2
    expected = np.zeros(len(y))
    for k in (0, 1):  # each half is scored by a model of the other, if that has both classes
        model = _chain_weights(*part(fold != k)) if len(np.unique(y[fold != k])) == 2 and (fold[doc] != k).any() else whole
        here = fold[doc] == k
        p, _, _ = marginals(potentials(feature[:, here], *model[:2]), chain[here], model[2])
        expected += np.bincount(doc[here], weights=p**2, minlength=len(y))
    return ToxicModel(*whole, *logistic(np.log(expected + LEAST_SUM), y, sample["weight"].to_numpy()))


def tag(texts: list[str | None], model: ToxicModel, likely: float = 0.5) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Score of each text, and its toxic spans as [start, end) in code points: runs of
    words with marginals of ``likely`` or more in one chain."""
    raws = [(t or "").encode("utf-8", "replace") for t in texts]
    w = words_of(raws)
    p = model.marginals(w)
    expected = np.bincount(w.doc, weights=p**2, minlength=len(raws)) if len(p) else np.zeros(len(raws))
    spans: list[list[tuple[int, int]]] = [[] for _ in raws]
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])
    last = None
    for i in np.flatnonzero(p >= likely):
        d = int(w.doc[i])
        lo, hi = (len(raws[d][: int(x) - int(begins[d])].decode("utf-8", "replace")) for x in (w.start[i], w.end[i]))
        if last is not None and last == i - 1 and w.chain[i] == w.chain[i - 1]:
            spans[d][-1] = (spans[d][-1][0], hi)
        else:
            spans[d].append((lo, hi))
        last = i
    return model.score(expected), spans


def _parts(texts: list[str | None]) -> Iterator[slice]:
    """Consecutive texts of about PIECE_BYTES together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= PIECE_BYTES or i == len(texts) - 1:
            yield slice(at, i + 1)
            at, size = i + 1, 0


def _fitted(docs: DataFrame, labels: DataFrame, mod: int, held_out: int, per_class: int, max_chars: int):
    """A broadcast model: a table of weights of fixed size."""
    return docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(docs, labels, "toxic", mod, held_out, per_class, max_chars)))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 3, held_out: int = 1, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> DataFrame:
    """doc_id, held_out, score, predicted and toxic_spans (array of start and end, code
    points) for every row of ``docs``; the score reads nothing but the whole text.

    Null and empty texts have no toxic words and score as such.  A row without an id is
    held out.  Equal ids and repeated rows are rows of their own.  The model is fitted to
    a bounded sample, see labelled_sample()."""
    model = _fitted(docs, labels, mod, held_out, per_class, max_chars)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for at in _parts(texts):
                score, spans = tag(texts[at], model.value)
                spans = [[{"start": a, "end": b} for a, b in x] for x in spans]
                yield pdf.iloc[at][["doc_id", "held_out"]].assign(score=score, predicted=(score >= threshold).astype("int32"), toxic_spans=spans)

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder(F.col("doc_id"), mod) == held_out, F.lit(True)).alias("held_out"), "text")
    return ids.transform(map_batches, run, "doc_id long, held_out boolean, score double, predicted int, toxic_spans array<struct<start: int, end: int>>")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 3, held_out: int = 1, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    model = _fitted(docs, labels, mod, held_out, per_class, max_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in _parts(texts):
                score, _ = tag(texts[at], model.value)
                yield batch.slice(at.start, at.stop - at.start).filter(pa.array(score < threshold))

    return docs.transform(map_arrow, run, docs.schema)
