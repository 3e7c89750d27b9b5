"""Quality by compression: two zstandard dictionaries, built from good and from bad text.

A text is cut into blocks, each of which is compressed with either dictionary; the
difference of the summed sizes over the text's length says which kind of text it shares
more with, and a logistic curve fitted to labelled texts turns it into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.llm.labels import labelled_sample, remainder

BLOCK = 2048
#: Labelled documents per class and characters each that a model is fitted to, at most.
PER_CLASS, MAX_CHARS = 3000, 20_000
DICT_BYTES = 65_536
#: A text of this many bytes counts half by its own difference and half by the labels' share.
HALF_BYTES = 100


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    share: float
    level: int = 3

    def compressors(self) -> list:
        out = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.level)
            out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False))
        return out

    def score(self, differences: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The curve, drawn towards the share of label 1 for texts too short to tell."""
        own = sizes / (sizes + HALF_BYTES)
        return own / (1 + np.exp(-np.clip(self.slope * differences + self.offset, -40, 40))) + (1 - own) * self.share


def difference(text: str | None, compressors: list) -> tuple[float, int]:
    """(bytes with the bad dictionary - bytes with the good one) / length, over all blocks
    of the text (0 for no text), and the length in bytes."""
    raw = (text or "").encode("utf-8", "replace")
    good, bad = compressors
    d = 0
    for at in range(0, len(raw), BLOCK):
        block = raw[at : at + BLOCK]
        d += len(bad.compress(block)) - len(good.compress(block))
    return d / max(1, len(raw)), len(raw)


def _dictionary(texts: list[str]) -> bytes:
    blocks = [b[i : i + BLOCK] for b in (t.encode("utf-8", "replace") for t in texts) for i in range(0, len(b), BLOCK) if b[i : i + BLOCK]]
    try:
        return zstandard.train_dictionary(DICT_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform blocks to train on: their end serves as it is
        return b"".join(blocks)[-DICT_BYTES:] or b" " * 16


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method with a small ridge."""
    a, b = 0.0, 0.0
    scale = float(np.std(x)) or 1.0
    z = x / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        e = (p - y) * weight
        g = np.array([(e * z).sum() + 1e-2 * a, e.sum() + 1e-2 * b])
        w = np.maximum(p * (1 - p), 1e-9) * weight
        h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a / scale, b


def fit(sample: pd.DataFrame) -> QualityModel:
    """A model of (text, y, weight) rows: even rows of each class build the dictionaries, odd ones
    fit the curve.  With under two rows of either class every text scores the labelled
    share of 1 (0.5 without any)."""
    sample = sample[sample["text"].notna()]
    by = {k: list(sample.loc[sample["y"] == k, "text"]) for k in (0, 1)}
    share = (float(sample.loc[sample["y"] == 1, "weight"].sum()) + 0.5) / (float(sample["weight"].sum()) + 1)
    if min(map(len, by.values())) < 2:
        return QualityModel(b" " * 16, b" " * 16, 0.0, float(np.log(share / (1 - share))), share)
    model = QualityModel(_dictionary(by[1][::2]), _dictionary(by[0][::2]), 0.0, 0.0, share)
    made = model.compressors()
    x = np.array([difference(t, made)[0] for k in (0, 1) for t in by[k][1::2]])
    y = np.array([k for k in (0, 1) for _ in by[k][1::2]])
    weight = np.array([w for k in (0, 1) for w in list(sample.loc[sample["y"] == k, "weight"])[1::2]])
    slope, offset = logistic(x, y, weight)
    return QualityModel(model.good, model.bad, slope, offset, share)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 4, held_out: int = 2, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> DataFrame:
    """doc_id, held_out, score, predicted, size_difference for every row of ``docs``; the
    score reads nothing but the whole text.

    Null and empty texts score the share of label 1 in the sample.  A row without an id is
    held out.  Equal ids and repeated rows are rows of their
    own.  The model is fitted to a bounded sample, see labelled_sample()."""
    model = fit(labelled_sample(docs, labels, "quality", mod, held_out, per_class, max_chars))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries: DICT_BYTES each

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        made = m.compressors()
        for pdf in batches:
            d, n = np.array([difference(t, made) for t in pdf["text"]], dtype=float).reshape(-1, 2).T
            s = m.score(d, n)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": s, "predicted": (s >= threshold).astype("int32"), "size_difference": d})

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder(F.col("doc_id"), mod) == held_out, F.lit(True)).alias("held_out"), "text")
    return ids.transform(map_batches, run, "doc_id long, held_out boolean, score double, predicted int, size_difference double")
