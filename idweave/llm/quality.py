"""Compression classifier: zstandard dictionaries of good and bad labelled text.

A text is compressed with a dictionary of good text, with one of bad text, and
with none. The difference of the two compressed sizes over the text's length is
the evidence; a logistic curve over it, the compression ratios and the length
turns it into a calibrated chance of label 1.

Learning is the only bounded part: at most ``per_class`` labelled rows of each
class (those with the smallest hash of the id, of at most ``MOST_BYTES``
each), the first ``DICTIONARY_ROWS`` (half, if that is less) for the
dictionaries and the others for the curve. Every document is
scored, whole.

Defined results: null text is empty and gets the score of an empty text;
labels that are null, of held-out ids or of ids that disagree are not used;
with no labels of one class the score is the share of label 1 (0.5 with no
labels); no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

PER_CLASS, DICTIONARY_ROWS, MOST_BYTES, DICTIONARY_BYTES, LEVEL, FOLDS, THRESHOLD = 4_000, 600, 65_536, 112_640, 3, 5, 0.3
#: A dictionary learns from so many pieces of this size of a text, evenly spread, so that long texts do not crowd it.
PIECES, PIECE_BYTES = 2, 4_096
#: Weight of the penalty on the curve's coefficients.
RIDGE = 1.0


def held_out(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    """True for ids of the held-out fold (crc32 of the id as text, modulo ``folds``); false for null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries, and the curve's centre, scale and weights; without dictionaries ``prior`` is the score."""

    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float
    level: int = LEVEL

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Chance of label 1 of each text."""
        if not self.good or not self.bad:
            return np.full(len(texts), self.prior)
        x = (features(texts, self.good, self.bad, self.level) - np.array(self.centre)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights[1:]) + self.weights[0], -30, 30)))


@cache
def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=level)
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=held)


def features(texts: list[bytes], good: bytes, bad: bytes, level: int = LEVEL) -> np.ndarray:
    """The normalised size difference, the ratios with the good dictionary and with none, the log length, and products."""
    n = np.array([len(t) for t in texts], dtype=float)
    sizes = [np.array([len(c.compress(t)) for t in texts], dtype=float)
             for c in (_compressor(good, level), _compressor(bad, level), _compressor(b"", level))]
    m = n + 32
    base = [10 * (sizes[1] - sizes[0]) / m, 3 * sizes[0] / m, sizes[2] / m, np.log(m) / 3]
    products = [a * b for i, a in enumerate(base) for b in base[i:]]
    return np.stack([*base, *products, base[0] ** 3], axis=1)


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of pieces of the texts; raw content where there is too little to train on."""
    starts = [range(0, len(t), PIECE_BYTES) for t in texts]
    pieces = [t[i:i + PIECE_BYTES] for t, at in zip(texts, starts) for i in at[::-(-len(at) // PIECES)][:PIECES]]
    try:
        return zstandard.train_dictionary(size, [p for p in pieces if len(p) > 7]).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights of a ridge logistic regression by Newton steps."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - centre) / scale]
    b = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + RIDGE * np.eye(len(b)),
                               a.T @ (weight * (y - p)) - RIDGE * b)
        b += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, b


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", per_class: int = PER_CLASS, folds: int = FOLDS) -> QualityModel:
    """Learn from a bounded sample of the labelled rows outside the held-out fold."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col, folds)).groupBy(
        F.col(id_col).cast("bigint").alias("id")).agg(F.min(label_col).cast("int").alias("label"),
                                                      F.max(label_col).cast("int").alias("most")).filter("label = most")
    count = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    prior = count.get(1, 0) / sum(count.values()) if count else 0.5
    rank = F.xxhash64("id")
    some = [known.filter(F.col("label") == c).select("id", "label", rank.alias("rank")).orderBy("rank").limit(per_class)
            for c in (0, 1)]
    sample = F.broadcast(some[0].unionByName(some[1]))  # at most 2 * per_class rows
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.encode(F.col(text_col), "UTF-8").alias("text")).filter(
        F.length("text").between(1, MOST_BYTES)).join(sample, "id").select("label", "rank", "text").collect()
    rows = sorted({(r.rank, r.label, bytes(r.text)) for r in rows})
    halves = []
    for label in (0, 1):
        own = [t for _, c, t in rows if c == label]
        cut = min(DICTIONARY_ROWS, len(own) // 2)
        halves.append((own[:cut], own[cut:]))
    if min(len(part) for label in halves for part in label) == 0:
        return QualityModel(b"", b"", (), (), (), prior)
    bad, good = (dictionary(halves[label][0]) for label in (0, 1))
    x = features(halves[0][1] + halves[1][1], good, bad)
    y = np.r_[np.zeros(len(halves[0][1])), np.ones(len(halves[1][1]))]
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    fitted = fit_curve(x, y, weight)
    return QualityModel(good, bad, *(tuple(v.tolist()) for v in fitted), prior)


def quality_score(model: QualityModel, text_col: str = "text") -> Column:
    """The score of a text column."""
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
        values = column.cast(kind)
        parts = [model.score([v.as_py() or b"" for v in values.slice(i, 256)]) for i in range(0, len(values), 256)]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return score(F.col(text_col).cast("string"))


def scored(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "quality_score") -> DataFrame:
    """``docs`` with the score in the column ``name``."""
    return docs.withColumn(name, quality_score(model, text_col))


def good_documents(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns."""
    name = free_name(docs, "llm_score")
    return scored(docs, model, text_col, name).filter(F.col(name) >= threshold).select(*docs.columns)
