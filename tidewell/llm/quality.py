"""Compression classifier for text quality.

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is compressed against both, block by block, so that the
dictionary matters in every part of a long text. The normalised difference of
the two compressed sizes, ``(bad - good) / bytes``, is positive when the good
dictionary helps more, and near zero for text that needs neither, such as one
word over and over. Labelled rows that built no dictionary calibrate it:
monotone fits (pool adjacent violators) give the share of good text at each
difference, and a small part of a logistic fit keeps the order of texts with
the same share. A short text's difference says less, so there is a fit around
each of ``CENTRES`` bytes, to which a row counts the more the nearer its size
is on a logarithmic scale; a score lies between those of its two centres in
the same way. It has no step at any size.

Fitting uses a bounded sample: ``max_rows`` labelled rows of each class (those
with the smallest hash of their id), as whole texts. Every other one goes to
the driver for the dictionaries, at most ``max_rows`` texts at any corpus size;
the others are compressed in tasks and send two numbers each. Scoring always
reads every text as a whole.

Defined results: a null or empty text has difference 0 and the size of one
byte; a label that is null or neither 0 nor 1 is ignored; labels without a
document are ignored; without rows of one class every score is the smoothed
share of the other, without any labels 0.5. An empty table of documents has an
empty result; very long texts take time in step with their size and the memory
of one block. Repeated rows are scored each for itself. Extra columns are kept;
columns already called ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_blocks, pinned

MAX_ROWS = 3000
DICT_BYTES = 65536
BLOCK = 2048
LEVEL = 3
THRESHOLD = 0.3
SMOOTH = 0.02
CENTRES = (64, 256, 1024, 4096, 16384)  # bytes
FAR = 0.01  # what a row of another size counts at least


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries (None: that class had no text) and the calibration."""
    good: bytes | None
    bad: bytes | None
    weight: float
    bias: float
    steps: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...] = ()  # by centre: differences, shares of good

    def score(self, texts) -> np.ndarray:
        x = np.array([size_difference(t, self.good, self.bad) for t in texts], dtype=np.float64)
        smooth = 1 / (1 + np.exp(-np.clip(self.weight * x + self.bias, -30, 30)))
        if not self.steps:
            return smooth
        near = nearness([text_bytes(t) for t in texts])
        shares = np.column_stack([np.interp(x, *fit) for fit in self.steps])
        return (1 - SMOOTH) * (near * shares).sum(axis=1) + SMOOTH * smooth


def text_bytes(text: str | None) -> int:
    return len(text.encode("utf-8")) if text else 0


def nearness(sizes) -> np.ndarray:
    """How near each size is to each centre: shares of the two centres around it, on a logarithmic scale."""
    at = np.interp(np.log(np.maximum(sizes, 1)), np.log(CENTRES), np.arange(len(CENTRES)))
    return np.maximum(0.0, 1 - np.abs(at[:, None] - np.arange(len(CENTRES))))


def held_out(id_col: str) -> Column:
    """Rows never learnt from: crc32 of the id's text is divisible by 5 (null ids: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def build_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes | None:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    blocks = [b for s in samples for b in as_blocks(s, BLOCK)]
    total = sum(map(len, blocks))
    if total < 8:
        return None
    if len(blocks) >= 16 and total >= 4 * size:
        try:
            return zstandard.train_dictionary(size, blocks, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(blocks)[-size:]


def _compressor(data: bytes):
    kind = zstandard.DICT_TYPE_AUTO if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    loaded = zstandard.ZstdCompressionDict(data, dict_type=kind)
    loaded.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=loaded, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)


@lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes):
    return _compressor(good), _compressor(bad)


def size_difference(text: str | None, good: bytes | None, bad: bytes | None) -> float:
    """Difference of the whole text's two compressed sizes over its own size."""
    if not text or good is None or bad is None:
        return 0.0
    with_good, with_bad = _compressors(good, bad)
    data, difference = text.encode("utf-8"), 0
    for block in as_blocks(data, BLOCK):
        difference += len(with_bad.compress(block)) - len(with_good.compress(block))
    return difference / len(data)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Weight and bias of a weighted one-variable logistic regression (Newton steps)."""
    scale = float(np.sqrt(np.average(x * x, weights=w))) or 1.0
    z = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (w * (y - p)) - ridge * w.sum() * beta * [1, 0]
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag([ridge * w.sum(), 1e-9])
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def _monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Pool adjacent violators: differences and the share of ones there, never falling; half a row of either class added."""
    pools: list[list[float]] = []  # ones, weight, first and last difference
    for i in np.argsort(x, kind="stable"):
        pools.append([y[i] * w[i], w[i], x[i], x[i]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            ones, weight, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + ones, pools[-1][1] + weight, pools[-1][2], last]
    share = np.maximum.accumulate([(ones + 0.5) / (weight + 1) for ones, weight, _, _ in pools])
    points = [(float(a), float(s)) for (_, _, *ends), s in zip(pools, share, strict=True) for a in ends]
    return tuple(a for a, _ in points), tuple(s for _, s in points)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_rows: int = MAX_ROWS) -> QualityModel:
    """Dictionaries and calibration from the labelled rows that aren't held out."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
                    .filter("id is not null and label in (0, 1)").filter(~held_out("id")).distinct())
    rates = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(rates) < 2:
        n = sum(rates.values())
        return QualityModel(None, None, 0.0, math.log((rates.get(1, 0) + 1) / (n - rates.get(1, 0) + 1)))
    chosen = [marked.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(max_rows) for k in (0, 1)]
    picked = chosen[0].unionByName(chosen[1])  # 2 * max_rows narrow rows at any size
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    rows = pinned(texts.join(F.broadcast(picked), "id").groupBy("id", "label").agg(F.min("text").alias("text")), "labelled", "zstd")
    # of at most 2 * max_rows ids, by hash: the first, third and so on build dictionaries, the others calibrate
    own = Window.partitionBy("label")
    turns = rows.select("id", "label").withColumns({
        "turn": F.row_number().over(own.orderBy(F.xxhash64("id"), "id")), "n": F.count("*").over(own)})
    placed = rows.join(F.broadcast(turns), ["id", "label"])
    learn: dict[int, list[bytes]] = {0: [], 1: []}
    for row in placed.filter("turn % 2 = 1").orderBy("label", "turn").collect():
        learn[row["label"]].append(row["text"].encode("utf-8"))
    good, bad = build_dictionary(learn[1]), build_dictionary(learn[0])
    prior = math.log((rates[1] + 1) / (rates[0] + 1))
    if good is None or bad is None:
        return QualityModel(None, None, 0.0, prior)

    @F.pandas_udf("double")
    def difference(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: size_difference(t, good, bad))

    check = (placed.filter("turn % 2 = 0 or n = 1")
                   .select("label", "turn", F.octet_length("text").alias("size"), difference("text").alias("x"))
                   .orderBy("label", "turn").collect())
    x, y = np.array([r["x"] for r in check]), np.array([float(r["label"]) for r in check])
    near = nearness([r["size"] for r in check])
    share = {k: rates[k] / sum(rates.values()) for k in (0, 1)}  # the sample is balanced, the labels are not
    w = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum()) * len(y)
    fits = tuple(_monotone(x, y, w * (FAR + (1 - FAR) * near[:, k])) for k in range(len(CENTRES)))
    return QualityModel(good, bad, *_logistic(x, y, w), fits)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is good."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return docs.withColumn(score_col, score(F.col(text_col)))


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **fit) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score is at least ``threshold``)."""
    scored = score_quality(docs, fit_quality(docs, labels, **fit))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
