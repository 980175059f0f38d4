"""Quality by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled
text. Every text is cut into blocks of ``BLOCK`` bytes and each block is
compressed with both; a text that is like the good one comes out smaller with
the good dictionary. The difference of the two sizes, over all blocks and
divided by the text's own size, is the only thing that is known of a text
besides its length: a logistic calibration on labelled documents, each seen
through dictionaries that were trained without it, makes a score of the
difference, and the length says how far to trust it.

The fit sees a bounded sample (``SAMPLE_ROWS`` labelled rows, whole texts of
``SAMPLE_BYTES`` in all); scoring reads every byte of every text. Labels,
language, source and id never enter a score.

Defined cases: a null text counts as empty; an empty text has a difference of
0 and no length, so one score for all of them. With no label of one
kind in the sample that dictionary is empty, and every score is the
(smoothed) share of good labels when only one kind exists at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, labelled, materialize, whole

#: A dictionary learns from about a hundred times its size; the trainer takes some ten times the sample's.
SAMPLE_ROWS, SAMPLE_BYTES = 12_000, 16 << 20
DICT_BYTES = 112 << 10
BLOCK = 512
LEVEL = 3
#: Bytes added below the fraction, so that a text of a few words can't have an extreme one.
SMOOTH = 24
FOLDS, HELD = 4, 2


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def blocks(data: bytes) -> list[bytes]:
    """Blocks of ``BLOCK`` bytes; a short last one is part of the one before."""
    parts = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    if len(parts) > 1 and len(parts[-1]) < BLOCK // 8:
        last = parts.pop()
        parts[-1] += last
    return parts


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples serve as they are."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if not raw:
        return zstandard.ZstdCompressor(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), compression_params=params)


N_FEATURES = 2


def features(data: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> list[float]:
    """The normalised compressed-size difference, and the logarithm of the length."""
    g, b = good.compress, bad.compress
    return [sum(len(b(p)) - len(g(p)) for p in blocks(data)) / (len(data) + SMOOTH), float(np.log(len(data) + SMOOTH))]


def _expand(x: np.ndarray) -> np.ndarray:
    """Intercept, features and their squares and products."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([np.ones((len(x), 1)), x, x[:, i] * x[:, j]], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights by damped Newton steps; x has its intercept in the first column."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = materialize(labelled(docs, labels, "quality", FOLDS, HELD, SAMPLE_ROWS, SAMPLE_BYTES), "quality-sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    rows = sample.select("doc_id", "y", "text", half.alias("half")).orderBy("doc_id").collect()  # SAMPLE_BYTES at most

    def trained(part: list) -> tuple[bytes, bytes]:
        good, bad = (dictionary([p for r in part if r.y == y for p in blocks(r.text.encode())]) for y in (1, 0))
        return good, bad

    # each half is seen through the dictionaries of the other, for the calibration
    x, y = [], []
    for k in (0, 1):
        g, b = map(_compressor, trained([r for r in rows if r.half != k]))
        x += [features(r.text.encode(), g, b) for r in rows if r.half == k]
        y += [r.y for r in rows if r.half == k]
    good, bad = trained(rows)
    x, y = np.array(x, float).reshape(-1, N_FEATURES), np.array(y, float)
    del rows
    give_back()
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        weights = np.zeros(_expand(np.zeros((1, N_FEATURES))).shape[1])
        weights[0] = np.log(share / (1 - share))
        return Model(good, bad, np.zeros(N_FEATURES), np.ones(N_FEATURES), weights)
    centre, scale = x.mean(0), x.std(0) + 1e-9
    return Model(good, bad, centre, scale, logistic(_expand((x - centre) / scale), y))


def score(text: Column, model: Model) -> Column:
    """A score in (0, 1) for each text, higher for good ones."""
    m = model

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        g, b = _compressor(m.good), _compressor(m.bad)
        for texts in batches:
            x = np.array([features(t.as_py() or b"", g, b) for t in texts.cast(pa.binary())], float).reshape(-1, N_FEATURES)
            z = _expand((x - m.centre) / m.scale) @ m.weights
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))
        give_back()

    return of(whole(text))
