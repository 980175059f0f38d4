"""Toxic passages by maximum-scoring segments.

Weights. A token's weight is the log-odds of the toxic against the clean
class, in labelled documents that hold it, under a Dirichlet prior that is
centred on the rates of the token's stem (its first ``STEM`` letters), whose
own prior is the base rate: a rare form of a toxic stem leans on the stem. A
weight that isn't ``Z`` standard deviations above zero counts as none, and
each token without weight costs ``DRIFT``, so that a random text drifts down.

Passages. One linear scan (Ruzzo and Tompa 1999) gives all maximal scoring
segments. The scores of the segments of a random clean text of n tokens follow
an extreme-value law: E = K n exp(-lambda S) of them are expected to reach S
(Karlin and Altschul 1990). lambda solves the sum of p exp(lambda s) = 1 over
the clean tokens' scores, K is fitted to clean documents. A segment is
significant if E <= ``E_MAX``.

Score. A document's evidence is -ln E of its best segment and the sum over its
significant ones, both as ln(1 + x); logistic calibration on labelled documents makes it a score.

The fit sees a bounded sample (``SAMPLE_ROWS`` labelled rows, whole texts of
``SAMPLE_BYTES`` in all), so the words it learns are bounded too; scoring reads
whole texts.
Defined cases: a null text counts as empty and an empty text has no segment;
both get the score of a document without evidence. Without labels of both
kinds every score is the smoothed share of toxic labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, labelled, materialize, whole
from .quality import logistic

SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 64 << 20
FOLDS, HELD = 5, 0
STEM = 4
STEM_PRIOR, TOKEN_PRIOR = 10.0, 5.0
Z = 2.5
DRIFT = 0.25
E_MAX = 0.05

_TOKEN = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    lam: float
    k: float
    weights: np.ndarray

    def weight(self, token: str) -> float:
        found = self.words.get(token)
        return self.stems.get(token[:STEM], 0.0) if found is None and len(token) > STEM else found or 0.0


@dataclass
class Segment:
    start: int
    end: int
    before: float
    after: float

    @property
    def score(self) -> float:
        return self.after - self.before


def segments(positives: list[tuple[int, float]], drift: float = DRIFT) -> list[Segment]:
    """All maximal scoring segments, from (position, weight) of the tokens with a positive weight.

    ``before`` and ``after`` are the running totals at a segment's ends. The
    link of a segment is the nearest one to its left with a smaller total
    before it; following links instead of neighbours makes the scan linear.
    """
    found: list[Segment] = []
    links: list[int] = []
    total, at = 0.0, 0
    for i, w in positives:
        total -= drift * (i - at)
        new = Segment(i, i + 1, total, total + w)
        total, at = new.after, i + 1
        j = len(found) - 1
        while True:
            while j >= 0 and found[j].before >= new.before:
                j = links[j]
            if j < 0 or found[j].after >= new.after:
                break
            new.start, new.before = found[j].start, found[j].before
            del found[j:], links[j:]
            j = len(found) - 1
        found.append(new)
        links.append(j)
    return found


class Scanner:
    """Scores texts one after the other; remembers the weights of tokens, of ``KNOWN`` at most."""

    KNOWN = 200_000

    def __init__(self, model: Model):
        self.model, self.known, self.toxic = model, set(), {}

    def positives(self, words: list[str]) -> list[tuple[int, float]]:
        own = set(words)
        if new := own - self.known:
            if len(self.known) > self.KNOWN:
                self.known, self.toxic, new = set(), {}, own
            for t in new:
                if (w := self.model.weight(t)) > 0:
                    self.toxic[t] = w
            self.known |= new
        if own.isdisjoint(self.toxic):
            return []
        return [(i, self.toxic[t]) for i, t in enumerate(words) if t in self.toxic]

    def surprise(self, score: float, n: int) -> float:
        """-ln E."""
        return self.model.lam * score - np.log(self.model.k * max(n, 1))

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """The significant passages: first token, token behind the last, score, E."""
        words = tokens(text)
        found = [(s.start, s.end, s.score, float(np.exp(-self.surprise(s.score, len(words))))) for s in segments(self.positives(words))]
        return [s for s in found if s[3] <= E_MAX]

    def evidence(self, text: str) -> tuple[float, float]:
        words = tokens(text)
        least = -np.log(E_MAX)
        each = [self.surprise(s.score, len(words)) for s in segments(self.positives(words))]
        return float(np.log1p(max([0.0, *each]))), float(np.log1p(sum(x for x in each if x >= least)))


def _counts(sample: DataFrame) -> DataFrame:
    """(token, y, n): in how many sampled documents, and toxic ones, each token is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, toxic = Counter(), Counter()
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(tokens(text))
                n.update(own)
                if y:
                    toxic.update(own)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([toxic[t] for t in n], pa.int64()), pa.array(list(n.values()), pa.int64())], ["token", "y", "n"])
        give_back()

    return sample.select("y", "text").mapInArrow(count, "token string, y long, n long").groupBy("token").agg(F.sum("y").alias("y"), F.sum("n").alias("n"))


def _log_odds(y: Column, n: Column, share: Column, prior: float, base: float) -> tuple[Column, Column]:
    a, b = y + prior * share, n - y + prior * (1 - share)
    delta = F.log(a / b) - float(np.log(base / (1 - base)))
    return delta, delta / F.sqrt(1 / a + 1 / b)


def _lam(values: np.ndarray, rates: np.ndarray, drift: float) -> float:
    """The positive root of sum(p exp(lambda s)) = 1, tokens without weight scoring -drift."""
    rest = max(1e-9, 1 - rates.sum())
    lo, hi = 1e-6, 20.0
    for _ in range(100):
        mid = (lo + hi) / 2
        if np.dot(rates, np.exp(np.minimum(mid * values, 500))) + rest * np.exp(-mid * drift) > 1:
            hi = mid
        else:
            lo = mid
    return max(hi, 1e-3)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = materialize(labelled(docs, labels, "toxic", FOLDS, HELD, SAMPLE_ROWS, SAMPLE_BYTES), "toxic-sample")
    counts = materialize(_counts(sample), "tokens")
    total = counts.agg(F.sum("y"), F.sum("n")).first()
    toxic, everything = total[0] or 0, total[1] or 0
    kinds = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    docs_all, docs_toxic = kinds[0], kinds[1] or 0
    if not toxic or toxic == everything:
        share = (docs_toxic + 1) / (docs_all + 2)
        return Model({}, {}, 1.0, 1.0, np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    base = toxic / everything
    stem = F.substring("token", 1, STEM)
    long = F.length("token") > STEM
    stems = counts.where(long).groupBy(stem.alias("stem")).agg(F.sum("y").alias("sy"), F.sum("n").alias("sn"))
    d, z = _log_odds(F.col("sy"), F.col("sn"), F.lit(base), STEM_PRIOR, base)
    stems = materialize(stems.select("stem", "sy", "sn", d.alias("d"), z.alias("z"), ((F.col("sy") + STEM_PRIOR * base) / (F.col("sn") + STEM_PRIOR)).alias("share")), "stems")
    met = counts.join(stems.select("stem", "share"), (stem == F.col("stem")) & long, "left")
    d, z = _log_odds(F.col("y"), F.col("n"), F.coalesce("share", F.lit(base)), TOKEN_PRIOR, base)
    strong = met.select("token", d.alias("d"), z.alias("z"), (F.col("n") - F.col("y")).alias("clean")).where(f"z >= {Z} and d > 0")
    rows = strong.orderBy("token").collect()  # no more than the sample's bytes can hold
    stem_rows = stems.where(f"z >= {2 * Z} and d > 0").orderBy("stem").collect()
    words, heads = {r.token: r.d for r in rows}, {r.stem: r.d for r in stem_rows}
    # a token of a toxic stem that is known to be clean has no weight
    if heads:
        innocent = met.select("token", "stem", d.alias("d"), "n").where("d <= 0 and n >= 2")
        innocent = innocent.join(stems.where(f"z >= {2 * Z} and d > 0").select("stem"), "stem", "left_semi")
        words |= {r.token: 0.0 for r in innocent.select("token").collect()}

    lam = 1.0
    if rows or stem_rows:
        values = np.array([r.d for r in rows] + [r.d for r in stem_rows])
        held = np.array([r.clean + 0.1 for r in rows] + [0.1] * len(stem_rows))
        lam = _lam(values, held / max(1, everything - toxic), DRIFT)
    model = Model(words, heads, lam, 1.0, np.zeros(3))

    # K: how many segments of at least s0 clean documents have, against exp(-lambda s0) for each token
    found = sample.select("y", _spread(model)("text").alias("s")).collect()
    s0 = 1.0
    clean = [r.s for r in found if not r.y]
    reach = sum(r[1] for r in clean)
    k = (reach + 0.5) * np.exp(lam * s0) / max(1.0, sum(r[0] for r in clean))
    model = Model(words, heads, lam, float(k), np.zeros(3))
    seen = sample.select("y", _evidence(model)("text").alias("f")).collect()
    x = np.array([r.f for r in seen], float).reshape(-1, 2)
    y = np.array([r.y for r in seen], float)
    w = logistic(np.concatenate([np.ones((len(x), 1)), x], 1), y, ridge=0.1)
    return Model(words, heads, lam, float(k), w)


def _spread(model: Model):
    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = Scanner(model)
        for texts in batches:
            rows = []
            for t in texts.to_pylist():
                words = tokens(t)
                rows.append([float(len(words)), float(sum(s.score >= 1.0 for s in segments(scan.positives(words))))])
            yield pa.array(rows, pa.list_(pa.float64()))

    return of


def _evidence(model: Model):
    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = Scanner(model)
        for texts in batches:
            yield pa.array([list(scan.evidence(t)) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return of


def score(text: Column, model: Model) -> Column:
    """A score in (0, 1) for each text, higher for toxic ones."""
    m = model

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = Scanner(m)
        for texts in batches:
            x = np.array([scan.evidence(t) for t in texts.to_pylist()], float).reshape(-1, 2)
            z = m.weights[0] + x @ m.weights[1:]
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))
        del scan
        give_back()

    return of(whole(text))


def passages(text: Column, model: Model) -> Column:
    """The significant passages of each text as structs (first, behind, score, e), in tokens."""
    m = model

    @F.arrow_udf("array<struct<first:int,behind:int,score:double,e:double>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = Scanner(m)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("behind", pa.int32()), ("score", pa.float64()), ("e", pa.float64())]))
        for texts in batches:
            yield pa.array([[dict(zip(("first", "behind", "score", "e"), p, strict=True)) for p in scan.passages(t)] for t in texts.to_pylist()], kind)

    return of(whole(text))
