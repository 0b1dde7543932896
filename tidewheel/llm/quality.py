"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear score of surface features of its whole text. Labels give
preference pairs (a good document over a bad one), and the weights minimise the logistic loss of
the pairs' feature differences. A document is accepted if its score reaches the quantile of the
training scores that the labels reject, and the reported score is the logistic function of the
distance from that threshold.

The fit uses at most about SAMPLE labelled rows (a uniform sample by the id's hash), so its cost
and what is broadcast don't grow with the corpus. Scoring is one pass without shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import broadcast, ship

#: Labelled rows that a fit uses at most (about: the hash decides).
SAMPLE = 20_000
#: Opponents drawn for each row of a training sample.
OPPONENTS = 8

_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{}~[]", np.uint8)
_STOPS = np.frombuffer(b".,;:'\"()-?", np.uint8)
FEATURES = 30


def features(text: str | None) -> np.ndarray:
    """Surface features of a whole text: shares of character classes, repetition of words, word pairs and lines, lengths."""
    raw = (text or "").encode()
    n = len(raw)
    if not n:
        out = np.zeros(FEATURES)
        out[-1] = 1
        return out
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    m = len(words)
    shares = [c[65:91].sum(), c[97:123].sum(), c[48:58].sum(), c[_SYMBOLS].sum(), c[_STOPS].sum(), c[33], c[124], c[128:].sum(), c[32], c[10]]
    shares = [float(x) / n for x in shares]
    if m:
        h = np.fromiter(map(hash, words), np.int64, m)
        sizes = np.fromiter(map(len, words), np.int64, m)
        _, times = np.unique(h, return_counts=True)
        again = float((h[1:] == h[:-1]).sum()) / m
        with np.errstate(over="ignore"):
            pairs = h[1:] * np.int64(1_000_003) + h[:-1]
        twice = 1 - len(np.unique(pairs)) / max(m - 1, 1) if m > 1 else 0.0
        marks = sum(1 for w in words if not w[0:1].isalnum() and w[0] < 128) / m
        tails = sum(1 for w in words if w[-1] < 128 and not w[-1:].isalnum() and w[-1] not in b".,") / m
        vocabulary = np.log1p(len(times)) / np.log1p(m)
        spread = [len(times) / m, vocabulary, times.max() / m, again, twice, marks, tails, sizes.mean() / 10, sizes.std() / 10]
    else:
        spread = [0.0] * 9
    lines = raw.split(b"\n")
    repeated = 1 - len(set(lines)) / len(lines)
    roots = [np.sqrt(shares[0]), np.sqrt(shares[3]), np.sqrt(shares[5]), np.sqrt(shares[6]), np.sqrt(spread[3]), np.sqrt(max(spread[4], 0)), np.sqrt(spread[6])]
    return np.array([*shares, *spread, repeated, np.log1p(m) / 10, np.log1p(n) / 10, *roots, 0.0])


def table(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), FEATURES)


@dataclass
class BradleyTerry:
    """score(x) = logistic((x - mean) / spread @ weights - threshold). Without labels of both kinds: 0.5 for all."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    @classmethod
    def fit(cls, x: np.ndarray, good: np.ndarray, ridge: float = 1e-3, seed: int = 7) -> "BradleyTerry":
        """x: a row of features for each document; good: whether its label is 1."""
        if good.all() or not good.any():
            return cls(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0)
        mean, spread = x.mean(axis=0), x.std(axis=0)
        spread = np.where(spread > 1e-9, spread, 1.0)
        z = (x - mean) / spread
        draw = np.random.default_rng(seed)
        up, down = np.flatnonzero(good), np.flatnonzero(~good)
        winners = np.concatenate((np.repeat(up, OPPONENTS), draw.choice(up, OPPONENTS * len(down))))
        losers = np.concatenate((draw.choice(down, OPPONENTS * len(up)), np.repeat(down, OPPONENTS)))
        weights = np.zeros(FEATURES)
        for _ in range(30):
            gradient, hessian = ridge * weights, ridge * np.eye(FEATURES)
            for at in range(0, len(winners), 20_000):
                d = z[winners[at : at + 20_000]] - z[losers[at : at + 20_000]]
                p = 1 / (1 + np.exp(np.clip(d @ weights, -35, 35)))
                gradient = gradient - d.T @ p / len(winners)
                hessian = hessian + (d * (p * (1 - p))[:, None]).T @ d / len(winners)
            step = np.linalg.solve(hessian, gradient)
            weights = weights - step / max(1.0, float(np.abs(step).max()) / 2)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, spread, weights, float(np.quantile(z @ weights, 1 - good.mean())))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.spread @ self.weights - self.threshold, -35, 35)))


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> BradleyTerry:
    """Learns from documents whose labels.quality is 0 or 1 and whose crc32(doc_id) mod 3 is not 1.

    Ids that are null or have no document and labels that are neither take no part. Equal labels
    count once, and of documents with one id that with the smallest text.
    """
    ship(docs.sparkSession)
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", 3) != 1)).distinct()
    there = usable.count()
    if there > sample:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * sample / there))
    rows = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")  # at most about `sample` ids

    @F.arrow_udf("array<double>")
    def features_of(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))

    one = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    got = one.select("quality", features_of("text").alias("x"), "doc_id").collect()
    got.sort(key=lambda r: (r.doc_id, r.quality, r.x))
    return BradleyTerry.fit(np.array([r.x for r in got]).reshape(len(got), FEATURES), np.array([r.quality == 1 for r in got], bool))


def classify(docs: DataFrame, model: BradleyTerry, text: str = "text") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= 0.5, else 0). Null and empty texts are scored
    as empty. Rows stand alone; columns named score or predicted are replaced, all others pass."""
    shared = broadcast(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        found = [shared.value.score(table([t.as_py() for t in texts[at : at + 512]])) for at in range(0, len(texts), 512)]
        return pa.array(np.concatenate(found) if found else np.empty(0), pa.float64())

    return docs.withColumn("score", score_of(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    return classify(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
