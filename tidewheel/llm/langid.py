"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is the mean over n = 1..3 of the cosine of their sets of character n-grams
(presence, not counts), over lower-cased letters with one space between words. Landmarks (Nyström)
are a bounded sample of learned texts; a text's kernel row against all landmarks is one row of the
product of two presence matrices. One-versus-rest kernel ridge regression in the landmarks' space
gives a value per language, and the largest wins.

The fit uses about PER_LANGUAGE rows of each language (uniform by the id's hash) and SAMPLE in all,
and as landmarks LANDMARKS of each and MARKS in all; its cost and what is broadcast grow neither with
the corpus nor with the number of lang values. The landmarks' matrix is kept sparse but for the
n-grams that many of them hold. Prediction reads whole texts in one pass, in batches, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.quality import remainder
from tidewheel.llm.shared import broadcast, looked_up, ship, written

#: Rows of each language that a fit learns from, and of these the landmarks (about: the hash decides); where there
#: are so many languages that these would be more than SAMPLE rows or MARKS landmarks in all, a like share of each.
PER_LANGUAGE, LANDMARKS = 400, 24
SAMPLE, MARKS = 20_000, 512
#: An n-gram that one in so many landmarks hold is a column of the dense part of their matrix, which is therefore
#: at most so many times as large as the sparse one would be.
DENSE = 8
RIDGE = 1e-2
#: Languages up to which their counts are broadcast; more are joined by shuffle.
LANGUAGES = 10_000
#: Texts in one matrix product.
BATCH = 128
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def has_letter(text: str | None) -> bool:
    """Whether the text has a letter (superscripts, fractions and the like are none)."""
    return any(any(map(str.isalpha, m[0])) for m in _LETTERS.finditer(text or ""))


def grams(text: str | None) -> list[np.ndarray]:
    """Distinct character n-grams for n = 1, 2, 3, as numbers; empty arrays if the text has no letter."""
    runs = _LETTERS.findall((text or "").lower())
    if not runs:
        return [np.empty(0, np.uint64)] * 3
    one = np.frombuffer(f" {' '.join(runs)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    two = (one[:-1] << np.uint64(21)) | one[1:]
    three = (two[:-1] << np.uint64(21)) | one[2:]
    return [np.unique(one), np.unique(two), np.unique(three)]


class Landmarks:
    """Presence matrix of the landmarks over the n-grams that they hold, scaled so that a product with it is the kernel."""

    def __init__(self, texts: list[str]):
        sets = [grams(t) for t in texts]
        self.n = m = len(sets)
        self.known = [np.unique(np.concatenate([s[n] for s in sets])) if sets else np.empty(0, np.uint64) for n in range(3)]
        self.starts = np.concatenate(([0], np.cumsum([len(k) for k in self.known])))
        gram, row, value = self._presence(sets)
        times = np.bincount(gram, minlength=self.starts[-1])
        common = DENSE * times >= m
        self.column = np.where(common, np.cumsum(common) - 1, -1)
        self.dense = np.zeros((int(common.sum()), m), np.float32)
        self.dense[self.column[gram[common[gram]]], row[common[gram]]] = value[common[gram]]
        order = np.flatnonzero(~common[gram])
        order = order[np.argsort(gram[order], kind="stable")]
        self.marks, self.values = row[order].astype(np.int32), value[order]
        self.ends = np.cumsum(np.where(common, 0, times))

    def _presence(self, sets: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries of a matrix of a row per text over the known n-grams: 1 / sqrt(3 * its distinct n-grams) where
        present; as n-gram, row, value."""
        found, sizes, values = [np.empty(0, np.int64)], [], []
        for s in sets:
            for n in range(3):
                at = np.minimum(np.searchsorted(self.known[n], s[n]), max(len(self.known[n]) - 1, 0))
                found.append(self.starts[n] + (at[self.known[n][at] == s[n]] if len(self.known[n]) else at[:0]))
                sizes.append(len(found[-1]))
                values.append(1 / np.sqrt(3 * max(len(s[n]), 1)))
        return np.concatenate(found).astype(np.int64), np.repeat(np.repeat(np.arange(len(sets)), 3), sizes), np.repeat(np.array(values, np.float32), sizes)

    def kernel(self, texts: list[str | None]) -> np.ndarray:
        """The product of the texts' presence matrix with that of the landmarks."""
        gram, row, value = self._presence([grams(t) for t in texts])
        column = self.column[gram]
        rows = np.zeros((len(texts), len(self.dense)), np.float32)
        rows[row[column >= 0], column[column >= 0]] = value[column >= 0]
        out = rows @ self.dense
        gram, row, value = gram[column < 0], row[column < 0], value[column < 0]
        times = self.ends[gram] - np.where(gram > 0, self.ends[gram - 1], 0)
        at = np.arange(times.sum()) + np.repeat(self.ends[gram] - np.cumsum(times), times)
        rest = np.bincount(np.repeat(row, times) * self.n + self.marks[at], np.repeat(value, times) * self.values[at], minlength=len(texts) * self.n)
        return out + rest.reshape(len(texts), self.n).astype(np.float32)


@dataclass
class KernelRidge:
    """Languages, landmarks and the matrix from kernel rows to a value per language."""

    languages: list[str]
    landmarks: Landmarks
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def fit(cls, landmarks: Landmarks, own: np.ndarray, rows: np.ndarray, langs: list[str]) -> "KernelRidge":
        """own: kernel among the landmarks; rows: kernel of the learned texts against them."""
        languages = sorted(set(langs))
        y = np.where(np.array(langs, object)[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
        # one weight for each language, however many rows it has
        times = Counter(langs)
        share = np.sqrt(len(langs) / (len(languages) * np.array([times[x] for x in langs])))
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        keep = values > 1e-6 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        z = np.hstack([rows @ root, np.ones((len(rows), 1))]) * share[:, None]
        solved = np.linalg.solve(z.T @ z + RIDGE * np.eye(z.shape[1]), z.T @ (y * share[:, None]))
        return cls(languages, landmarks, root @ solved[:-1], solved[-1])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and how clearly it won: 0.5 plus a quarter of the lead, within 0 and 1."""
        langs, scores = [], []
        for at in range(0, len(texts), BATCH):
            part = texts[at : at + BATCH]
            if not self.languages:
                langs += [UNDETERMINED] * len(part)
                scores += [0.0] * len(part)
                continue
            values = self.landmarks.kernel(part) @ self.weights + self.bias
            best = values.argmax(axis=1)
            top = values[np.arange(len(part)), best]
            values[np.arange(len(part)), best] = -np.inf
            lead = top - (values.max(axis=1) if len(self.languages) > 1 else -1.0)
            for t, k, x in zip(part, best.tolist(), np.clip(0.5 + lead / 4, 0, 1).tolist()):
                letters = has_letter(t)
                langs.append(self.languages[k] if letters else UNDETERMINED)
                scores.append(float(x) if letters else 0.0)
        return langs, scores


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, sample: int = SAMPLE, marks: int = MARKS) -> KernelRidge:
    """Learns from text and non-null lang of rows whose crc32(doc_id) mod 4 is not 2.

    Rows without a text or a letter teach nothing; of rows with one id and lang the smallest text
    counts. per_language, landmarks: see PER_LANGUAGE; sample, marks: their bounds over all languages.
    A language of which no row is drawn is not learned. Without any row to learn from, every prediction is `und`.
    """
    spark = docs.sparkSession
    ship(spark)
    nothing = KernelRidge([], Landmarks([]), np.zeros((0, 0)), np.zeros(0))
    usable = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", 4) != 2))
    counts = usable.groupBy("lang").count()
    languages = counts.count()
    if not languages:
        return nothing
    known = usable.select("doc_id", "lang")
    # no row of a common language has to move
    known = known.join(F.broadcast(counts), "lang") if languages <= LANGUAGES else looked_up(known, counts, ["lang"], counts.withColumnRenamed("count", "n"))
    per_language, landmarks = min(per_language, sample / languages), min(landmarks, marks / languages)
    draw = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) * F.col("count") / (1 << 30)
    drawn = known.withColumn("draw", draw).filter(F.col("draw") < per_language).drop("count")
    ids = written(drawn.select("doc_id", "lang", "draw").distinct())  # about per_language rows of each language; a list from the driver would need Python workers of its own
    if ids.isEmpty():
        return nothing
    rows = usable.filter(F.col("text").rlike(r"\p{L}")).join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang", "draw").agg(F.min("text").alias("text"))
    drawn_marks = [r for r in rows.filter(F.col("draw") < landmarks).collect() if has_letter(r.text)]
    if not drawn_marks:  # so few rows that none falls below the landmarks' share
        drawn_marks = [r for r in rows.orderBy("draw", "lang", "doc_id").limit(int(max(landmarks, 1))).collect() if has_letter(r.text)]
    drawn_marks.sort(key=lambda r: (r.lang, r.doc_id, r.text))
    if not drawn_marks:
        return nothing
    built = Landmarks([r.text for r in drawn_marks])
    shared = broadcast(spark, built)

    @F.arrow_udf("array<float>")
    def rows_of(texts: pa.Array) -> pa.Array:
        parts = [shared.value.kernel([t.as_py() for t in texts[at : at + BATCH]]) for at in range(0, len(texts), BATCH)]
        return pa.array([row for p in parts for row in p], pa.list_(pa.float32()))

    got = rows.select("doc_id", "lang", rows_of("text").alias("k")).collect()
    got.sort(key=lambda r: (r.lang, r.doc_id, r.k))
    learned = np.array([r.k for r in got], np.float64).reshape(len(got), len(drawn_marks))
    return KernelRidge.fit(built, built.kernel([r.text for r in drawn_marks]).astype(np.float64), learned, [r.lang for r in got])


def identify(docs: DataFrame, model: KernelRidge, text: str = "text") -> DataFrame:
    """Adds lang_pred (a learned language; `und` if the text is null or has no letter) and score (0 to 1).

    Ties go to the language first in the alphabet. Rows stand alone; columns named lang_pred or
    score are replaced, all others pass.
    """
    shared = broadcast(docs.sparkSession, model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for at in range(0, len(texts), BATCH):
            a, b = shared.value.predict([t.as_py() for t in texts[at : at + BATCH]])
            langs += a
            scores += b
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    out = docs.withColumn("_predicted", predicted(F.col(text)))
    return out.withColumns({"lang_pred": F.col("_predicted.lang_pred"), "score": F.col("_predicted.score")}).drop("_predicted")


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs."""
    return identify(docs.select("doc_id", "text"), fit(docs)).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
