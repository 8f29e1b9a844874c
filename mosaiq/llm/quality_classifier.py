"""Quality classifier: Bradley-Terry scores learned from pairs of which one document is preferred.

A document's strength is a weighted sum of its features. Of two documents of which one is labelled good the good one is
preferred; the weights are those of least logistic loss on the differences of features. The strength at a quantile of
the labelled ones becomes the threshold, and scores are placed so that it lies at THRESHOLD.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaiq.llm.common import WORD, arrow_map, text_of

THRESHOLD = 0.3
#: The labelled rows that a fit takes at most, those first by a hash of their doc_id.
SAMPLE = 20_000
PAIRS = 200_000
FEATURES = (
    "log_words", "symbols", "capitals", "digits", "marks", "repeats5", "twice", "dup_lines", "distinct",
    "word_length", "long_words", "line_words", "top_word", "no_letters", "stops",
)
_WORD = re.compile(WORD)
_SYMBOL, _CAPITAL, _DIGIT, _MARK, _STOP = (re.compile(x) for x in (r"[#*$%&|<>{}\\^~=@_]", r"[A-ZÀ-ÖØ-Þ]", r"[0-9]", r"[!?]", r"[.,;:]"))


def features(text: str) -> list[float]:
    """The statistics of a whole text. An empty text has zeros."""
    words = _WORD.findall(text)
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    fives = [*zip(words, words[1:], words[2:], words[3:], words[4:], strict=False)]
    seen = Counter(fives)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    length = [len(w) for w in words]
    ratio = lambda x, scale: float(np.log1p(scale * x))
    return [
        float(np.log1p(n)),
        ratio(len(_SYMBOL.findall(text)) / n, 20),
        ratio(len(_CAPITAL.findall(text)) / chars, 20),
        ratio(len(_DIGIT.findall(text)) / chars, 20),
        ratio(len(_MARK.findall(text)) / n, 20),
        ratio(sum(c for c in seen.values() if c > 1) / max(1, len(fives)), 20),
        ratio(sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, 20),
        ratio(1 - len(set(lines)) / max(1, len(lines)), 20),
        len(counts) / n,
        abs(sum(length) / n - 5.1),
        ratio(sum(x > 25 for x in length) / n, 20),
        float(np.log1p(n / max(1, len(lines)))),
        max(counts.values()) / n * min(1.0, n / 50),
        ratio(sum(w[0].lower() == w[0].upper() for w in words) / n, 20),
        ratio(len(_STOP.findall(text)) / n, 5),
    ]


@dataclass
class Model:
    """Weights over standardised features; a strength of `cut` scores THRESHOLD."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(at + self.slope * (self.strength(x) - self.cut), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 5, rounds: int = 400, ridge: float = 1e-3) -> Model:
    """By gradient steps on the loss of `pairs` seeded pairs (good, bad). Without both labels every score is above the threshold."""
    k = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if not len(y) or y.min() == y.max():
        none = -1.0 if not len(y) or y.max() else 1.0
        return Model(np.zeros(k), np.ones(k), np.zeros(k), none, 1.0)
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.clip((x - centre) / scale, -6, 6)
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w, m, v = np.zeros(k), np.zeros(k), np.zeros(k)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        g = -(diff * p[:, None]).mean(0) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    s = z @ w
    # The threshold is the quantile that leaves as many below as are labelled bad, or the one nearby that splits best.
    order = np.argsort(s, kind="stable")
    below_bad = np.concatenate([[0], np.cumsum(y[order] == 0)])
    below_good = np.concatenate([[0], np.cumsum(y[order] == 1)])
    right = below_bad / len(bad) + (len(good) - below_good) / len(good)
    q = int(np.argmax(right))
    lo, hi = s[order[max(0, q - 1)]], s[order[min(len(s) - 1, q)]]
    spread = max(1e-6, float(np.std(s)))
    return Model(centre, scale, w, float((lo + hi) / 2), 2.0 / spread)


def _held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from labelled rows that are not held out: at most `sample` of them, a documented bound on what is gathered."""
    train = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).where(~_held_out()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    train = train.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(train), "doc_id")  # at most `sample` small rows

    def per_slice(batch: pa.RecordBatch):
        found = [features(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    got = arrow_map(rows.select("text", "quality"), per_slice, "x array<double>, y int").collect()
    got.sort(key=lambda r: (r["x"], r["y"]))
    return fit(np.array([r["x"] for r in got], dtype=float).reshape(len(got), len(FEATURES)), np.array([r["y"] for r in got], dtype=int))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.

    The score depends on the text alone. Nulls: a null text scores as an empty one, a null doc_id is not held out. Equal
    texts score alike; a score at the threshold counts as good. An empty table gives an empty one; other columns are left
    aside. Texts of any length are read whole, in slices of bounded size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers

    def per_slice(batch: pa.RecordBatch):
        x = np.array([features(t) for t in batch.column(1).to_pylist()], dtype=float).reshape(batch.num_rows, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = arrow_map(docs.select("doc_id", text_of(docs).alias("text")), per_slice, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
