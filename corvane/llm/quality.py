"""Quality by positive-unlabelled learning: a logistic score minimising the non-negative unbiased risk.

Trusted positives are documents labelled good, the unlabelled text is the corpus itself, and the class
prior is estimated from the learning part of the labels. The fit is on a bounded sample (``sample`` rows of
each kind); scoring covers all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import batch, bounded_batches, text_of

SYMBOLS = b"#*$%&|<>"
N_FEATURES = 20
_UPPER = re.compile(r"[^\W\d_]*[A-Z][^\W\d_]*")


def features(text: str) -> list[float]:
    """Shares and logarithms that describe the form of a text; all finite, zeros for the empty text."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * N_FEATURES
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    symbols, upper, lower = int(count[list(SYMBOLS)].sum()), int(count[65:91].sum()), int(count[97:123].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], words[2:], strict=False)))
    top = max(lines, key=len)
    low = data.lower()
    ends = sum(x.rstrip().endswith((b".", b"!", b"?", b":", b'"')) for x in lines)
    return [
        np.log1p(n), symbols / n, min(1.0, symbols / size * 4), upper / max(1, upper + lower), float(count[33]) / n, float(count[124]) / n,
        float(count[48:58].sum()) / size, float(count[[46, 44]].sum()) / n, size / n / 10, np.log1p(n) * distinct / n, distinct / n,
        pairs / max(1, n - 2), len(set(lines)) / len(lines), ends / len(lines), np.log1p(len(lines)), len(top) / size,
        float(low.count(b"http")) / n, float(count[[123, 125, 59, 61]].sum()) / n, min(1.0, n / 50), float(n < 20),
    ]


@dataclass(frozen=True)
class Model:
    """Score = logistic of the standardised features, their squares included."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(expand((x - self.mean) / self.scale) @ self.weights, -30, 30)))


def expand(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -6, 6)
    return np.column_stack([np.ones(len(z)), z, z * z / 3])


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.02, decay: float = 1e-3) -> Model:
    """Adam on the non-negative risk: prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]), sigmoid loss.

    Where the negative part falls below zero its gradient is turned around, as the method prescribes.
    """
    every = np.concatenate([positive, unlabelled])
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-6
    p, u = expand((positive - mean) / scale), expand((unlabelled - mean) / scale)
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) for x in (p, u))
        dp, du = (x * (s * (1 - s))[:, None] for x, s in ((p, sp), (u, su)))
        rest = su.mean() - prior * sp.mean()  # sigmoid loss of calling negatives positive
        down = du.mean(axis=0) - prior * dp.mean(axis=0)
        grad = -prior * dp.mean(axis=0) + (down if rest >= 0 else -down) + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, w)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, margin: float = 0.01, doubt: float = 0.1) -> float:
    """The share of positives among the unlabelled, from these two alone (best bin estimate).

    A scorer is fitted on half of either. On the other halves, above any threshold, the unlabelled hold at least the prior's share of what
    the positives hold there; the threshold whose ratio is surely least, its error allowed for, gives the estimate.
    """
    model = fit(positive[::2], unlabelled[::2], 0.5, steps=600)
    p, u = (np.sort(model.score(x[1::2] if len(x) > 1 else x)) for x in (positive, unlabelled))
    at = np.unique(p)
    above_p, above_u = (1 - np.searchsorted(x, at) / len(x) for x in (p, u))
    error = sum(np.sqrt(np.log(4 / doubt) / (2 * len(x))) for x in (p, u))
    best = int(np.argmin((above_u + (1 + margin) * error) / above_p))
    return float(min(1.0, above_u[best] / above_p[best]))


def with_features(docs: DataFrame, extra: list[str], model: Model | None = None) -> DataFrame:
    """The extra columns and either the features or the score of each text."""
    bounded_batches(docs.sparkSession)
    frame = docs.select(*extra, text_of("text").alias("text"))
    kept = frame.drop("text").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + (", x array<double>" if model is None else ", score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(x) for x in b.column(b.num_columns - 1).to_pylist()]
            last = pa.array(rows, pa.list_(pa.float64())) if model is None else pa.array(model.score(np.array(rows).reshape(-1, N_FEATURES)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], last], names=[*kept.names, "x" if model is None else "score"])

    return frame.mapInArrow(run, ddl)


def held_out(doc_id: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text leaves remainder 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 6000, prior: float | None = None) -> Model:
    """Fit on at most ``sample`` positives and ``sample`` unlabelled documents, chosen by a hash of doc_id.

    Labels of held-out rows are not read, and of the others only which are positive. The prior is estimated from these two samples
    (``class_prior``) where none is given. Contradictory labels of one document count as its mean. Of several texts under
    one doc_id the least counts, so that the model is always the same. Without positives the score is 0.5 everywhere.
    """
    order = F.xxhash64("doc_id", F.lit(7))
    known = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("q"))
    good = [r.doc_id for r in known.where("q > 0.5").orderBy(order, "doc_id").limit(sample).select("doc_id").collect()]
    plain = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    free = [r.doc_id for r in plain.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(sample).collect()]
    if not good or not free:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES + 1))
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i, True) for i in good] + [(i, False) for i in free], "doc_id long, good boolean")
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    rows = with_features(texts, ["good"]).collect()
    p, u = np.array([r.x for r in rows if r.good]), np.array([r.x for r in rows if not r.good])
    if not len(p) or not len(u):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES + 1))
    return fit(p, u, class_prior(p, u) if prior is None else prior)


def score(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; a null text is scored as the empty one.

    Texts are scored whole, however long. Repeated rows and null ids stay, one result each; other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    model = learn(docs, labels, sample)
    scored = with_features(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"], model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> DataFrame:
    """The rows whose text scores 0.5 or more, with all their columns, whatever their names; null texts as in ``score``."""
    model = learn(docs, labels, sample)
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "") for t in b.column(at).to_pylist()]).reshape(-1, N_FEATURES)
            yield b.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
