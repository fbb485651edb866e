"""Toxicity: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios.

A text is lower-cased, its white space is folded to single spaces and its
character n-grams (of the code points, across word borders) are hashed into
``2**BITS`` buckets; a feature is the root of a bucket's rate (occurrences per
1000 characters) times its log-count ratio between the two classes.  The weights of a logistic regression on these
features are fitted in numpy on a bounded sample of labelled documents; every
document is then scored whole by an Arrow-batched column function.

Defined cases: a null text scores like an empty one; an empty text has no
n-gram and scores the bias alone; repeated rows score alike; without labelled
rows every score is 0; with rows of one class only it is that class's share.
Further columns of the input, whatever their names, pass unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import held_out, sigmoid, training_sample

BITS = 20
ORDERS = (4, 5, 6)
PER_CLASS = {1: 2000, 0: 4000}  # bound of the sample the classifier is fitted on
MAX_FEATURES = 1 << 15
BLOCK = 1 << 17  # entries of the sample's features that are summed at once
CHUNK = 1 << 20  # characters hashed at once: bounds the memory for a very long text

_STEP, _MIX = np.uint32(0x01000193), np.uint32(2654435761)


def _buckets(codes: np.ndarray) -> list[np.ndarray]:
    """Bucket of each n-gram of ``codes``, one array for each order."""
    out, g = [], codes
    for n in range(2, max(ORDERS) + 1):
        if len(codes) < n:
            break
        g = g[:-1] * _STEP + codes[n - 1:]
        if n in ORDERS:
            x = (g ^ (g >> np.uint32(15))) * _MIX + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
            out.append(x >> np.uint32(32 - BITS))
    return out


def ngram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """Arrays of buckets that together hold every n-gram of the text."""
    codes = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, max(1, len(codes) - 2), CHUNK):
        yield from _buckets(codes[at:at + CHUNK + max(ORDERS) - 1])


def present(text: str | None) -> np.ndarray:
    """The distinct buckets of the text's n-grams."""
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *ngram_buckets(text)]))


def rates(text: str | None, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The wanted buckets among a text's n-grams, and the root of their rates."""
    found = [b[wanted[b]] for b in ngram_buckets(text)]
    bucket, times = np.unique(np.concatenate([np.zeros(0, np.uint32), *found]), return_counts=True)
    return bucket, np.sqrt(times * (1000.0 / max(1, len(text or ""))))


@dataclass
class ToxicityModel:
    weights: np.ndarray  # by bucket, float32; 0 where the bucket is no feature
    bias: float

    @cached_property
    def wanted(self) -> np.ndarray:
        return self.weights != 0

    def score(self, text: str | None) -> float:
        bucket, rate = rates(text, self.wanted)
        return float(sigmoid(float(self.weights[bucket] @ rate) + self.bias))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: dict[int, int] = PER_CLASS,
        passes: int = 80, rate: float = 0.02, prior: float = 5.0) -> ToxicityModel:
    """Fit on about ``per_class`` labelled documents outside the held-out
    fold.  The executors count the buckets of each class; at most ``2**BITS``
    counts reach the driver, then the features of the sample.  ``prior`` is the
    strength of the weights' Gaussian prior, the same whatever the sample."""
    sample, counts = training_sample(docs, labels, label, per_class)
    none = np.zeros(1 << BITS, np.float32)
    if not counts.get(0) or not counts.get(1):
        return ToxicityModel(none, 30.0 if counts.get(1) else -np.inf)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, y in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                n[y, present(text)] += 1
        found = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[0, found]), pa.array(n[1, found])], names=["bucket", "n0", "n1"])

    total = (sample.select("text", "label").mapInArrow(count, "bucket long, n0 long, n1 long")
             .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
             .where(F.col("n0") + F.col("n1") > 1).toArrow())
    neg, pos = (np.zeros(1 << BITS) for _ in range(2))
    neg[total["bucket"].to_numpy()], pos[total["bucket"].to_numpy()] = total["n0"].to_numpy(), total["n1"].to_numpy()
    # naive Bayes log-count ratio of each bucket, add-one smoothed
    ratio = np.log((pos + 1) / (pos.sum() + len(pos))) - np.log((neg + 1) / (neg.sum() + len(neg)))
    strength = np.abs(ratio) * np.sqrt(pos + neg)
    feature = strength > (np.partition(strength, -MAX_FEATURES)[-MAX_FEATURES])
    place = (np.cumsum(feature) - 1).astype(np.int32)
    ratio = ratio[feature]
    del total, neg, pos, strength  # the driver has little memory: the sample's features come next

    @F.pandas_udf("at array<int>, rate array<float>")
    def features(texts: pd.Series) -> pd.DataFrame:
        found = [rates(t, feature) for t in texts]
        return pd.DataFrame({"at": [place[b] for b, _ in found], "rate": [r.astype(np.float32) for _, r in found]})

    rows = sample.select("doc_id", "label", features("text").alias("f")).toArrow().sort_by("doc_id")
    y = rows["label"].to_numpy().astype(float)
    held = rows["f"].combine_chunks()
    col, found, size = held.field("at").flatten().to_numpy(), held.field("rate").flatten().to_numpy(), held.field("at").value_lengths().to_numpy()
    del rows, held
    pa.default_memory_pool().release_unused()
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])

    def blocks():
        """(first row, end, row within the block, column, value of each of
        its entries): rows of about BLOCK entries at once, so that only the
        Arrow buffers grow with the sample."""
        a = 0
        while a < len(y):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + BLOCK, side="right")) - 1)
            at = col[ends[a]:ends[b]]
            yield a, b, np.repeat(np.arange(b - a), size[a:b]), at, ratio[at] * found[ends[a]:ends[b]]
            a = b

    # logistic regression by Adam over the whole sample
    margin = np.empty(len(y))
    v = np.zeros(int(feature.sum()))
    m, s, bias = np.zeros_like(v), np.zeros_like(v), 0.0
    for k in range(1, passes + 1):
        total = np.zeros(len(v))
        for a, b, row, at, value in blocks():
            margin[a:b] = np.bincount(row, weights=v[at] * value, minlength=b - a)
        error = sigmoid(margin + bias) - y
        for a, b, row, at, value in blocks():
            np.add.at(total, at, error[a:b][row] * value)  # in the order of the entries, whatever the blocks
        g = total / len(y) + prior / len(y) * v
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        v -= rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-8)
        bias -= 0.5 * error.mean()
    weights = none.copy()
    weights[feature] = v * ratio
    return ToxicityModel(weights, float(bias))


def score(model: ToxicityModel, text: str | Column, spark) -> Column:
    """Toxicity of each whole text, 0 to 1.  The broadcast model holds
    ``2**BITS`` weights, whatever the corpus."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield texts.map(own.score).astype(float)

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5) per document."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", score(model, F.coalesce("text", F.lit("")), docs.sparkSession).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose toxicity is below the threshold, columns as given."""
    model = fit(docs, labels)
    return docs.where(score(model, F.coalesce("text", F.lit("")), docs.sparkSession) < threshold)
