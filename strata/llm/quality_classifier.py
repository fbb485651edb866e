"""Quality classifier: supervised subword embeddings.

A word (run of characters other than ASCII white space) stands for its own
hashed vector and those of its character n-grams; a document is the average
of its words' averages, and a softmax on that gives the class.  A word that
repeats the one before it counts as the word DITTO.  Vectors and
softmax are learned by stochastic gradient descent in numpy on a bounded
sample of labelled documents.

The model is linear in the document's average, so a word counts by one
number, the projection of its average on the difference of the two classes'
outputs.  Workers keep these numbers by word and score whole texts.

Defined cases: a null text scores like an empty one, which has no word and
scores the bias alone; repeated rows score alike; with labelled rows of no or
one class the score is that class (1 where nothing is labelled).  Further
columns, whatever their names, pass unread.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import held_out, sigmoid, training_sample

BUCKETS = 1 << 17
DIM = 16
GRAMS = (3, 4)  # characters of an n-gram; words are bracketed with < and >
PER_CLASS = {0: 1500, 1: 3000}  # bound of the sample
DITTO = b" same"  # no word holds a space
WORDS_KEPT = 400_000  # words a worker keeps numbers of; beyond it starts anew
TOGETHER = 100_000  # words of the texts that are scored together, about
THRESHOLD = 0.3


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _place(hashed: np.ndarray) -> np.ndarray:
    return ((hashed ^ (hashed >> np.uint64(32))) * _MIX >> np.uint64(40)).astype(np.int64) % BUCKETS


def word_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, bucket) of the words and of their character
    n-grams, those of all words hashed at once; by rising number."""
    texts = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(size)
    word = np.repeat(np.arange(len(texts)), size)
    left = np.repeat(end, size) - np.arange(len(codes))  # characters to the word's end, this one included
    # a whole word: its characters times the powers of their places, added up
    powers = np.cumprod(np.full(int(size.max()), _MIX))
    owner, bucket = [np.arange(len(texts))], [_place(np.add.reduceat(codes * powers[left - 1], end - size))]
    gram = codes
    for n in range(2, max(GRAMS) + 1):
        gram = (gram[:-1] * _MIX ^ (gram[:-1] >> np.uint64(29))) + codes[n - 1:]
        if n in GRAMS:
            at = np.flatnonzero((left[:len(gram)] >= n) & (size[word[:len(gram)]] > n))
            owner.append(word[at])
            bucket.append(_place(gram[at] + np.uint64(n)))
    owner, bucket = np.concatenate(owner), np.concatenate(bucket)
    order = np.argsort(owner, kind="stable")
    return owner[order], bucket[order].astype(np.int32)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; one equal to its predecessor becomes DITTO."""
    words = (text or "").encode().split()
    return [DITTO if a == b else b for a, b in zip([None, *words], words)]


def document_bag(text: str | None, known: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights in its average; ``known``
    keeps the buckets of words."""
    words = Counter(words_of(text))
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    if len(known) > WORDS_KEPT:
        known.clear()
    if new := [w for w in words if w not in known]:
        owner, bucket = word_buckets(new)
        known.update(zip(new, np.split(bucket, np.searchsorted(owner, np.arange(1, len(new))))))
    own = [known[w] for w in words]
    weight = np.concatenate([np.full(len(b), n / len(b)) for b, n in zip(own, words.values())])
    bucket, inverse = np.unique(np.concatenate(own), return_inverse=True)
    return bucket, (np.bincount(inverse, weights=weight) / sum(words.values())).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    projection: np.ndarray  # of each bucket's vector on the difference of the outputs
    bias: float
    known: dict[bytes, float] = field(default_factory=dict)  # a worker's numbers of words

    def score(self, texts: list[str | None]) -> list[float]:
        """Of whole texts; the numbers of their new words are worked out together."""
        known, out = self.known, []
        first = 0
        while first < len(texts):
            split, size = [], 0
            while first < len(texts) and size < TOGETHER:
                split.append(words_of(texts[first]))
                size += len(split[-1])
                first += 1
            if len(known) > WORDS_KEPT:
                known.clear()
            if new := list({w for words in split for w in words if w not in known}):
                owner, bucket = word_buckets(new)
                known.update(zip(new, (np.bincount(owner, weights=self.projection[bucket]) / np.bincount(owner)).tolist()))
            mean = [sum(map(known.__getitem__, words)) / len(words) if words else 0.0 for words in split]
            out += sigmoid(np.array(mean) + self.bias).tolist()
        return out


def train(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray,
          epochs: int = 6, least_steps: int = 20_000, rate: float = 0.5, seed: int = 7) -> QualityModel:
    """Stochastic gradient descent, one document a step, rate falling to 0;
    small samples are gone over more often."""
    epochs = max(epochs, -(-least_steps // len(y)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    output, bias = np.zeros((2, DIM), np.float32), np.zeros(2)
    steps, step = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            bucket, share = bags[i]
            now = rate * (1 - step / steps) * weight[i]
            step += 1
            mean = share @ vectors[bucket]
            z = output @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1.0
            back = p.astype(np.float32) @ output
            output -= now * np.outer(p, mean).astype(np.float32)
            bias -= 0.1 * now * p
            # the average holds many rows, each with a small share: a step scaled by the shares' norm
            vectors[bucket] -= (now / max(float(share @ share), 1e-6)) * 0.05 * np.outer(share, back)
    return QualityModel((vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: dict[int, int] = PER_CLASS) -> QualityModel:
    """Fit on at most ``per_class`` labelled documents outside the held-out
    fold; classes weigh as often as they are labelled."""
    sample, counts = training_sample(docs, labels, label, per_class)
    if not counts.get(0) or not counts.get(1):
        return QualityModel(np.zeros(BUCKETS, np.float32), -30.0 if counts.get(0) else 30.0)

    @F.pandas_udf("bucket array<int>, share array<float>")
    def bags(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, np.ndarray] = {}
        for texts in batches:
            yield pd.DataFrame([document_bag(t, known) for t in texts], columns=["bucket", "share"])

    rows = sample.select("doc_id", "label", bags("text").alias("bag")).toArrow().sort_by("doc_id")
    y = rows["label"].to_numpy()
    bag = rows["bag"].combine_chunks()
    ends = np.cumsum(bag.field("bucket").value_lengths().to_numpy())[:-1]
    held = list(zip(np.split(bag.field("bucket").flatten().to_numpy(), ends),
                    np.split(bag.field("share").flatten().to_numpy(), ends)))
    taken = np.bincount(y, minlength=2)
    share = np.array([counts[k] / taken[k] for k in (0, 1)])
    share *= len(y) / (share * taken).sum()
    return train(held, y, share[y])


def score(model: QualityModel, text: str | Column, spark) -> Column:
    """Probability that a whole text is of good quality."""
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers, whatever the corpus

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series(own.score(texts.tolist()), dtype=float)

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.3) per document."""
    model = fit(docs, labels)
    scored = docs.select("doc_id", score(model, F.coalesce("text", F.lit("")), docs.sparkSession).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
