"""Quality rules: gradient-boosted trees over document statistics.

Each whole text becomes a row of statistics.  A base rule rejects very short
texts and texts in which more than 30 % of the words stand in repeated
8-word windows.  What passes is judged by boosted trees, fitted in numpy on a
bounded sample of labelled documents and flattened into node arrays, so that
a batch of documents descends a tree in a few array operations.  On the
features of ``DIRECTION`` the score is monotone: more symbols, repeats or
duplicate lines never raise it.

Words are runs of characters other than space, tab, newline, vertical tab,
form feed and carriage return.

Defined cases: a null text has no words, like an empty one, and fails the
base rule; repeated rows get equal verdicts; without labelled rows of both
classes the trees are empty and only the base rule rejects.  Further columns,
whatever their names, pass unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.labelled import sigmoid, training_sample

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
THRESHOLD = 0.3
PER_CLASS = {0: 5000, 1: 10000}  # bound of the sample; only its statistics reach the driver

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate",
            "stop_rate", "pipe_rate", "line_words", "distinct_rate", "ditto_rate")
# -1: a larger value never raises the score.  Where nothing is said, trees are free.
DIRECTION = {"symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "ditto_rate": -1}

_SPACE = np.frombuffer(b" \t\n\v\f\r", np.uint8)
_SYMBOL = np.frombuffer(b"#*$%&|<>", np.uint8)
_STOP = np.frombuffer(b".!?", np.uint8)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that stand in a window of ``window`` words (a power of two) found
    twice or more.  Windows are numbered exactly, by doubling: those of 2n
    words from pairs of those of n, so that no hash decides."""
    if len(ids) <= window:
        return 0
    number, span = ids.astype(np.int64), 1
    while span < window:
        pair = number[:-span] * (int(number.max()) + 1) + number[span:]
        kinds, number = np.unique(pair, return_inverse=True)
        if len(kinds) == len(pair):  # no two windows are equal: longer ones aren't either
            return 0
        span *= 2
    starts = np.flatnonzero(np.bincount(number)[number] > 1)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """COUNTS and FEATURES of a whole text."""
    raw = (text or "").encode()
    words = raw.split()
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(byte.sum() - byte[128:192].sum() - byte[_SPACE].sum())  # UTF-8 continuation bytes start no character
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()] if words else []
    n, duplicate, repeat = len(words), len(lines) - len(set(lines)), repeated_words(ids)
    symbols = int(byte[_SYMBOL].sum())
    per_word, per_char = 1 / max(n, 1), 1 / max(chars, 1)
    return ((n, chars, symbols, duplicate, repeat),
            (np.log1p(n), chars * per_word, symbols * per_char, duplicate / max(len(lines), 1), repeat * per_word,
             byte[65:91].sum() * per_char, byte[48:58].sum() * per_char, byte[_STOP].sum() * per_word,
             byte[124] * per_word, n / max(len(lines), 1), len(number) * per_word,
             np.count_nonzero(ids[1:] == ids[:-1]) * per_word))


@dataclass(frozen=True)
class Trees:
    """Flattened trees: node i of tree t sends a row to ``left[t, i]`` if its
    feature is at most the threshold, else to the node after it; leaves point to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                leaf = self.left[t, at] == at
                at = np.where(leaf, at, self.left[t, at] + (x[rows, self.feature[t, at]] > self.threshold[t, at]))
            total += self.value[t, at]
        return sigmoid(total)


def boost(x: np.ndarray, y: np.ndarray, direction: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3,
          bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Histogram gradient boosting of the logistic loss.  A split on a
    directed feature is taken only if its two sides' values stand in that
    order, and its midpoint bounds what the subtrees may answer; so the sum of
    trees is monotone."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, x.T)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin, nodes = np.full(len(y), base), 2 ** (depth + 1) - 1
    feature = np.zeros((trees, nodes), np.int32)
    threshold, value = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    left = np.tile(np.arange(nodes, dtype=np.int32), (trees, 1))
    for t in range(trees):
        p = sigmoid(margin)
        grad, hess, free = p - y, p * (1 - p), 1
        open_ = [(0, np.arange(len(y)), 0, -np.inf, np.inf)]
        while open_:
            node, rows, level, low, high = open_.pop()
            g, h = grad[rows], hess[rows]
            value[t, node] = rate * np.clip(-g.sum() / (h.sum() + l2), low, high)
            margin[rows] += value[t, node]
            best = (1e-6, None)
            for f in range(x.shape[1]) if level < depth else ():
                gl = np.cumsum(np.bincount(binned[rows, f], weights=g, minlength=len(cuts[f]) + 1))
                hl = np.cumsum(np.bincount(binned[rows, f], weights=h, minlength=len(cuts[f]) + 1))
                gr, hr = gl[-1] - gl[:-1], hl[-1] - hl[:-1]
                gain = gl[:-1] ** 2 / (hl[:-1] + l2) + gr**2 / (hr + l2) - gl[-1] ** 2 / (hl[-1] + l2)
                a, b = np.clip(-gl[:-1] / (hl[:-1] + l2), low, high), np.clip(-gr / (hr + l2), low, high)
                ok = (hl[:-1] >= least) & (hr >= least) & (direction[f] * (b - a) >= 0)
                if ok.any() and (k := int(np.argmax(np.where(ok, gain, -1)))) >= 0 and gain[k] > best[0] and ok[k]:
                    best = (gain[k], f, k, (a[k] + b[k]) / 2)
            if best[1] is None:
                continue
            _, f, k, mid = best
            margin[rows] -= value[t, node]
            feature[t, node], threshold[t, node], left[t, node] = f, cuts[f][k], free
            goes = binned[rows, f] <= k
            bound = {-1: ((mid, high), (low, mid)), 0: ((low, high),) * 2, 1: ((low, mid), (mid, high))}[int(direction[f])]
            for side, (rows_, limits) in enumerate(((rows[goes], bound[0]), (rows[~goes], bound[1]))):
                open_.append((free + side, rows_, level + 1, *limits))
            free += 2
    return Trees(feature, threshold, left, value, depth, base)


_TYPE = ", ".join([f"{c} long" for c in COUNTS] + [f"{f} double" for f in FEATURES])


def _table(texts: pd.Series) -> pd.DataFrame:
    rows = [statistics(t) for t in texts]
    return pd.DataFrame([(*c, *f) for c, f in rows], columns=[*COUNTS, *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: dict[int, int] = PER_CLASS) -> Trees | None:
    """Fit on the statistics of at most ``per_class`` labelled documents
    outside the held-out fold; None without both classes."""
    sample, counts = training_sample(docs, labels, label, per_class)
    if not counts.get(0) or not counts.get(1):
        return None
    table = F.pandas_udf(_table, _TYPE)
    rows = sample.select("doc_id", "label", table("text").alias("s")).select("doc_id", "label", "s.*").toPandas()
    rows = rows.sort_values(["doc_id", *FEATURES])
    return boost(rows[list(FEATURES)].to_numpy(float), rows["label"].to_numpy(float),
                 np.array([DIRECTION.get(f, 0) for f in FEATURES]))


def judge(model: Trees | None, text: str | Column, spark) -> Column:
    """Struct of COUNTS, base_failed, quality (score of the trees) and kept."""
    shared = spark.sparkContext.broadcast(model)  # some thousand nodes

    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trees = shared.value
        for texts in batches:
            out = _table(texts)
            out["base_failed"] = (out.n_words < MIN_WORDS) | (100 * out.n_repeat_words > MAX_REPEAT_PERCENT * out.n_words)
            out["quality"] = trees.score(out[list(FEATURES)].to_numpy(float)) if trees else 1.0
            out["kept"] = ~out.base_failed & (out.quality >= THRESHOLD)
            yield out[[*COUNTS, "base_failed", "quality", "kept"]]

    kind = ", ".join([f"{c} long" for c in COUNTS]) + ", base_failed boolean, quality double, kept boolean"
    return F.pandas_udf(judged, kind)(text)


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, quality and kept of every document."""
    model = fit(docs, labels)
    return docs.select("doc_id", judge(model, F.coalesce("text", F.lit("")), docs.sparkSession).alias("s")).select("doc_id", "s.*")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, columns as given."""
    model = fit(docs, labels)
    return docs.where(judge(model, F.coalesce("text", F.lit("")), docs.sparkSession)["kept"])
