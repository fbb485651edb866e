"""Periodic runs of words, by internal pattern matching.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``MIN_LENGTH`` and 2 q long, that no neighbouring word
extends keeping period q.

Dyadic blocks: the words from each multiple of m = 2^j on, m of them.  Sorting
suffixes by doubling gives the suffix array, and on the way the interval of
each block in it.  A run whose period lies in [2m, 4m) holds a whole block in
its first copy, so the block occurs again that far to the right: a block asks
for its occurrences in the neighbouring windows.  Occurrences are values of
the suffix array in the block's interval; a wavelet tree over it counts those
below a window's border, and gives the next ones by their rank.  Up to two
occurrences in a window each give a period.  Three and more are a progression
whose difference d is the block's own period; then the block and its
occurrences lie in two stretches of period d, and the run's period is the
distance of the stretches' right ends or of their left ends, or, where the
stretches meet, any distance of the progression.  Each candidate is extended to
both sides by comparing dyadic ranks, and kept if it is a run; of runs on the
same words the least period is its smallest.  Periods below 8 are asked for by
blocks of two words, all of whose occurrences within 7 words are candidates.

Everything is numpy on the words of many texts at once: words of different
texts never compare equal.

Defined cases: a null or empty text, or one without words, has no word and no
run (nulls; digests of nothing).  Repeated rows and rows with a shared id are
treated each; a null id is kept.  An empty table gives no row.  Texts are
whole; a text of any length is taken in one piece.  Further columns, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
GROUP = 100_000  # words of the texts that are looked at together, about
SMALL = 8  # periods below it are asked for by blocks of two words


class WaveletTree:
    """Of a sequence of whole numbers from 0 on: a bit of each number at a
    level, the highest first; at the next level those with 0 stand first."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros, self.before = [], []  # numbers with bit 0: all, and those before each place
        for level in range(self.bits - 1, -1, -1):
            zero = (values >> level) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.before.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def count_below(self, low, high, limit) -> np.ndarray:
        """How many numbers in the places [low, high) are below ``limit``."""
        out = np.where(limit >> self.bits > 0, high - low, 0)
        limit = np.where(limit >> self.bits > 0, 0, np.maximum(limit, 0))
        for depth, (zeros, before) in enumerate(zip(self.zeros, self.before)):
            one = (limit >> (self.bits - 1 - depth)) & 1 == 1
            a, b = before[low], before[high]
            out += np.where(one, b - a, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return out

    def nth(self, low, high, n) -> np.ndarray:
        """The n-th least number (from 0) in the places [low, high)."""
        out = np.zeros(len(low), np.int64)
        for depth, (zeros, before) in enumerate(zip(self.zeros, self.before)):
            a, b = before[low], before[high]
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            out |= one.astype(np.int64) << (self.bits - 1 - depth)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return out


class Suffixes:
    """Suffixes of the texts, sorted by doubling.  ``ranks[j][i]`` is the first
    place in the suffix array of those that begin with the 2^j words at i; the
    last level tells all suffixes apart."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        n = len(words)
        span = int(words.max(initial=0)) + 1
        key = text * span + words
        self.order = np.argsort(key, kind="stable")
        rank, again = self._ranked(key[self.order], np.arange(n))
        self.ranks = [np.empty(n + 1, np.int64)]
        self.ranks[0][self.order] = rank
        self.ranks[0][n] = -1
        end = np.searchsorted(text, text, side="right")  # of the text of each word
        active, width = np.flatnonzero(again), 1  # places of the order that are not alone
        self.sizes = [self._size(rank, active)]
        while len(active):
            last = self.ranks[-1]
            at = self.order[active]
            follow = at + width
            after = np.where(follow < end[at], last[np.minimum(follow, n)] + 1, 0)
            group = last[at]
            by = np.lexsort((after, group))
            at, after, group = at[by], after[by], group[by]
            self.order[active] = at
            fresh, again = self._ranked2(group, after, active)
            rank = last.copy()
            rank[at] = fresh
            self.ranks.append(rank)
            active, width = active[again], width * 2
            self.sizes.append(self._size(rank[self.order[active]], active, compact=True))

    @staticmethod
    def _ranked(key: np.ndarray, place: np.ndarray):
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        return Suffixes._first(new, place)

    @staticmethod
    def _ranked2(group: np.ndarray, after: np.ndarray, place: np.ndarray):
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        return Suffixes._first(new, place)

    @staticmethod
    def _first(new: np.ndarray, place: np.ndarray):
        """The first place of each class, and whether a class has others."""
        rank = np.maximum.accumulate(np.where(new, place, 0))
        alone = new & np.concatenate([new[1:], [True]]) if len(new) else new
        return rank, ~alone

    def _size(self, rank: np.ndarray, active: np.ndarray, compact: bool = False) -> np.ndarray:
        """Members of the class that begins at a place of the order; 0 where
        none with two or more begins."""
        size = np.zeros(len(self.order), np.int32)
        of = rank if compact else rank[active]
        if len(of):
            first, count = np.unique(of, return_counts=True)
            size[first] = count
        return size

    def forward(self, i: np.ndarray, k: np.ndarray) -> np.ndarray:
        """How many words are equal from i and from k on."""
        n, out = len(self.order), np.zeros(len(i), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[level], 1 << level
            same = (np.maximum(i, k) + out < n) & (rank[np.minimum(i + out, n)] == rank[np.minimum(k + out, n)])
            out[same] += width
        return out

    def backward(self, i: np.ndarray, k: np.ndarray) -> np.ndarray:
        """How many words are equal before i and before k."""
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[level], 1 << level
            a, b = i - out - width, k - out - width
            inside = np.minimum(a, b) >= 0
            same = inside & (rank[np.maximum(a, 0)] == rank[np.maximum(b, 0)])
            out[same] += width
        return out


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, value) of all values in the ranges [low, high)."""
    many = np.maximum(high - low, 0)
    of = np.repeat(np.arange(len(low)), many)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)


def _progressions(suffixes: Suffixes, at, d, f, low, high):
    """Candidate (place, period) of blocks at ``at`` whose occurrences from
    ``f`` on are a progression of difference d; periods in [low, high)."""
    right = at + d + suffixes.forward(at, at + d)
    left = at - suffixes.backward(at, at + d)
    right2 = f + d + suffixes.forward(f, f + d)
    left2 = f - suffixes.backward(f, f + d)
    places, periods = [at, at], [right2 - right, left2 - left]
    meet = np.flatnonzero((right >= left2) & (left < left2))  # any of the progression: the first in the window is f - at
    of, step = _spread(np.zeros(len(meet), np.int64), (high[meet] - 1 - (f[meet] - at[meet])) // d[meet] + 1)
    places.append(at[meet][of])
    periods.append((f - at)[meet][of] + step * d[meet][of])
    place, period = np.concatenate(places), np.concatenate(periods)
    fits = (period >= np.concatenate([low, low, low[meet][of]])) & (period < np.concatenate([high, high, high[meet][of]]))
    return place[fits], period[fits]


def find_runs(words: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH):
    """(start, length, period) of the runs, by start and then period.
    ``words``: whole numbers; ``text``: that each word belongs to, rising."""
    n = len(words)
    none = tuple(np.zeros(0, np.int64) for _ in range(3))
    if n < min_length:
        return none
    suffixes = Suffixes(words, text)
    # the wavelet tree holds the suffixes that begin with a pair of words found again
    if len(suffixes.sizes) < 2:
        return none
    pair, size = suffixes.ranks[1][:-1], suffixes.sizes[1]
    held = size[pair[suffixes.order]] > 0
    if not held.any():
        return none
    origin = np.concatenate([[0], np.cumsum(held)])  # place in the tree by place in the suffix array
    tree = WaveletTree(suffixes.order[held])
    end = np.searchsorted(text, text, side="right")

    places, periods = [], []
    level = 1
    while level < len(suffixes.ranks) and level < len(suffixes.sizes):
        m = 1 << level
        at = np.arange(0, n - m + 1, m)
        first = suffixes.ranks[level][at]
        size = suffixes.sizes[level][first]
        keep = (size > 1) & (at + m <= end[at])
        at, low = at[keep], origin[first[keep]]
        high = low + size[keep]
        if m == 2:
            windows = [(1, SMALL)]
        else:
            windows = [(2 * m, 3 * m), (3 * m, 4 * m)]
        below = {}
        for a, b in windows if len(at) else ():
            for border in (a, b):
                if border not in below:
                    below[border] = tree.count_below(low, high, at + border)
            many = below[b] - below[a]
            if m == 2:
                of, nth = _spread(below[a], below[b])
                places.append(at[of])
                periods.append(tree.nth(low[of], high[of], nth) - at[of])
                continue
            few = np.flatnonzero((many == 1) | (many == 2))
            of, nth = _spread(below[a][few], below[b][few])
            of = few[of]
            places.append(at[of])
            periods.append(tree.nth(low[of], high[of], nth) - at[of])
            lot = np.flatnonzero(many > 2)
            if len(lot):
                f = tree.nth(low[lot], high[lot], below[a][lot])
                d = tree.nth(low[lot], high[lot], below[a][lot] + 1) - f
                place, period = _progressions(suffixes, at[lot], d, f, np.full(len(lot), a), np.full(len(lot), b))
                places.append(place)
                periods.append(period)
        level += 1
    if not places:
        return none
    place, q = np.concatenate(places), np.concatenate(periods)
    # many blocks of a run give the same candidate: its furthest start to the left makes them one
    start = place - suffixes.backward(place, place + q)
    _, one = np.unique(start * (n + 1) + q, return_index=True)
    start, q = start[one], q[one]
    length = q + suffixes.forward(start, start + q)
    runs = length >= np.maximum(min_length, 2 * q)
    start, length, q = start[runs], length[runs], q[runs]
    order = np.lexsort((q, length, start))  # of runs on the same words the least period
    start, length, q = start[order], length[order], q[order]
    least = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])]) if len(start) else np.zeros(0, bool)
    start, length, q = start[least], length[least], q[least]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


REPORT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
_REPORT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                     ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
RUNS = "doc_id long, start long, length long, period long"
COLLAPSED = "doc_id long, n_words long, n_dropped long, text string"


def split(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space."""
    return (text or b"").split()


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of the reporting contract: of a tenth of the documents, by the
    crc32 of their id, the words from some place on are repeated in turn."""
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turns = -(-(n - a) // p)
    return words[:a] + (words[a:a + p] * turns)[:n - a]


def _found(ids: list, texts: list[list[bytes]]):
    """(id, words, starts, lengths, periods, kept) of each text."""
    numbers: dict[bytes, int] = {}
    flat = [numbers.setdefault(w, len(numbers)) for words in texts for w in words]
    many = np.array([len(words) for words in texts], np.int64)
    first = np.cumsum(many) - many
    text = np.repeat(np.arange(len(texts)), many)
    start, length, q = find_runs(np.array(flat, np.int64), text)
    drop = np.zeros(len(flat) + 1, np.int64)
    np.add.at(drop, start + q, 1)
    np.add.at(drop, start + length, -1)
    kept = np.cumsum(drop[:-1]) == 0
    borders = np.searchsorted(start, np.append(first, len(flat)))
    for k, (i, words) in enumerate(zip(ids, texts)):
        a, b, f = borders[k], borders[k + 1], first[k]
        yield i, words, start[a:b] - f, length[a:b], q[a:b], kept[f:f + many[k]]


def _report(i, words, start, length, q, kept) -> tuple:
    longest = (None,) * 4
    if len(start):
        k = int(np.lexsort((q, start, -length))[0])
        longest = (int(start[k]), int(length[k]), int(q[k]), 1000 * int(length[k]) // int(q[k]))
    runs = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), q.tolist()))
    left = words if kept.all() else [words[x] for x in np.flatnonzero(kept).tolist()]
    return (i, len(start), *longest, hashlib.sha256(runs.encode()).hexdigest(), hashlib.sha256(b" ".join(left)).hexdigest())


def _grouped(batches: Iterator[pa.RecordBatch], change):
    """What ``_found`` gives of the rows, taken together up to GROUP words."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            words = change(i, split(None if not text.is_valid else text.as_buffer().to_pybytes()))
            ids.append(i)
            texts.append(words)
            size += len(words)
            if size >= GROUP or len(ids) >= GROUP:
                yield from _found(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield from _found(ids, texts)


def _mapped(docs: DataFrame, schema: str, rows_of, change) -> DataFrame:
    """``rows_of`` each finding, in batches."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string()}[f.split()[1]] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], kind) for k, kind in enumerate(kinds)], names=names)

        for found in _grouped(batches, change):
            for row in rows_of(*found):
                held.append(row)
                size += 64 + (len(row[-1]) if isinstance(row[-1], str) else 0)
                if size > 1 << 22:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text")).mapInArrow(run, schema)


def _as_given(_, words):
    return words


def runs(docs: DataFrame) -> DataFrame:
    """RUNS of every document, in words."""
    return _mapped(docs, RUNS, lambda i, words, start, length, q, kept: zip([i] * len(start), start.tolist(), length.tolist(), q.tolist()), _as_given)


def collapse(docs: DataFrame) -> DataFrame:
    """COLLAPSED: every document with one copy of what a run repeats, its
    other words joined by a space."""
    def one(i, words, start, length, q, kept):
        return [(i, len(words), int((~kept).sum()), b" ".join([words[x] for x in np.flatnonzero(kept).tolist()]).decode())]
    return _mapped(docs, COLLAPSED, one, _as_given)


def report(docs: DataFrame, change=planted) -> DataFrame:
    """REPORT of every document, its words as ``change`` gives them."""
    return _mapped(docs, REPORT, lambda *found: [_report(*found)], change)
