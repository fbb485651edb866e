"""Licence scans: winnowed fingerprints of templates in an inverted index
pick candidates; banded alignment reports the matched coverage and spans.

Texts and templates become words (runs of letters and digits, lower-cased).
Hashes of ``K`` words in a row are winnowed: of each ``WINDOW`` neighbouring
hashes the least is kept (the rightmost of equals), so two texts that share
``K + WINDOW - 1`` words in a row share a fingerprint.  A document's
fingerprints are looked up in the index.  A template's hits are chained: place
after place both in the template and in the text, with no more words put in
between two of them than the template's slack; the chain with the most words,
less a hundredth of the words put in or left out, is a candidate place.

There the template is aligned in a band that follows the chain: from one hit to
the next the words between them, and at both ends the words beyond them as far
as the template goes.  So any number of words may be left out, and many be put
in or changed, as long as hits stand between.  Within a piece of the band the
longest common subsequence is taken, by bit-parallel rows.  A place counts if
the aligned words make up ``MIN_COVERAGE`` of the template.  The hits that a
place leaves over are chained again, so notices may follow each other.  Of places
of several templates that overlap, the one with the most words aligned less
those missing counts, unless they share no more than half of the other.

Templates are one-line notices, the standard notices that go at the head of a
file, and the whole texts in ``license_texts``.  AGPL and the Creative Commons
licences but CC0 have notices only.

Each document is scanned whole and alone, so nothing is shuffled.

Defined cases: a null or empty text has no match and gives no row of
``scan`` (``scan_documents`` gives it an empty list); repeated rows match
alike; templates with fewer than ``K`` words raise.  Further columns,
whatever their names, pass unread.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 3
WINDOW = 2
SLACK, LONG_SLACK, LONG = 6, 300, 100  # words put in between two hits, and that of templates of at least LONG words
MIN_COVERAGE = 0.7
WORDS_KEPT = 300_000

_WORD = re.compile(r"[^\W_]+")

WHOLE = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT",
         "MPL-2.0", "Unlicense")


def _gnu(what: str, kind: str, version: str, stop: str = ",") -> str:
    return (f"This {what} is free software{':' if stop == ',' else ';'} you can redistribute it and/or modify it under the terms of the GNU "
            f"{kind} License as published by the Free Software Foundation{stop} either version {version} of the License, or (at your "
            "option) any later version.")


def _creative_commons() -> dict[str, str]:
    """Short and full notices of the six licences in both usual versions."""
    parts, out = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}, {}
    for code in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        title = "-".join(parts[p] for p in code.split("-"))
        for version, where in (("4.0", "International"), ("3.0", "Unported")):
            out[f"CC-{code}-{version}"] = f"Licensed under CC {code} {version}."
            out[f"CC-{code}-{version}-full"] = f"This work is licensed under a Creative Commons {title} {version} {where} License."
    return out


# Usual wordings of licence notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files, to deal in the Software without restriction, including without "
                "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                "copies of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-full": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                       "except in compliance with the License. You may obtain a copy of the License at "
                       "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-full": _gnu("program", "General Public", "2", ";"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-full": _gnu("program", "General Public", "3"),
    "LGPL-2.0-full": _gnu("library", "Library General Public", "2", ";"),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-full": _gnu("library", "Lesser General Public", "2.1", ";"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-full": _gnu("library", "Lesser General Public", "3"),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-full": _gnu("program", "Affero General Public", "3"),
    # the opening of all BSD licences doesn't tell which
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "BSD-notice": "Released under the BSD License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "ISC": "Released under the ISC License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-full": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                    "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC0-1.0": "Released under CC0 1.0 Universal.",
    # without the name that stands after "law"
    "CC0-1.0-full": "To the extent possible under law, has waived all copyright and related or neighboring rights to this work.",
    "CC0-1.0-person": "To the extent possible under law, the person who associated CC0 with this work has waived all "
                      "copyright and related or neighboring rights to this work.",
}
CREATIVE_COMMONS = _creative_commons()
WHOLE_TEXTS = {f"{name}-whole": pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode() for name in WHOLE}
USUAL = TEMPLATES | CREATIVE_COMMONS | WHOLE_TEXTS  # what documents are scanned for


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Positions kept: of each WINDOW neighbours the least, rightmost first."""
    if len(hashes) <= WINDOW:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes[::-1], WINDOW)
    return len(hashes) - 1 - np.unique(np.arange(len(view)) + view.argmin(1))[::-1]


class _Hashes(dict):
    """A worker's hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def fingerprints(words: list[str], known: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes of K words and their positions."""
    if len(words) < K:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - K + 1
    gram = np.zeros(n, np.uint64)
    for i in range(K):
        gram = (gram ^ each[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
    at = winnow(gram)
    return gram[at], at


def align(template: np.ndarray, text: Iterable[int]) -> tuple[int, int]:
    """(words aligned, words of the text from its beginning that this takes):
    the longest common subsequence, and the shortest such part of the text.
    Bit i of a row is 0 where word i of the template adds to the length."""
    places: dict[int, int] = {}
    for i, word in enumerate(template.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(template)) - 1
    row, best, took = full, 0, 0
    for k, word in enumerate(text, 1):
        at = places.get(word)
        if at is None:
            continue
        hit = row & at
        row = ((row + hit) | (row - hit)) & full
        n = len(template) - row.bit_count()
        if n > best:
            best, took = n, k
            if n == len(template):
                break
    return best, took


def chain(template: np.ndarray, text: np.ndarray, slack: int, reach: int) -> np.ndarray:
    """Numbers of the hits (rising places in ``text``) of the best chain: both
    places rise, and from hit to hit the text goes on by no more than ``slack``
    words beyond the template, nor by more than ``reach`` words."""
    score, before = np.empty(len(text)), np.full(len(text), -1)
    first = 0
    for i in range(len(text)):
        while text[i] - text[first] > reach:
            first += 1
        t, x = template[i] - template[first:i], text[i] - text[first:i]
        drift = x - t
        worth = score[first:i] + np.minimum(K, np.minimum(t, x)) - np.abs(drift) / 100
        worth[(t <= 0) | (x <= 0) | (drift > slack)] = -np.inf
        score[i] = K
        if len(worth):
            k = len(worth) - 1 - int(worth[::-1].argmax())  # the nearest of equals
            if worth[k] > K:
                score[i], before[i] = worth[k], first + k
    out = [int(score.argmax())]
    while before[out[-1]] >= 0:
        out.append(int(before[out[-1]]))
    return np.array(out[::-1])


@dataclass(frozen=True)
class Index:
    """Inverted index of the templates' fingerprints, sorted by hash."""

    names: list[str]
    words: list[np.ndarray]  # hashes of each template's words
    hashes: np.ndarray
    template: np.ndarray
    position: np.ndarray
    known: _Hashes
    counts: list[tuple[np.ndarray, np.ndarray]]  # each template's distinct words and how often they occur

    @staticmethod
    def of(templates: dict[str, str]) -> "Index":
        known, rows, held = _Hashes(), [], []
        for t, (name, text) in enumerate(templates.items()):
            words = words_of(text)
            if len(words) < K:
                raise ValueError(f"template {name} has fewer than {K} words")
            held.append(np.array([known[w] for w in words], np.uint64))
            rows += [(h, t, p) for h, p in zip(*fingerprints(words, known))]
        rows.sort()
        h, t, p = zip(*rows)
        return Index(list(templates), held, np.array(h, np.uint64), np.array(t), np.array(p), known,
                     [np.unique(w, return_counts=True) for w in held])

    def _enough(self, t: int, distinct: np.ndarray, times: np.ndarray) -> bool:
        """Whether so many words, in any order, could cover template t."""
        word, most = self.counts[t]
        at = np.minimum(np.searchsorted(distinct, word), len(distinct) - 1)
        shared = np.where(distinct[at] == word, np.minimum(times[at], most), 0).sum()
        return shared >= MIN_COVERAGE * len(self.words[t])

    def _places(self, t: int, position: np.ndarray, where: np.ndarray, each: np.ndarray) -> list[tuple]:
        """(coverage, words aligned, first, last + 1) of the places of template
        t; hits are places in it and in the text, whose words are ``each``."""
        m = len(self.words[t])
        slack = LONG_SLACK if m >= LONG else SLACK
        order = np.lexsort((-position, where))
        out, open_ = [], [(position[order], where[order], 0, len(each))]
        while open_:
            p, x, low, high = open_.pop()
            gaps = np.flatnonzero(np.diff(x) > m + slack)
            if len(gaps):  # no chain spans them
                edges = [0, *(gaps + 1).tolist(), len(x)]
                open_ += [(p[a:b], x[a:b], low, high) for a, b in zip(edges, edges[1:])]
                continue
            a, b = max(low, int(x[0]) - m - slack), min(high, int(x[-1]) + K + m + slack)
            if not self._enough(t, *np.unique(each[a:b], return_counts=True)):
                continue
            best = chain(p, x, slack, m + slack)
            n, a, b = self._aligned(t, p[best], x[best], each, low, high, slack)
            left = np.ones(len(x), bool)
            left[best] = False
            if n >= MIN_COVERAGE * m:
                out.append((n / m, n, a, b))
                before, after = left & (x + K <= a), left & (x >= b)
                open_ += [(p[k], x[k], lo, hi) for k, lo, hi in ((before, low, a), (after, b, high)) if k.any()]
            elif left.any():
                open_.append((p[left], x[left], low, high))
        return out

    def _aligned(self, t: int, p: np.ndarray, x: np.ndarray, each: np.ndarray, low: int, high: int, slack: int) -> tuple[int, int, int]:
        """(words aligned, first, last + 1) along a chain, within [low, high) of the text."""
        template, n = self.words[t], K
        for i in range(len(p) - 1):
            dp, dx = int(p[i + 1] - p[i]), int(x[i + 1] - x[i])
            if min(dp, dx) <= K:
                n += min(dp, dx)  # the hits overlap or touch
            else:
                n += K + align(template[p[i] + K:p[i + 1]], each[x[i] + K:x[i + 1]].tolist())[0]
        head, tail = int(p[0]), len(template) - int(p[-1]) - K
        beyond = lambda k: k + min(slack, k + SLACK) if k else 0
        first, last = int(x[0]), int(x[-1]) + K
        more, back = align(template[:head][::-1], each[max(low, first - beyond(head)):first][::-1].tolist())
        rest, on = align(template[len(template) - tail:], each[last:min(high, last + beyond(tail))].tolist())
        return n + more + rest, first - back, last + on

    def scan(self, text: str | None) -> list[tuple]:
        """(licence, coverage, words aligned, first word, last word + 1, first
        character, last character + 1) of each match, in order of place."""
        if not text:
            return []
        words = words_of(text)
        gram, at = fingerprints(words, self.known)
        low, high = (np.searchsorted(self.hashes, gram, side) for side in ("left", "right"))
        some = np.flatnonzero(high > low)
        if not len(some):
            return []
        each = np.array([self.known[w] for w in words], np.uint64)
        of = np.concatenate([np.arange(low[i], high[i]) for i in some])
        where = np.repeat(at[some], high[some] - low[some])
        all_words = np.unique(each, return_counts=True)
        found: dict[int, list] = {}
        for t in np.unique(self.template[of]).tolist():
            if self._enough(t, *all_words):
                mine = self.template[of] == t
                if places := self._places(t, self.position[of[mine]], where[mine], each):
                    found[t] = places
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(text)] if text.lower() == text or len(text.lower()) == len(text) else None
        out = []
        exact = spans is not None and len(spans) == len(words)
        best = []
        for t, places in found.items():
            best += [(len(self.words[t]) - 2 * n, t, coverage, n, a, b) for coverage, n, a, b in places]
        taken = np.zeros(len(words), bool)  # by any template
        for _, t, coverage, n, a, b in sorted(best):
            if 2 * np.count_nonzero(taken[a:b]) > b - a:
                continue
            taken[a:b] = True
            out.append((self.names[t], coverage, n, a, b, spans[a][0] if exact else None, spans[b - 1][1] if exact else None))
        return sorted(out, key=lambda m: (m[3], m[4], m[0]))


MATCH = ("license string, coverage double, n_matched int, word_start int, word_end int, char_start int, char_end int")


def matches(text: str | Column, spark, templates: dict[str, str] = USUAL) -> Column:
    """Array of the matches (MATCH) in each whole text."""
    shared = spark.sparkContext.broadcast(Index.of(templates))  # templates are a parameter, not data
    names = [f.split()[0] for f in MATCH.split(", ")]

    @F.pandas_udf(f"array<struct<{', '.join(f.replace(' ', ':') for f in MATCH.split(', '))}>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for texts in batches:
            yield texts.map(lambda t: [dict(zip(names, m)) for m in index.scan(t)])

    return found(text)


def scan_documents(docs: DataFrame, templates: dict[str, str] = USUAL) -> DataFrame:
    """doc_id, n_matches and the matches of every document."""
    found = docs.select("doc_id", matches(F.coalesce("text", F.lit("")), docs.sparkSession, templates).alias("matches"))
    return found.select("doc_id", F.size("matches").alias("n_matches"), "matches")
