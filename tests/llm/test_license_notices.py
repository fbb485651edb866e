"""Notices as they stand in files, none of them a template's string: the right
licence is reported, and one only at each place."""

import random

import numpy as np
import pytest

from strata.llm import licenses

INDEX = licenses.Index.of(licenses.USUAL)
GNU = """ * {0} is free software; you can redistribute it and/or modify
 * it under the terms of the GNU {1}General Public License as
 * published by the Free Software Foundation; either version {2} of
 * the License, or (at your option) any later version.
 *
 * {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."""
NOTICES = {
    "GPL-2.0": GNU.format("This frobnicator", "", "2"),
    "GPL-3.0": GNU.format("This frobnicator", "", "3"),
    "LGPL-2.1": GNU.format("The frob library", "Lesser ", "2.1"),
    "LGPL-3.0": GNU.format("The frob library", "Lesser ", "3"),
    "AGPL-3.0": GNU.format("This frobnicator", "Affero ", "3"),
    "MPL-2.0": "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not "
               "distributed with this\n# file, you can obtain one at http://mozilla.org/MPL/2.0/",
    "ISC": "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided "
           "that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
           "AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS. IN "
           "NO EVENT SHALL THE AUTHOR BE LIABLE FOR\nANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES\nWHATSOEVER "
           "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN\nACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT "
           "OF\nOR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "CC0-1.0": "To the extent possible under law, Jane Doe has waived all copyright and\nrelated or neighboring rights to this work.",
    "CC-BY-SA-4.0": "Except where noted, this book is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "Text: licensed under CC-BY-NC-ND 4.0",
    "Unlicense": "This is free and unencumbered software, released into\nthe public domain by its author.",
}


@pytest.mark.parametrize("name", NOTICES)
def test_notice(name):
    found = INDEX.scan("alpha beta gamma\n" + NOTICES[name] + "\ndelta epsilon")
    assert [m[0].removesuffix("-full").removesuffix("-whole") for m in found] == [name]


@pytest.mark.parametrize("name", licenses.WHOLE)
def test_whole_text_with_a_few_words_changed(name):
    words = licenses.USUAL[f"{name}-whole"].split()
    for i in range(25, len(words), 60):
        words[i] = "changed"
    found = INDEX.scan("Copyright (c) 2020 Some One\n" + " ".join(words) + "\nand the rest")
    assert [m[0] for m in found] == [f"{name}-whole"]


def subsequence(a, b):
    """Words of the longest common subsequence, by the whole table."""
    number = {w: i for i, w in enumerate(dict.fromkeys(a + b))}
    b = np.array([number[w] for w in b])
    row = np.zeros(len(b) + 1, int)
    for w in a:
        diagonal = np.where(b == number[w], row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], diagonal))
    return int(row[-1])


def changes(words, rng):
    """Texts with words put in, left out, moved and changed, up to 200 at a place."""
    n, new = len(words), lambda k: [f"extra{rng.randrange(50)}" for _ in range(k)]
    for k in (5, 10, 24, 60, 200):
        for at in (n // 2, n // 5):
            yield f"{k} in at {at}", words[:at] + new(k) + words[at:]
            yield f"{k} out at {at}", words[:at] + words[at + k:]
        if 2 * k < n:
            yield f"{k} moved", words[:n // 3] + words[n // 3 + k:] + words[n // 3:n // 3 + k]
        spread = sorted(rng.sample(range(1, n), min(k, n // 8)))
        yield f"{k} spread", [x for i, w in enumerate(words) for x in (new(1) if i in spread else []) + [w]]
        yield f"{k} changed", [new(1)[0] if i in spread else w for i, w in enumerate(words)]
        yield f"{k} thinned", [w for i, w in enumerate(words) if i not in spread]
    yield "three paragraphs put in", words[:n // 4] + new(200) + words[n // 4:n // 2] + new(90) + words[n // 2:3 * n // 4] + new(200) + words[3 * n // 4:]


@pytest.mark.parametrize("name", licenses.WHOLE)
def test_whole_text_with_words_put_in_left_out_and_moved(name):
    """What an alignment without a band covers to 0.7 is reported."""
    rng, words = random.Random(name), licenses.words_of(licenses.USUAL[f"{name}-whole"])
    for what, changed in changes(words, rng):
        found = INDEX.scan("alpha beta\n" + " ".join(changed) + "\ngamma delta")
        n = subsequence(words, changed)
        whole = [m for m in found if m[0] == f"{name}-whole"]
        others = [m for m in found if m[0].endswith("-whole") and m[0] != f"{name}-whole"]
        if n >= licenses.MIN_COVERAGE * len(words) + 1 and not others:  # leaving a clause out may make it another licence
            assert len(whole) == 1 and n - 0.03 * len(words) <= whole[0][2] <= n, (what, n / len(words), found)
        elif n >= licenses.MIN_COVERAGE * len(words) + 1:
            (other,) = others
            assert 2 * other[2] - len(licenses.words_of(licenses.USUAL[other[0]])) >= 2 * n - len(words) - 0.06 * len(words), (what, found)
        elif n < licenses.MIN_COVERAGE * len(words):
            assert not whole, (what, n / len(words))


def test_whole_texts_in_a_row():
    text = " ".join(licenses.USUAL[f"{n}-whole"] for n in ("MIT", "ISC", "MIT", "BSD-3-Clause", "MIT", "MIT"))
    assert [m[0] for m in INDEX.scan(text)] == ["MIT-whole", "ISC-whole", "MIT-whole", "BSD-3-Clause-whole", "MIT-whole", "MIT-whole"]


def test_words_far_apart_are_no_notice():
    filler = "entirely other words that say nothing of the kind " * 4
    assert INDEX.scan(f"Released under the {filler} MIT License and {filler} Version 2.0") == []
    many = "Released under the MIT License. " * 2000
    assert [m[0] for m in INDEX.scan(many)] == ["MIT"] * 2000


def test_two_notices_side_by_side():
    found = INDEX.scan(NOTICES["GPL-2.0"] + "\n" + NOTICES["MPL-2.0"] + "\nReleased under the MIT License.")
    assert [m[0] for m in found] == ["GPL-2.0-full", "MPL-2.0-full", "MIT"]


@pytest.mark.parametrize("name", licenses.USUAL)
def test_every_template_is_found_as_itself(name):
    (match,) = INDEX.scan("alpha beta gamma\n" + licenses.USUAL[name] + "\ndelta epsilon")
    assert match[:2] == (name, 1.0) and match[3] == 3


def test_documents_are_scanned_for_all_of_them(documents):
    rows = list(enumerate(NOTICES.values()))
    got = {r["doc_id"]: [m["license"] for m in r["matches"]] for r in licenses.scan_documents(documents(rows)).collect()}
    assert got == {i: [m[0] for m in INDEX.scan(t)] for i, t in rows} and all(got.values())
