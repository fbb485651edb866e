"""Byte-level BPE against the tokenizer library and exact round trips;
licence scans against planted notices and a plain alignment."""

import hashlib
import itertools
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import byte_bpe, licenses

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aeiouthsnr  \n'ß中é😀0129.!-_=\t‍�"), max_size=80) | st.text(st.characters(exclude_categories=["Cs"])))
def test_encoding_and_round_trip(text):
    ids = CODEC.encode(text)
    assert list(ids) == ENCODING.encode_ordinary(text) and CODEC.decode(ids) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 255) | st.integers(0, len(RANKS) - 1), max_size=40))
def test_decoding_of_any_ids(ids):
    whole = b"".join(CODEC.fst.token[i] for i in ids)
    assert CODEC.decode(ids) == whole.decode("utf-8", "replace")
    machine = byte_bpe.Utf8Machine(CODEC.fst.token)  # fed one by one
    assert "".join(machine.feed([i]) for i in ids) + machine.end() == whole.decode("utf-8", "replace")


def test_arcs_and_pieces_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(byte_bpe, "ARCS_KEPT", 20)
    monkeypatch.setattr(byte_bpe, "PIECES_KEPT", 5)
    codec, rng = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN), random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("etaoin shrdlu") for _ in range(30))
        assert list(codec.encode(text)) == ENCODING.encode_ordinary(text)


def test_lookahead_is_bounded():
    fst = byte_bpe.Transducer(RANKS)
    longest, state = max(map(len, RANKS)), 0
    for byte in b"ab" * 2000:
        state, _ = fst.arcs.get(state << 8 | byte) or fst._arc(state, byte)
        assert len(fst.states[state]) <= longest + 2
    assert len(fst.states) < 100  # the same states again and again


def test_words_share_states():
    """Words of random syllables need few states: these hold no tokens but the last one."""
    rng, fst = random.Random(9), byte_bpe.Transducer(RANKS)
    words = ["".join(rng.choice("th er on an in re nd at ou ble tion".split()) for _ in range(rng.randint(3, 6))) for _ in range(3000)]
    for word in words:
        assert fst.encode(f" {word}".encode()) == ENCODING.encode_ordinary(f" {word}")
    assert len(fst.states) < 6000


def test_documents_and_columns(spark, documents):
    texts = [None, "", "plain words here", "plain words here", "naïve 中文 😀", "x" * 300_000, "a b " * 40_000]
    docs = documents(list(enumerate(texts)) + [(None, "no id")])
    got = {r["doc_id"]: r for r in byte_bpe.digest_documents(docs, PATH, public_tokenizers.PATTERN).collect()}
    for i, t in [*enumerate(texts), (None, "no id")]:
        ids = ENCODING.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.digest_documents(documents([]), PATH, public_tokenizers.PATTERN).collect() == []
    ids = byte_bpe.encode("text", spark, PATH, public_tokenizers.PATTERN)
    back = docs.select("text", ids.alias("ids")).select("text", byte_bpe.decode("ids", spark, PATH, public_tokenizers.PATTERN).alias("t"))
    assert all(r["t"] == (r["text"] or "") for r in back.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40))
def test_winnowing(values):
    hashes = np.array(values, np.uint64)
    kept, w = set(licenses.winnow(hashes).tolist()), licenses.WINDOW
    want = {max(range(i, min(i + w, len(values))), key=lambda j: (-values[j], j)) for i in range(max(1, len(values) - w + 1))} if values else set()
    assert kept == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=10), st.lists(st.integers(0, 3), min_size=1, max_size=14))
def test_alignment_is_the_longest_common_subsequence(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + (x == y))
    n, took = licenses.align(np.array(a, np.uint64), b)
    assert n == table[-1, -1] and took == min(k for k in range(len(b) + 1) if table[-1, k] == n)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 20)), min_size=1, max_size=9, unique=True), st.integers(0, 8))
def test_the_best_chain(hits, slack):
    """Against all chains."""
    hits = sorted(hits, key=lambda h: (h[1], -h[0]))
    k = licenses.K

    def worth(c):
        total = k
        for (p, x), (q, y) in zip(c, c[1:]):
            if q <= p or y <= x or (y - x) - (q - p) > slack or y - x > 15:
                return None
            total += min(k, q - p, y - x) - abs((y - x) - (q - p)) / 100
        return total

    best = max(w for n in range(1, len(hits) + 1) for c in itertools.combinations(hits, n) if (w := worth(c)) is not None)
    got = licenses.chain(np.array([h[0] for h in hits]), np.array([h[1] for h in hits]), slack, 15)
    assert worth([hits[i] for i in got]) == pytest.approx(best)


def test_notices_are_found_where_they_stand(documents):
    rng = random.Random(2)
    noise = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "licensed", "version", "under"]) for _ in range(rng.randint(0, 40)))
    rows, planted = [(1, None), (2, ""), (3, "nothing of the kind here"), (4, "License")], {1: [], 2: [], 3: [], 4: []}
    for i, (name, notice) in enumerate(licenses.TEMPLATES.items(), 10):
        text = f"{noise()}\n{notice} {noise()}"
        rows += [(i, text), (i, text)]
        planted[i] = [(name, text.index(notice))]
    twice = "Released under the MIT License. " + "other words between them " * 20 + "released UNDER the\nMIT license"
    rows.append((50, twice))
    got = {}
    for r in licenses.scan_documents(documents(rows)).collect():
        assert r["n_matches"] == len(r["matches"]) and got.setdefault(r["doc_id"], r["matches"]) == r["matches"]
    for i, want in planted.items():
        full = {(m["license"], m["char_start"]) for m in got[i] if m["coverage"] == 1}
        assert full >= set(want) and (want or not got[i])
    assert [m["license"] for m in got[50] if m["license"] == "MIT"] == ["MIT"] * 2
    assert licenses.scan_documents(documents([])).collect() == []


def test_changed_notice_is_partly_covered():
    index = licenses.Index.of(licenses.TEMPLATES)
    words = licenses.words_of(licenses.TEMPLATES["MIT-full"])
    del words[10:14]
    words.insert(20, "extra")
    (match,) = [m for m in index.scan("before it " + " ".join(words) + " after it") if m[0] == "MIT-full"]
    assert match[2] == len(words) - 1 and match[3] == 2 and match[4] == 2 + len(words)
    with pytest.raises(ValueError):
        licenses.Index.of({"short": "two words"})
