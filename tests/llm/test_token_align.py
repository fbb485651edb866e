"""Token alignment against plain loops over both tokenizers' own libraries."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import token_align
from strata.llm.token_align import Aligner, gallop, overlaps

BYTE, PIECE, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
A = Tokenizer.from_file(BYTE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE)
ALIGNER = Aligner(open(BYTE, encoding="utf-8").read(), open(PIECE, "rb").read(), PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 200)), st.sets(st.integers(0, 200)), st.data())
def test_galloping(a, b, data):
    a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    start = np.array([data.draw(st.integers(-3, 205)) for _ in a], np.int64)
    assert gallop(a, b, start).tolist() == np.searchsorted(b, a).tolist()


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_overlaps(a, b):
    a, b = (np.array(sorted(x | {61}), np.int64) for x in (a, b))
    x, y, cut_a, cut_b = overlaps(a, b)
    begin = lambda e, i: e[i - 1] if i else 0
    assert sorted(zip(x.tolist(), y.tolist())) == [(i, k) for i in range(len(a)) for k in range(len(b)) if max(begin(a, i), begin(b, k)) < min(a[i], b[k])]
    assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def token_bytes():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    a = {i: bytes(of[c] for c in t) for t, i in A.get_vocab().items() if t != "<|endoftext|>"}
    b = {}
    for i in range(B.get_piece_size()):
        p = B.id_to_piece(i)
        b[i] = bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()
    return a, b


def brute(rows):
    """ALIGNED by the contract, two tokens at a time."""
    of_a, of_b = token_bytes()
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = A.encode(" " + text, add_special_tokens=False).ids if text else []
        b = B.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(of_a[i] for i in a) != whole or b"".join(of_b[i] for i in b) != whole:
            found.append((doc_id, [], [], [], []))
            continue
        spans = []
        for ids, of in ((a, of_a), (b, of_b)):
            at, s = 0, []
            for i in ids:
                s.append((at, at + len(of[i])))
                at += len(of[i])
            spans.append(s)
        links, k = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][k][1] <= s:
                k += 1
            for j in range(k, len(b)):
                if spans[1][j][0] >= e:
                    break
                links.append((a[i], b[j]))
        both = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        groups, i, j = [], 0, 0
        for cut in sorted(both):
            i2 = next(x for x in range(i, len(a)) if spans[0][x][1] == cut) + 1
            j2 = next(x for x in range(j, len(b)) if spans[1][x][1] == cut) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(i, len(a), len(b), len(g), len(n), sum(counts[x] == best[x[1]] for x in n), sum(counts[x] for x in n),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, n in found], counts, best


def order(row):
    return tuple(str(x) for x in row)


TEXTS = [None, "", " ", "plain words here", "plain words here", "naïve 中文 😀 ‍", "a <|endoftext|> <s> </s> <unk> <0x41> text", "▁ under", "ﬁ ligature ½",
         "tab\there\n\n  two  spaces ", "　wide", "x" * 9_000, "a b " * 9_000, "<0x0A>", "\x00 zero", "é combining", " leading", "0123456789" * 20]


def test_documents(spark, documents, monkeypatch):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("etaoin shrdlu, éß中.\n") for _ in range(rng.randrange(300))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(None, "no id here"), (None, "no id here"), (3, "shared id")]
    expected, counts, best = brute(rows)
    docs = documents(rows)
    got = token_align.align_documents(docs, BYTE, PIECE, PATTERN)
    assert sorted((tuple(r) for r in got.collect()), key=order) == sorted(expected, key=order)
    assert sum(r[1] == 0 for r in expected) >= 3  # some have no tokens
    pairs = {(r["a"], r["b"]): (r["count"], r["is_best"]) for r in token_align.pair_counts(docs.repartition(3), BYTE, PIECE, PATTERN).collect()}
    assert pairs == {k: (n, n == best[k[1]]) for k, n in counts.items()}


def test_small_blocks_and_batches(monkeypatch):
    """Blocks of one document each: the same documents, all links."""
    monkeypatch.setattr(token_align, "BATCH", 50)
    rows, links = [], 0
    for size in (50, 1 << 20):
        block = token_align._Block()
        texts = [t or "" for t in TEXTS]
        at = 0
        while at < len(texts):
            n = 3 if size == 50 else len(texts)
            block.add(list(range(at, at + n)), *ALIGNER.align(texts[at:at + n]), ALIGNER.base)
            at += n
        batch = block.batch(1).to_pylist()
        rows.append([(r["doc_id"], r["n_links"], r["groups_sha256"], r["at"], r["times"]) for r in batch[:-1]] + [batch[-1]["pairs"], batch[-1]["counts"]])
        assert sum(batch[-1]["counts"]) == block.links == sum(r["n_links"] for r in batch[:-1])
    assert rows[0] == rows[1]


def test_empty_table(spark, documents):
    assert token_align.align_documents(documents([]), BYTE, PIECE, PATTERN).collect() == []


@pytest.mark.parametrize("first", range(0, 0x30000, 0x8000))
def test_fast_and_slow_encoding_agree_on_all_characters(first):
    marks = [chr(c) for c in range(first, first + 0x8000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{x}b 1{x}2 {x}{x} !{x}? {x}  {x}\n{x}'s{x}" for x in marks]
    slow = ALIGNER.a.slow.encode_batch(texts, add_special_tokens=False)
    assert all(ALIGNER.a.fast.encode_ordinary(t) == s.ids for t, s in zip(texts, slow))


def test_query(spark):
    from strata.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_token_align"](spark, "/root/testdata/sf0.001").collect()) == sorted(brute(rows)[0])
