"""Cross-tokenizer alignment of a byte-level BPE (A) and a piece BPE (B).

Both encode the same bytes: a space and the text.  A token ends at a byte
offset, and the two rising lists of ends are intersected by galloping: the
shorter list drives, each of its ends is searched in the longer one from where
it is expected, by doubling steps until it is passed and by halving the last
step.  The rank found for an end is the number of the longer list's ends below
it.  Ends in both lists cut the tokens into groups; the difference of the ranks
of two neighbouring ends is the range of tokens that a token overlaps, its links.
All documents of a batch are laid end to end, so one search serves them all.

Counts of linked id pairs are of the whole corpus.  Nothing is spelled out per
link: a block of some documents keeps its distinct pairs once, and a document
only how often each of its pairs stands in it.  The blocks' pairs are summed up
by pair, the sums go back to the blocks that hold the pair, and a block's
documents add them up.  A block is bounded by ``BLOCK`` links or is one text,
so the pairs shuffled grow with the vocabularies and the number of blocks, not
with the links; a pair that every block holds is joined with both sides dealt
anew, which Spark can split.

A is encoded by the tiktoken library from the ranks in the file, which gives
what the tokenizers library gives wherever a token's rank is the place of its
merge (checked when the file is read, else the tokenizers library encodes);
texts with a very long run without or of white space, which the former merges
in quadratic time, go to the tokenizers library.

Defined cases: a null or empty text, or one whose joined A or B bytes differ
from a space and the text (B maps some characters), has no tokens: zeros and
an empty ``groups_sha256``.  Repeated rows count each, rows with a null or
shared id are documents of their own.  An empty table gives no row.  Texts are
whole.  Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.store import Scratch, stored

BLOCK = 2_000_000  # links of the documents whose pairs are kept together, about
BATCH = 1 << 20  # characters encoded together, about
LONG_RUN = re.compile(r"\S{4000}|\s{4000}")


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: visible
    Latin-1 characters stand for themselves, the other bytes take the
    characters from 256 on in turn."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: ids of a text, and the bytes of an id."""

    def __init__(self, definition: str, pattern: str):
        self.slow = tokenizers.Tokenizer.from_str(definition)
        self.slow.encode_special_tokens = True  # their strings are plain text
        model = json.loads(definition)
        special = {t["content"] for t in model["added_tokens"]}
        of, entries = byte_of_character(), model["model"]["vocab"]
        self.bytes_of = {i: t.encode() if t in special else bytes(map(of.__getitem__, t)) for t, i in entries.items()}
        ranks = {self.bytes_of[i]: i for t, i in entries.items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        in_turn = all(entries.get(a + b) == len(of) + n for n, (a, b) in enumerate(merges)) and len(ranks) == len(of) + len(merges)
        self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if in_turn else None

    def encode(self, text: str) -> list[int]:
        if self.fast is None or LONG_RUN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """Tokenizer B."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.bytes_of = {i: bytes((int(p[3:5], 16),)) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                         for i, p in ((i, self.model.id_to_piece(i)) for i in range(size))}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each of ``short`` the number of ``long`` below it; both rise.  The
    search begins at ``start``, any place of ``long``: steps double towards
    the end sought until it is passed, then the last step is halved."""
    n = len(long)
    low, high = np.zeros(len(short), np.int64), np.full(len(short), n)  # long[low - 1] < x <= long[high]
    if not n:
        return low
    at = np.clip(start, 0, n - 1)
    below = long[at] < short
    for ahead in (True, False):
        open_, step = np.flatnonzero(below == ahead), 1
        place = at[open_]
        while len(open_):
            if ahead:
                low[open_] = place + 1
                place = place + step
                passed = place >= n
                passed[~passed] = long[place[~passed]] >= short[open_[~passed]]
                high[open_[passed]] = np.minimum(place[passed], n)
            else:
                high[open_] = place
                place = place - step
                passed = place < 0
                passed[~passed] = long[place[~passed]] < short[open_[~passed]]
                low[open_[passed]] = np.maximum(place[passed] + 1, 0)
            open_, place, step = open_[~passed], place[~passed], step * 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = long[middle] < short[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, start: np.ndarray | None = None):
    """(links' A token, links' B token, last A token of each group, last B
    token of each group) of two token sequences over the same bytes.
    ``start``: where the ends of the shorter one are expected in the longer."""
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    if start is None:
        start = np.arange(len(short)) * len(long) // max(1, len(short))
    rank = gallop(short, long, start)
    common = long[rank] == short if len(short) else np.zeros(0, bool)
    first = np.concatenate([[0], (rank + common)[:-1]]) if len(short) else rank
    many = rank - first + 1
    one = np.repeat(np.arange(len(short)), many)
    other = np.arange(len(one)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    cut = np.flatnonzero(common)
    return (other, one, rank[cut], cut) if swap else (one, other, cut, rank[cut])


class Aligner:
    """Aligns batches of texts; a worker keeps one."""

    def __init__(self, definition: str, model: bytes, pattern: str):
        self.a, self.b = ByteLevel(definition, pattern), Pieces(model)
        self.base = max(self.b.bytes_of) + 1
        sizes = lambda of: np.array([len(of.get(i, b"")) for i in range(max(of) + 1)], np.int64)
        self.size_a, self.size_b = sizes(self.a.bytes_of), sizes(self.b.bytes_of)
        # decimal ids with the sign that follows: A's twice, B's twice
        self.signs = [f"{i}{sign}" for n, signs in ((len(self.size_a), ",|"), (len(self.size_b), ",;")) for sign in signs for i in range(n)]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """A's and B's ids; none where their bytes differ from the text's."""
        out = []
        for text, b in zip(texts, self.b.encode(texts)):
            if text:
                whole = " " + text
                a, data = self.a.encode(whole), whole.encode()
                if b"".join(map(self.b.bytes_of.__getitem__, b)) == data and b"".join(map(self.a.bytes_of.__getitem__, a)) == data:
                    out.append((a, b))
                    continue
            out.append(([], []))
        return out

    def align(self, texts: list[str]):
        """Of each text (n_a, n_b, n_groups, n_links, groups), and of all
        links the text's number and the pair."""
        ids = self.encode(texts)
        count = np.array([(len(a), len(b)) for a, b in ids], np.int64).reshape(-1, 2)
        a, b = (np.array([i for pair in ids for i in pair[k]], np.int64) for k in (0, 1))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # each text's ends are expected where its share of the other list lies
        swap = len(a) > len(b)
        mine, theirs = (count[:, 1], count[:, 0]) if swap else (count[:, 0], count[:, 1])
        inside = np.arange(mine.sum()) - np.repeat(np.cumsum(mine) - mine, mine)
        start = np.repeat(np.cumsum(theirs) - theirs, mine) + inside * np.repeat(theirs, mine) // np.repeat(np.maximum(mine, 1), mine)
        link_a, link_b, cut_a, cut_b = overlaps(ends_a, ends_b, start)

        until_a, until_b = np.cumsum(count[:, 0]), np.cumsum(count[:, 1])
        text_of_link = np.searchsorted(until_a, link_a, side="right")
        groups = np.bincount(np.searchsorted(until_a, cut_a, side="right"), minlength=len(texts))
        links = np.bincount(text_of_link, minlength=len(texts))

        # a group's A ids, then its B ids: the place of each among all ids
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        before_a, before_b = cut_a + 1, cut_b + 1 - size_b
        signs = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = (np.zeros(len(x), np.int64) for x in (a, b))
        last_a[cut_a], last_b[cut_b] = 1, 1
        signs[np.arange(len(a)) + np.repeat(before_b, size_a)] = a + last_a * len(self.size_a)
        signs[np.arange(len(b)) + np.repeat(before_a, size_b)] = b + last_b * len(self.size_b) + 2 * len(self.size_a)
        spelt = list(map(self.signs.__getitem__, signs.tolist()))
        rows, done = [], 0
        for (n_a, n_b), g, n in zip(count.tolist(), groups.tolist(), links.tolist()):
            rows.append((n_a, n_b, g, n, "".join(spelt[done:done + n_a + n_b])[:-1]))
            done += n_a + n_b
        return rows, text_of_link, a[link_a] * self.base + b[link_b]


_aligners: dict[tuple, Aligner] = {}


def _aligner(shared) -> Aligner:
    key, *parts = shared.value
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*parts)
    return _aligners[key]


# A document's row has ``at`` (numbers of its block's pairs) and ``times``; a block's own row has ``pairs`` and ``counts``.
FOUND = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "at array<int>, times array<int>, pairs array<long>, counts array<long>")
_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
_FOUND = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("at", _INTS), ("times", _INTS), ("pairs", _LONGS), ("counts", _LONGS)])
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class _Block:
    """Documents whose links are kept together."""

    def __init__(self):
        self.rows, self.pairs, self.times, self.owner, self.links = [], [], [], [], 0

    def add(self, ids: list, rows: list, owner: np.ndarray, pair: np.ndarray, base: int) -> None:
        # distinct pairs of each text
        order = np.lexsort((pair, owner))
        owner, pair = owner[order], pair[order]
        new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])])) if len(pair) else np.zeros(0, np.int64)
        self.owner.append(owner[new] + len(self.rows))
        self.pairs.append(pair[new])
        self.times.append(np.diff(np.append(new, len(pair))))
        self.links += len(pair)
        self.rows += [(i, *row[:4], hashlib.sha256(row[4].encode()).hexdigest() if row[0] else "") for i, row in zip(ids, rows)]

    def batch(self, number: int) -> pa.RecordBatch:
        owner, pair, times = (np.concatenate(x) for x in (self.owner, self.pairs, self.times))
        distinct, at = np.unique(pair, return_inverse=True)
        counts = np.bincount(at, weights=times, minlength=len(distinct)).astype(np.int64)
        n = len(self.rows)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n)), [len(owner)]]).astype(np.int32)
        fields = [pa.array([number] * (n + 1), pa.int64())]
        fields += [pa.array([r[k] for r in self.rows] + [None], _FOUND.field(k + 1).type) for k in range(6)]
        fields += [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (at, times)]
        whole = pa.array(np.concatenate([np.zeros(n + 1, np.int32), [len(distinct)]]).astype(np.int32))
        fields += [pa.ListArray.from_arrays(whole, pa.array(x)) for x in (distinct, counts)]
        return pa.RecordBatch.from_arrays(fields, schema=_FOUND)


def _blocks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block, number = _aligner(shared), _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts, first = batch["doc_id"].to_pylist(), batch["text"].to_pylist(), 0
            sizes = np.cumsum([len(t) for t in texts])
            while first < len(texts):
                end = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + BATCH, side="right")))
                block.add(ids[first:end], *aligner.align(texts[first:end]), aligner.base)
                first = end
                if block.links >= BLOCK:
                    yield block.batch(number)
                    block, number = _Block(), number + 1
        if block.rows:
            yield block.batch(number)

    return run


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """ALIGNED of a block's documents, from the counts of its pairs."""
    place = right["i"].to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place] = right["count"].to_numpy()
    best[place] = right["is_best"].to_numpy()
    at, times = (left[c].combine_chunks() for c in ("at", "times"))
    owner = np.repeat(np.arange(left.num_rows), np.diff(at.offsets.to_numpy()))
    at, times = at.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    sums = []
    for value in (best, count):
        total = np.zeros(left.num_rows, np.int64)
        np.add.at(total, owner, times * value[at])
        sums.append(pa.array(total))
    fields = [left[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.table([*fields, *sums, left["groups_sha256"]], names=[f.split()[0] for f in ALIGNED.split(", ")])


def _found(docs: DataFrame, byte_level: str, pieces: str, pattern: str) -> tuple[DataFrame, int]:
    """FOUND, and the factor by which a pair's A id is multiplied."""
    with open(byte_level, encoding="utf-8") as file:
        definition = file.read()
    with open(pieces, "rb") as file:
        model = file.read()
    base = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    # vocabularies: their size does not depend on the corpus
    shared = docs.sparkSession.sparkContext.broadcast(((byte_level, pieces, pattern), definition, model, pattern))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_blocks(shared), FOUND), base


def _counted(found: DataFrame, base: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of a stored FOUND: (block, i, pair, n), and (pair, count, is_best) of
    the whole corpus."""
    own = found.where("pairs IS NOT NULL AND doc_id IS NULL AND n_a IS NULL")
    held = own.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("i", "x")).select("block", "i", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    counts = scratch.stored(held.groupBy("pair").agg(F.sum("n").alias("count")), "pair_counts")
    best = counts.groupBy((F.col("pair") % base).alias("b")).agg(F.max("count").alias("best"))
    scored = counts.join(best, F.col("pair") % base == F.col("b")).select("pair", "count", (F.col("count") == F.col("best")).alias("is_best"))
    return held, scratch.stored(scored, "pairs")


def align_documents(docs: DataFrame, byte_level: str, pieces: str, pattern: str) -> DataFrame:
    """ALIGNED of every document.  ``byte_level``: a tokenizers file of a
    byte-level BPE, ``pieces``: a sentencepiece model, ``pattern``: what A's
    texts are split by."""
    with Scratch() as scratch:
        found, base = _found(docs, byte_level, pieces, pattern)
        found = scratch.stored(found, "aligned")
        held, scored = _counted(found, base, scratch)
        known = held.select("block", "i", F.col("pair").alias("held")).join(scored, F.col("held") == F.col("pair")).select(F.col("block").alias("in_block"), "i", "count", "is_best")
        rows = found.where("n_a IS NOT NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times")
        return stored(rows.groupBy("block").cogroup(known.groupBy("in_block")).applyInArrow(_summed, ALIGNED), "alignment")


def pair_counts(docs: DataFrame, byte_level: str, pieces: str, pattern: str) -> DataFrame:
    """a, b, count, is_best: how many links of the corpus hold A's id a linked
    with B's id b, and whether no other a is linked with b more often."""
    with Scratch() as scratch:
        found, base = _found(docs, byte_level, pieces, pattern)
        _, scored = _counted(scratch.stored(found, "aligned"), base, scratch)
        pair = F.col("pair")
        return stored(scored.select(F.floor(pair / base).cast("long").alias("a"), (pair % base).alias("b"), "count", "is_best"), "pair_counts")
