"""Byte-level BPE encoding and decoding.

Encoding compiles the merge ranks into a finite-state transducer over bytes
that is determinised as texts need it.  It rests on one fact: a sequence of
tokens is what the merges give exactly if each two neighbours stay apart when
their own bytes are merged.  Reading left to right, the transducer follows
every position from which the bytes read so far may still grow into a token,
each with the last token of the one path that leads there.  An arc's output is
the last token of all bytes read; a piece's tokens are those outputs taken
from its end, each as far back as the one after it is long.  A state is its open
positions; each is one whole number, the last token above the trie node.  No
position stays open for longer than the longest token, so states are bounded.

Decoding runs an incremental UTF-8 machine over the tokens' bytes: a state is
the sequence left incomplete so far; a token's effect from a state is worked
out once.

Defined cases: a null text encodes like an empty one, to no token; repeated
rows encode alike; a text of any length is encoded whole.  Further columns,
whatever their names, pass unread.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARCS_KEPT = 800_000  # memory of a worker: beyond these, arcs and pieces are worked out anew
PIECES_KEPT = 400_000
NODE_BITS = 40  # of a trie node in an open position
NODE = (1 << NODE_BITS) - 1
LONG_TEXT = 1 << 20  # characters from which pieces are not listed all at once


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Deterministic from the outside, built arc by arc on demand."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        # a trie: child by node and byte, token of a node, whether a node has children
        self.child: dict[int, int] = {}
        self.ends, self.inner = [-1], [True]
        for data, rank in ranks.items():
            node = 0
            for byte in data:
                self.inner[node] = True
                at = self.child.setdefault(node << 8 | byte, len(self.ends))
                if at == len(self.ends):
                    self.ends.append(-1)
                    self.inner.append(False)
                node = at
            self.ends[node] = rank
        self.width = (max(ranks.values()) + 1).bit_length()
        self.length = [0] * (max(ranks.values()) + 1)  # bytes of each token
        for data, rank in ranks.items():
            self.length[rank] = len(data)
        # rank by two tokens that make one
        self.joins = {ranks[a] << self.width | ranks[b]: rank for data, rank in ranks.items()
                      for i in range(1, len(data)) if (a := data[:i]) in ranks and (b := data[i:]) in ranks}
        self.apart: dict[int, bool] = {}
        self.spines: dict[int, tuple[list, list] | None] = {}
        self._forget()

    def _forget(self) -> None:
        start = (0,)
        self.states, self.number = [start], {start: 0}
        self.arcs: dict[int, tuple[int, int]] = {}

    def _spines(self, token: int) -> tuple[list, list] | None:
        """What stands at a token's left and right border while it is merged:
        (token, rank that makes it, rank that takes it up).  None for a token
        that merging its bytes does not give."""
        if token in self.spines:
            return self.spines[token]
        data, ranks = self.token[token], self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        edges = [[[ranks[p], -1, sys.maxsize]] for p in (parts[0], parts[-1])]
        while len(parts) > 1:
            rank, at = min((ranks.get(x + y, sys.maxsize), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
            if rank == sys.maxsize:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            for edge, touched in zip(edges, (at == 0, at == len(parts) - 1)):
                if touched:
                    edge[-1][2] = rank
                    edge.append([rank, rank, sys.maxsize])
        self.spines[token] = found = tuple(edges) if len(parts) == 1 else None
        return found

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives a and b again: no merge
        across the border has its turn while both its parts stand there.  Of
        equal merges the left one goes first."""
        known = self._meet(self._spines(a), self._spines(b))
        if len(self.apart) > ARCS_KEPT:
            self.apart.clear()
        self.apart[a << self.width | b] = known
        return known

    def _meet(self, left: tuple[list, list] | None, right: tuple[list, list] | None) -> bool:
        if left is None or right is None:
            return False
        joins, width, heads = self.joins, self.width, right[0]
        for x, x_from, x_to in left[1]:
            x <<= width
            for y, y_from, y_to in heads:
                rank = joins.get(x | y)
                if rank is not None and x_from < rank < x_to and y_from < rank <= y_to:
                    return False
        return True

    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        child, ends, inner, apart, width = self.child, self.ends, self.inner, self.apart, self.width
        grown, last = [], -1
        for entry in self.states[state]:
            node = child.get((entry & NODE) << 8 | byte)
            if node is None:
                continue
            before = entry >> NODE_BITS  # one more than the token, 0 for none
            if inner[node]:
                grown.append(before << NODE_BITS | node)
            if last < 0 and (token := ends[node]) >= 0:
                if before:
                    known = apart.get(before - 1 << width | token)
                    if known is None:
                        known = self.stay_apart(before - 1, token)
                    if not known:
                        continue
                last = token
        if last < 0:
            raise ValueError("the vocabulary lacks a byte")
        grown.append(last + 1 << NODE_BITS)
        after = tuple(grown)
        to = self.number.setdefault(after, len(self.states))
        if to == len(self.states):
            self.states.append(after)
        self.arcs[state << 8 | byte] = arc = (to, last)
        return arc

    def encode(self, piece: bytes) -> list[int]:
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        if len(self.arcs) > ARCS_KEPT:
            self._forget()
        state, lasts, arcs = 0, [], self.arcs
        for byte in piece:
            state, last = arcs.get(state << 8 | byte) or self._arc(state, byte)
            lasts.append(last)
        out, at, length = [], len(lasts), self.length
        while at:
            last = lasts[at - 1]
            out.append(last)
            at -= length[last]
        out.reverse()
        return out


class Utf8Machine:
    """Incremental decoding of token ids.  ``feed`` gives the characters that
    are complete; ``end`` gives what an unfinished sequence stands for."""

    def __init__(self, token: dict[int, bytes]):
        self.token = token
        self.moves: dict[tuple[bytes, int], tuple[bytes, str]] = {}
        self.state = b""

    @staticmethod
    def _follows(pending: bytes, byte: int) -> bool:
        """Whether byte may stand after the incomplete sequence."""
        if len(pending) > 1:
            return 0x80 <= byte <= 0xBF
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(pending[0], 0x80)  # shortest forms only
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(pending[0], 0xBF)  # no surrogates, none above U+10FFFF
        return low <= byte <= high

    @staticmethod
    def _length(lead: int) -> int:
        """Bytes of the character that lead begins; 0 if it begins none."""
        return 1 if lead < 0x80 else 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0

    def _move(self, pending: bytes, data: bytes) -> tuple[bytes, str]:
        out = []
        for byte in data:
            if pending and not self._follows(pending, byte):
                out.append("�")
                pending = b""
            if not pending and not self._length(byte):
                out.append("�")
                continue
            pending += bytes((byte,))
            if len(pending) == self._length(pending[0]):
                out.append(pending.decode())
                pending = b""
        return pending, "".join(out)

    def feed(self, ids: Iterable[int]) -> str:
        out, state, moves = [], self.state, self.moves
        for i in ids:
            move = moves.get((state, i))
            if move is None:
                move = moves[state, i] = self._move(state, self.token[i])
            state = move[0]
            out.append(move[1])
        self.state = state
        return "".join(out)

    def end(self) -> str:
        rest, self.state = "�" if self.state else "", b""
        return rest


class Codec:
    """Encoder and decoder of whole texts; a worker keeps one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.fst, self.pattern = Transducer(ranks), regex.compile(pattern)
        self.machine = Utf8Machine(self.fst.token)
        # characters of the tokens that begin and end between characters
        self.plain: list[str | None] = [None] * (max(self.fst.token) + 1)
        for i, data in self.fst.token.items():
            move = self.machine.moves[b"", i] = self.machine._move(b"", data)
            if not move[0] and "�" not in move[1]:
                self.plain[i] = move[1]
        self.pieces = _Pieces(self.fst)

    def encode(self, text: str | None) -> array:
        text = text or ""
        found = self.pattern.findall(text) if len(text) < LONG_TEXT else (m[0] for m in self.pattern.finditer(text))
        ids = array("I")
        ids.frombytes(b"".join(map(self.pieces.__getitem__, found)))
        return ids

    def decode(self, ids: Sequence[int]) -> str:
        """Characters of the tokens.  As long as the machine is in its first
        state, tokens of whole characters leave it there: only the others, and
        what follows them until their characters are complete, are fed to it."""
        found = list(map(self.plain.__getitem__, ids))
        try:
            return "".join(found)
        except TypeError:  # None is no text
            out, start, machine = [], 0, self.machine
        while True:
            try:
                at = found.index(None, start)
            except ValueError:
                return "".join([*out, *found[start:], machine.end()])
            out += found[start:at]
            start = at
            while start < len(found) and (machine.state or start == at):
                out.append(machine.feed(ids[start:start + 1]))
                start += 1


class _Pieces(dict):
    """Token ids by piece, as bytes of an ``array("I")``.  When it is full, what it holds becomes the former
    generation; a piece found there moves up, the rest of it goes next time.
    So frequent pieces stay and rare ones don't pile up."""

    def __init__(self, fst: Transducer):
        self.fst, self.former = fst, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) > PIECES_KEPT:
            self.former = dict(self)
            self.clear()
        ids = self[piece] = self.former.get(piece) or array("I", self.fst.encode(piece.encode())).tobytes()
        return ids


_codecs: dict[tuple, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec of a broadcast vocabulary."""
    ranks, pattern, key = shared.value
    if key not in _codecs:
        _codecs.clear()
        gc.set_threshold(1_000_000)  # states and arcs are many and hold no cycles
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def _share(spark, path: str, pattern: str):
    ranks = read_ranks(path)  # a vocabulary: its size does not depend on the corpus
    return spark.sparkContext.broadcast((ranks, pattern, (path, len(ranks), pattern)))


def encode(text: str | Column, spark, path: str, pattern: str) -> Column:
    """Token ids of each whole text, array<int>."""
    shared = _share(spark, path, pattern)

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared)
        for texts in batches:
            yield texts.map(lambda t: list(codec.encode(t)))

    return encoded(text)


def decode(ids: str | Column, spark, path: str, pattern: str) -> Column:
    """Text of each array of token ids; null for null."""
    shared = _share(spark, path, pattern)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared)
        for rows in batches:
            yield rows.map(lambda r: None if r is None else codec.decode(r))

    return decoded(ids)


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers) and decoded_sha256 of every document: encoded, then decoded
    from the ids."""
    shared = _share(docs.sparkSession, path, pattern)

    def one(codec: Codec, text: str | None):
        ids = codec.encode(text)
        decoded = codec.decode(ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(shared)
        for texts in batches:
            yield pd.DataFrame([one(codec, t) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digests(F.coalesce("text", F.lit(""))).alias("d")).select("doc_id", "d.*")
