"""Best-fit packing with bins of several capacities.

Documents are cut into pieces of at most the largest capacity, and the pieces
are packed into bins whose capacity is one of ``CAPACITIES``.  Pieces are
dealt by hash to shards of bounded size, and each shard is packed by itself:

- pieces go by falling length into the open bin that they leave the least
  room in;
- a piece that fits nowhere opens a bin of the size that costs least for each
  token it can be filled with, counting the pieces still to come that would
  fit beside it;
- that plan stands against those that open one size wherever it suffices, and
  the cheapest is taken;
- at last every bin is downsized to the smallest capacity that holds what is
  in it.

A bin costs its capacity and ``OVERHEAD``.

Defined cases: a null or empty text, or one without words, has no token; it
gives one row with 0 tokens and no bin.  Repeated rows are packed each.  A
document of any length is cut, never shortened; its pieces may lie in several
bins.  Ties go by id and piece.  A null id is packed like any other.  Further
columns, whatever their names, are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 64
SHARD = 50_000  # pieces packed together, about; the number of shards grows with the corpus


def _best_fit(lengths: list[int], capacities: tuple[int, ...], opens) -> list[tuple[int, list[int]]]:
    """(capacity, pieces) of each bin; lengths fall.  ``opens(i)``: the
    capacity of a bin opened for piece i."""
    bins: list[tuple[int, list[int]]] = []
    rooms: list[int] = []  # distinct rooms of open bins, rising
    by_room: dict[int, list[int]] = {}

    def put(room: int, b: int) -> None:
        if room:
            if room not in by_room:
                insort(rooms, room)
                by_room[room] = []
            by_room[room].append(b)

    for i, n in enumerate(lengths):
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            room, b = opens(i), len(bins)
            bins.append((room, []))
        bins[b][1].append(i)
        put(room - n, b)
    return bins


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> list[tuple[int, list[int]]]:
    """(capacity, pieces) of each bin of the cheapest plan, downsized.
    ``lengths`` fall and are at most the largest capacity."""
    sizes = tuple(sorted(capacities))
    n = np.array(lengths, np.int64)
    tail = np.concatenate([np.cumsum(n[::-1])[::-1], [0]])  # tokens from piece i on

    def least_cost(i: int) -> int:
        best = None
        for c in sizes[bisect_left(sizes, lengths[i]):]:
            beside = max(i + 1, len(n) - int(np.searchsorted(n[::-1], c - lengths[i], side="right")))
            fill = min(c, lengths[i] + int(tail[beside]))
            rate = (c + overhead) / fill
            if best is None or rate < best[0]:
                best = (rate, c)
        return best[1]

    plans = [least_cost] + [lambda i, c=c: max(c, sizes[bisect_left(sizes, lengths[i])]) for c in sizes]
    fitted = []
    for opens in plans:
        bins = [(sizes[bisect_left(sizes, sum(lengths[i] for i in items))], items) for _, items in _best_fit(lengths, sizes, opens)]
        fitted.append((sum(c + overhead for c, _ in bins), bins))
    return min(fitted, key=lambda p: p[0])[1]


def n_words(text: str | Column = "text") -> Column:
    """Words of a text (runs of other than ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


PACKED = "doc_id long, piece int, start long, n_tokens int, bin_id long, bin_start int, bin_capacity int"


def pack_documents(docs: DataFrame, length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """PACKED: one row for each piece of a document.  ``start`` is its first
    token in the document, ``bin_start`` its first place in the bin."""
    most = max(capacities)
    # rows are dealt by a number of their own, fixed in the stored table: any number of them may share an id
    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (n_words() if length is None else length).alias("n"),
                         F.monotonically_increasing_id().alias("row")).checkpoint()
    cut = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / most).cast("int")))
    pieces = (tokens.where(F.col("n") > 0).select("doc_id", "row", "n", cut.alias("piece"))
              .select("doc_id", "row", "piece", F.least(F.lit(most), F.col("n") - F.col("piece").cast("long") * most).cast("int").alias("n_tokens")))
    shards = max(1, -(-pieces.count() // SHARD))

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths, shard = table["n_tokens"].to_pylist(), table["shard"][0].as_py()
        bin_id, place, size = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for b, (capacity, items) in enumerate(pack(lengths, capacities)):
            at = 0
            for i in items:
                bin_id[i], place[i], size[i] = shard << 32 | b, at, capacity
                at += lengths[i]
        start = table["piece"].to_numpy().astype(np.int64) * most
        return pa.table([table["doc_id"], table["piece"], pa.array(start), table["n_tokens"], pa.array(bin_id),
                         pa.array(place.astype(np.int32)), pa.array(size.astype(np.int32))], names=[f.split()[0] for f in PACKED.split(", ")])

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    empty = tokens.where(F.col("n") <= 0).select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).alias("n_tokens"),
        F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("bin_start"), F.lit(None).cast("int").alias("bin_capacity"))
    return dealt.groupBy("shard").applyInArrow(packed, PACKED).unionByName(empty)
