"""N-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct shingles of ``words`` words
(``WORDS`` if not said).  Two sets of sizes a <= b link when their similarity
is ``share`` at least; with ``SHARE``, when 100 |A & B| >= 90 |A | B|: then
they differ in at most (a + b) / 19 shingles, and b <= a / 0.9.

Sketch.  Documents of a size band deal their shingles by hash into segments,
and the hashes in a segment are combined by exclusive or.  A shingle in one
set only changes one segment, so the number of differing segments is a lower
bound of the symmetric difference; so is the Hamming distance of the folded
sketch, in which each shingle flips one bit.

Join.  A band has more segments than its sets may differ in shingles, so of
the first d + 1 segments of linked sets one at least is equal (d: the most
that a set of that size may differ from any partner).  Each set enters its own
band, and the next one too if a partner may be there; equal segments of a band
make candidates.  Empty segments would meet by chance, so there are some
segments to spare, and a set with no more empty ones than that leaves them
out: another segment must then be equal.  So linked sets share not one key but
as many as there are segments to spare beyond the empty ones (``need``): sets
with fewer shared keys link with nothing, and at last, where all keys that two
sets share are seen, pairs with fewer are left out.

No pair is spelled out that components don't need.  Equal sets are one class,
which stands for its copies.  In each segment key a leader, another one in
each round, meets the key's members (at first the least by hash of all, so
that the keys of a group agree on it; and of the leaders that a member meets,
only the one that most of its keys name; later, of all pairs that meet between
two components, one); the links found are contracted to components.  Keys whose members have become one component are done.  In the
others, every member outside the key's largest component meets all members of
other components.  Meeting first compares sizes and folded sketches, in the
join, then the pairs' wide sketches, which have a bit for each shingle at least:
long sets that share no more than a few keys differ there too.  What is left is
verified on the whole sets.

Defined cases: null or empty texts, and those without words, have an empty
set, link with nothing and are their own component; a text of fewer than
``words`` words is one shingle; repeated rows are copies; rows that share an id
are one document for links; a null id gives no link, and its component is the
least id among its copies or null.  Texts are whole.  Further columns,
whatever their names, are not read.  Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.store import Scratch, components, stored

WORDS = 3
SHARE = (90, 100)  # links from 90/100
BAND = 1.5  # ratio of a band's largest to its least size
FOLD = 4  # longs of the folded sketch
WIDE = 16  # least longs of the wide one, which pairs are compared by before their sets
ROUNDS = 3
IDS_BROADCAST = 1 << 20  # ids (8 MB) up to which they are sent to all tasks
WORDS_KEPT = 300_000

_M = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z are lowered
    if not found:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    n = max(1, len(each) - words + 1)
    gram = np.full(n, min(words, len(each)), np.uint64)
    for i in range(min(words, len(each))):
        gram = _mix((gram ^ each[i:i + n]) * _M)
    return np.unique(gram)


def most_apart(size: int, share=SHARE) -> int:
    """The most shingles by which a set of this size differs from a linked one."""
    low, high = share
    return ((high - low) * (size + size * high // low)) // (high + low)


def spare(apart: int, share=SHARE) -> int:
    """Segments beyond those that the differing shingles may fill; the more of
    these, the fewer shingles a segment holds and the more are empty."""
    low, high = share
    return 1 + apart * 100 * (high - low) ** 2 // (16 * high**2)


def segments(s: np.ndarray, share=SHARE) -> tuple[np.ndarray, int]:
    """A hash for each (band, segment, combined hash) by which the set is
    joined, and the least number of them that any linked set has too."""
    apart = most_apart(len(s), share)
    if not apart:  # only an equal set links
        return np.zeros(0, np.uint64), 1
    band, out, need = int(np.log(len(s)) / np.log(BAND) + 1e-9), [], []
    for b in (band, band + 1):
        if b > band and len(s) * share[1] < BAND**b * share[0] * (1 - 1e-9):
            continue  # no partner is that large
        widest = most_apart(int(np.ceil(BAND ** (b + 1))), share)
        spared = spare(widest, share)  # the same for all sets of the band
        parts = widest + 1 + spared
        at = ((s >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        word = np.zeros(parts, np.uint64)
        np.bitwise_xor.at(word, at, _mix(s * _M))
        # linked sets differ in at most ``apart`` of these, so more than ``spared`` are equal; if all of
        # the equal ones are empty, both sets have more empty ones than that
        first = np.arange(min(parts, apart + 1 + spared), dtype=np.uint64)
        filled = np.bincount(at, minlength=parts)[:len(first)] > 0
        empty = np.count_nonzero(~filled)
        if empty <= spared:
            first = first[filled]
        need.append(spared + 1 - empty if empty <= spared else 1)
        out.append(_mix(_mix(word[first.astype(np.int64)] ^ (first + np.uint64(1)) * _M) * _M ^ np.uint64(b)))
    return np.unique(np.concatenate(out)), int(min(need))


def segment_keys(s: np.ndarray, share=SHARE) -> np.ndarray:
    """The keys of ``segments``."""
    return segments(s, share)[0]


def wide_longs(size: int) -> int:
    """Longs of a set's wide sketch: a power of two, and a bit for each shingle at least."""
    return max(WIDE, 1 << max(0, -(-size // 64) - 1).bit_length())


def folded(s: np.ndarray, longs: int = FOLD) -> np.ndarray:
    """Parity sketch of ``longs`` * 64 bits, the same for all sizes."""
    bits = np.zeros(longs, np.uint64)
    np.bitwise_xor.at(bits, ((s >> np.uint64(20)) % np.uint64(longs)).astype(np.int64), np.uint64(1) << ((s >> np.uint64(8)) & np.uint64(63)))
    return bits


def _sketch(words, share):
    @F.pandas_udf("n long, d1 long, d2 long, fold array<long>, wide array<long>, keys array<long>, need long")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                s = shingles(t, words)
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                keys, need = segments(s, share)
                rows.append((len(s), d[0], d[1], folded(s).view(np.int64), folded(s, wide_longs(len(s))).view(np.int64), keys.view(np.int64), need))
            yield pd.DataFrame(rows, columns=["n", "d1", "d2", "fold", "wide", "keys", "need"])

    return sketch


def _whole_set(text, words):
    @F.pandas_udf("array<long>")
    def whole(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingles(t, words).view(np.int64))

    return whole(text)


def _near(a: str, b: str, share):
    """Join condition that every link fulfils: sizes and Hamming distance of
    the folded sketches.  Columns are n and f0.. with a prefix."""
    low, high = share
    x, y = F.col(f"{a}n"), F.col(f"{b}n")
    distance = sum((F.bit_count(F.col(f"{a}f{i}").bitwiseXOR(F.col(f"{b}f{i}"))) for i in range(FOLD)), F.lit(0))
    return (high * F.least(x, y) >= low * F.greatest(x, y)) & ((high + low) * distance <= (high - low) * (x + y))


def _near_wide(share):
    """The same of the wide sketches: columns na, wa, nb, wb.  A sketch of
    twice the longs is folded to the other's; pairs that cannot be compared
    (more than that, or no sketch) are kept."""
    low, high = share

    def fitted(w: str, other: str):
        half = (F.size(w) / 2).cast("int")
        halved = F.zip_with(F.slice(w, F.lit(1), half), F.slice(w, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(w) > F.size(other), halved).otherwise(F.col(w))

    distance = F.aggregate(F.zip_with(fitted("wa", "wb"), fitted("wb", "wa"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    return F.coalesce((high + low) * distance <= (high - low) * (F.col("na") + F.col("nb")), F.lit(True))


def _named(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    names = ("id", "n", *(f"f{i}" for i in range(FOLD)), *more)
    return df.select("key", *(F.col(c).alias(prefix + c) for c in names))


def join_documents(docs: DataFrame, share=SHARE, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id that links reach)
    of every document."""
    with Scratch() as scratch:
        return stored(_joined(docs, words, share, scratch), "components")


def _joined(docs: DataFrame, words: int, share, scratch: Scratch) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    of_docs = scratch.stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _sketch(words, share)(text).alias("s")).select("doc_id", "s.*"), "keyed")
    # what is read to the end, without the keys, which are most of it
    sketches = scratch.stored(of_docs.select("doc_id", "n", "d1", "d2"), "sketches")
    # a class of equal sets is known by its least id
    classes = scratch.stored(sketches.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("id")), "classes")
    own = (of_docs.join(classes.where(F.col("id").isNotNull()).select("id", F.col("d1").alias("c1")),
                        (F.col("doc_id") == F.col("id")) & (F.col("d1") == F.col("c1")))
           .select("id", "n", *(F.col("fold")[i].alias(f"f{i}") for i in range(FOLD)), "wide", "keys", "need"))
    keyed = own.where(F.size("keys") > 0).select("id", F.explode("keys").alias("key"))
    shared = scratch.stored(keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key"), "keys")
    bare = scratch.stored(keyed.join(shared, "key"), "bare")  # both sides dealt anew: hot keys can be split
    live = scratch.stored(bare.groupBy("id").agg(F.count("*").alias("shared")), "live")
    # of rows that share an id one gives the sizes and the folded sketch, and there is no wide one
    one = own.drop("keys").join(live, "id").groupBy("id").agg(
        F.first("n").alias("n"), *(F.first(f"f{i}").alias(f"f{i}") for i in range(FOLD)),
        F.when(F.count("*") == 1, F.first("wide")).alias("wide"), F.min("need").alias("need"), F.first("shared").alias("shared"))
    narrow = scratch.stored(one.where("shared >= need").drop("shared"), "narrow")
    members = scratch.stored(bare.join(narrow.drop("wide"), "id"), "members")
    scratch.drop(shared, bare, of_docs, live)

    low, high = share
    links = tested = labels = None

    def verify(pairs: DataFrame) -> None:
        """Add the links among the distinct pairs (a, b), a < b, to those known."""
        nonlocal links, tested
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.stored(pairs, "pairs")
        wide = narrow.select("id", "n", "wide")
        near = pairs.join(wide.toDF("a", "na", "wa"), "a").join(wide.toDF("b", "nb", "wb"), "b").where(_near_wide(share))
        near = scratch.stored(near.select("a", "b"), "near")
        ids = scratch.stored(near.select(F.col("a").alias("want")).union(near.select("b")).distinct(), "ids")
        few = ids.count() <= IDS_BROADCAST  # else both sides are dealt by id
        wanted = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).join(F.broadcast(ids) if few else ids, F.col("id") == F.col("want"))
        sets = scratch.stored(wanted.select("id", _whole_set("text", words).alias("s")), "sets")
        left = near.join(sets.toDF("a", "sa"), "a")
        both = left.join(sets.toDF("b", "sb"), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        found = scratch.stored(both.where(high * common >= low * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "found")
        scratch.drop(near, ids, sets)
        links = found if links is None else links.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)

    def labelled() -> DataFrame:
        """All members, with their component."""
        if labels is None:
            return members.withColumn("c", F.col("id"))
        part = members.join(labels.select(F.col("id").alias("l"), "component"), F.col("id") == F.col("l"), "left").drop("l")
        return part.select(*members.columns, F.coalesce("component", "id").alias("c"))

    open_ = labelled()
    for turn in range(ROUNDS):
        lead = open_.groupBy("key").agg(F.min_by(F.struct("id", "n", *(f"f{i}" for i in range(FOLD)), "c"), F.xxhash64("id", "key") if turn else F.xxhash64("id")).alias("x"))
        lead = scratch.stored(lead.select("key", "x.*"), "leaders")
        met = _named(open_, "m_", "c").join(_named(lead, "l_", "c").withColumnRenamed("key", "k"),
                                            (F.col("key") == F.col("k")) & (F.col("m_c") != F.col("l_c")) & _near("m_", "l_", share))
        # of the leaders that a member meets, that which most of its keys name; later, of all that meet between two components, one pair
        ends = [F.least("m_c", "l_c").alias("c1"), F.greatest("m_c", "l_c").alias("c2")] if turn else [F.col("m_id").alias("c1")]
        met = (met.groupBy(*ends, "m_id", "l_id").agg(F.count("*").alias("keys")).groupBy(*(["c1", "c2"] if turn else ["c1"]))
               .agg(F.max_by(F.struct("m_id", "l_id"), F.struct("keys", "m_id", "l_id")).alias("x")).select("x.*"))
        verify(met.select(F.least("m_id", "l_id").alias("a"), F.greatest("m_id", "l_id").alias("b")).distinct())
        labels = components(links, scratch)
        all_ = labelled()
        still = scratch.stored(all_.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("key"), "still")
        part = scratch.stored(all_.join(still, "key"), "open")
        scratch.drop(lead, still, open_)
        open_ = part

    # what is left: in each key, those outside its largest component against all others
    sizes = open_.groupBy("key", "c").agg(F.count("*").alias("members"))
    major = scratch.stored(sizes.groupBy("key").agg(F.max_by("c", F.struct("members", "c")).alias("major")), "major")
    sides = open_.join(major, "key").withColumn("minor", F.col("c") != F.col("major"))
    minor = scratch.stored(sides.where("minor"), "minor")
    # a key names a pair once, also if both are outside its largest component
    met = _named(sides, "m_", "c", "need", "minor").join(_named(minor, "l_", "c", "need").withColumnRenamed("key", "k"),
                                                         (F.col("key") == F.col("k")) & (F.col("m_c") != F.col("l_c")) & _near("m_", "l_", share)
                                                         & (~F.col("m_minor") | (F.col("m_id") < F.col("l_id"))))
    met = (met.groupBy(F.least("m_id", "l_id").alias("a"), F.greatest("m_id", "l_id").alias("b"))
           .agg(F.count("*").alias("keys"), F.min(F.greatest("m_need", "l_need")).alias("need")).where("keys >= need"))
    verify(met.select("a", "b"))
    labels = scratch.stored(components(links, scratch), "labels")

    joined = (sketches.select("doc_id", "n", "d1", "d2")
              .join(classes.select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "id"), (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")), "left"))
    joined = joined.join(labels.select(F.col("id").alias("l"), "component"), F.col("id") == F.col("l"), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, share=SHARE, words: int = WORDS) -> DataFrame:
    """One document of each component, that with the least id; columns as
    given.  Of rows that share that id one stays.  Rows without an id, which
    no component is known by, stay."""
    kept = join_documents(docs, share, words).where("doc_id = component_id").select(F.col("doc_id").alias("kept_")).distinct()
    rows = docs.join(kept, docs["doc_id"].cast("long") == F.col("kept_"), "left_semi")
    again = stored(docs.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("again_")).count().where(F.col("count") > 1).select("again_"), "again")
    if not again.isEmpty():
        of = rows["doc_id"] == again["again_"]
        rows = rows.join(again, of, "left_anti").unionByName(rows.join(again, of, "left_semi").dropDuplicates(["doc_id"]))
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))
