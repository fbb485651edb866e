"""Exact top-k inner products by ball trees.

Vectors are dealt to shards of bounded size by their id; a task builds a ball
tree over a shard and answers a block of queries from it.  A node holds the
centre and the radius of its vectors, so no inner product below it exceeds
``q . centre + |q| * radius``; nodes are taken in the order of that bound, and
the search ends when the bound falls below the query's k-th best score so far.

That score is shared: each query first searches one shard, and the k-th best
found there goes along to all others, which start from it.  A shard then
returns only what may still be among the k best, and a window over these
ranks them.

Scores are integer inner products of floor(256 * component).  Of equal scores
the smaller id comes first.

Defined cases: vectors that are null, hold null or non-finite components, or
have a null id take no part; vectors of another length are no candidates; an
empty vector scores 0 with another; a row is no candidate for queries of its
own id; repeated query rows are one query, repeated candidate rows count each;
an empty table gives no row.  Scores beyond a long raise.  Further columns,
whatever their names, are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

SHARD = 8192  # vectors of a tree, about; the number of shards grows with the table
BLOCK = 8192  # queries a task answers from one tree, about
LEAF = 64


class BallTree:
    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        ids, points = ids[order], points[order]
        place, self.nodes = np.arange(len(ids)), []  # (first, end, left child, right child, least id)
        centre, radius, open_ = [], [], [(0, len(ids), -1, 0)]
        wide = points.astype(np.float64)
        while open_:
            a, b, parent, side = open_.pop()
            own = wide[place[a:b]]
            middle = own.mean(0)
            away = np.sqrt(((own - middle) ** 2).sum(1))
            me = len(self.nodes)
            self.nodes.append([a, b, -1, -1, int(ids[place[a:b]].min())])
            centre.append(middle)
            radius.append(away.max())
            if parent >= 0:
                self.nodes[parent][2 + side] = me
            if b - a > LEAF and radius[-1] > 0:
                one = own[away.argmax()]
                other = own[((own - one) ** 2).sum(1).argmax()]
                half = (b - a) // 2
                place[a:b] = place[a:b][np.argpartition(own @ (other - one), half)]
                open_ += [(a, a + half, me, 0), (a + half, b, me, 1)]
        self.ids, self.points = ids[place], points[place]
        self.centre, self.radius = np.array(centre), np.array(radius)
        self.most = int(np.abs(points).max(initial=0))

    def search(self, query: np.ndarray, own: int, k: int, least: int | None) -> list[tuple[int, int]]:
        """At most k (score, id), none below ``least``, best first."""
        most = self.most * int(np.abs(query).max(initial=0)) * max(1, len(query))
        if most >= 1 << 62:
            raise OverflowError("an inner product may exceed a long")
        exact = most < 1 << 52  # whole numbers in doubles
        q = query.astype(np.float64)
        norm = np.sqrt(q @ q)
        bound = self.centre @ q + norm * self.radius
        bound += 1e-9 * (np.abs(bound) + norm * (np.abs(self.centre).max(initial=0) * np.sqrt(len(q)) + 1)) + 1e-6
        best: list[tuple[int, int]] = []  # (score, -id), the worst first
        heap = [(-bound[0], 0)]
        while heap:
            limit, node = heapq.heappop(heap)
            worst = best[0] if len(best) == k else (least - 1 if least is not None else -(1 << 63), 0)
            if -limit < worst[0] or (least is not None and -limit < least):
                break
            first, end, left, right, least_id = self.nodes[node]
            if len(best) == k and int(np.floor(-limit)) == worst[0] and least_id > -worst[1]:
                continue
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-min(bound[child], -limit), child))
                continue
            block = self.points[first:end]
            score = (block.astype(np.float64) @ q).astype(np.int64) if exact else block @ query
            floor = worst[0] if len(best) == k else (least if least is not None else None)
            at = np.arange(len(score)) if floor is None else np.flatnonzero(score >= floor)
            for s, i in zip(score[at].tolist(), self.ids[first:end][at].tolist()):
                if i == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (floor(256 * component), longs) and dim of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("e"), finite.alias("ok"))
    v = F.transform("e", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("ok")).select("vec_id", v.alias("v"), F.size("e").alias("dim"))


FOUND = "query_id long, q array<bigint>, vec_id long, score long"


def _search(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """FOUND of each query (columns with q_) of a dim, shard and block among
    the candidates there."""

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.int64())), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        dim = left["dim"][0].as_py()
        matrix = lambda v: v.combine_chunks().flatten().to_numpy().reshape(len(v), dim)
        tree, own = BallTree(left["vec_id"].to_numpy(), matrix(left["v"])), matrix(right["q_v"])
        rows = []
        for i, (query, least) in enumerate(zip(right["q_vec_id"].to_pylist(), right["least"].to_pylist())):
            rows += [(query, i, v, s) for s, v in tree.search(own[i], query, k, least)]
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), right["q_v"].combine_chunks().take(pa.array([r[1] for r in rows], pa.int64())),
                         pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())], schema=schema)

    return (candidates.groupBy("dim", "shard", "block").cogroup(queries.groupBy("q_dim", "q_shard", "q_block"))
            .applyInArrow(answer, FOUND))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` for each of
    ``queries`` (both as ``whole_vectors`` gives them)."""
    checkpoint_dir(vectors.sparkSession)
    # candidates are dealt by a number of their own, fixed in the stored table, queries by id and vector: many may share an id
    vectors = vectors.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    shards = max(1, -(-vectors.count() // SHARD))
    queries = queries.distinct()
    blocks = max(1, -(-queries.count() // BLOCK))
    dealt = lambda n, *what: F.pmod(F.xxhash64(*what), F.lit(n)).cast("int")
    shard, block = dealt(shards, "vec_id", "v"), dealt(blocks, "vec_id", "v", F.lit("block"))
    every = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    candidates = vectors.select("vec_id", "v", "dim", dealt(shards, "row").alias("shard"), F.explode(every(blocks)).alias("block"))
    asked = queries.select(*(F.col(c).alias(f"q_{c}") for c in ("vec_id", "v", "dim")), shard.alias("home"), block.alias("q_block"))

    first = _search(candidates, asked.select("*", F.col("home").alias("q_shard"), F.lit(None).cast("long").alias("least")), k)
    first = first.checkpoint()
    kth = (first.groupBy(F.col("query_id").alias("k_id"), F.col("q").alias("k_v"))
           .agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k))
    onward = (asked.join(kth, (F.col("q_vec_id") == F.col("k_id")) & (F.col("q_v") == F.col("k_v")), "left")
              .select(*asked.columns, "least", F.explode(every(shards)).alias("q_shard"))
              .where(F.col("q_shard") != F.col("home")))
    found = first.unionByName(_search(candidates, onward, k)) if shards > 1 else first
    order = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
