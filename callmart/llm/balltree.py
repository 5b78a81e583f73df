"""Exact top-k by inner product: a ball tree in each shard, searched by branch and bound.

All vectors are dealt into shards of a bounded size. A shard is one ball tree: a node knows centre and radius of its
vectors, and no vector in it has a larger inner product with q than q·centre + |q| radius. Queries pass
through a shard in blocks; each query takes the leaves in the order of that bound and stops when the next bound is
below its kth score so far. Before the shards are searched, each query looks at one shard in full; the kth score
it finds there travels with it to all shards, so most of their nodes are cut off at once. Scores are
whole numbers, multiplied in doubles where these hold them, else in 64-bit integers, else, for very large components, in Python's
integers; the bounds are rounded up, so results are exact.

A block of queries is one row for a shard. A group holds one shard and a bounded number of blocks; where there are
more blocks, the shard is copied to several groups, so memory is bounded whatever the number of queries.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmart.llm.common import batches_of
from callmart.session import stage

#: Vectors of a shard, queries of a block, vectors of a leaf, blocks that meet a shard in one group.
SHARD_ROWS = 10_000
BLOCK_ROWS = 1_000
LEAF_ROWS = 64
BLOCKS_OF_GROUP = 64


LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _below(scores: np.ndarray) -> np.ndarray:
    """Doubles that are not over the scores."""
    near = scores.astype(np.float64)
    return np.where(np.abs(near) < 2.0**53, near, np.nextafter(near, -np.inf))


class BallTree:
    """Vectors, in the order of their leaves; all leaves have one level, so nodes are rows of arrays."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        groups = [np.arange(len(vectors))]
        while len(groups[0]) > leaf_rows:
            groups = [half for g in groups for half in self._halves(vectors, g)]
        order = np.concatenate(groups)
        self.vectors, self.ids = vectors[order], ids[order]
        self.largest = np.abs(vectors).max()
        self.starts = np.cumsum([0, *map(len, groups)])
        # Balls from the leaves up: (centre, radius) of 1, 2, 4 ... nodes.
        self.levels = []
        while True:
            centre = np.stack([vectors[g].mean(axis=0) for g in groups])
            radius = np.array([np.sqrt(((vectors[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centre, strict=True)])
            self.levels.insert(0, (centre, radius))
            if len(groups) == 1:
                break
            groups = [np.concatenate(groups[i : i + 2]) for i in range(0, len(groups), 2)]

    @staticmethod
    def _halves(vectors: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Split at the median of the direction between two vectors far apart."""
        own = vectors[group]
        a = own[((own - own[0]) ** 2).sum(axis=1).argmax()]
        b = own[((own - a) ** 2).sum(axis=1).argmax()]
        order = np.argsort(own @ (b - a), kind="stable")
        middle = len(group) // 2
        return group[order[:middle]], group[order[middle:]]

    def bounds(self, queries: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The bound of each leaf for each query; -inf below a node that cannot reach the query's floor."""
        alive = np.ones((len(queries), 1), bool)
        with np.errstate(over="ignore", invalid="ignore"):
            length = np.sqrt((queries**2).sum(axis=1))[:, None]
            for centre, radius in self.levels:
                if alive.shape[1] < len(centre):
                    alive = np.repeat(alive, 2, axis=1)
                # Rounding is small beside the lengths, not beside their product, which may cancel.
                slack = length * (np.sqrt((centre**2).sum(axis=1)) + radius) * 1e-12 + 1e-3
                bound = queries @ centre.T + length * radius + slack
                bound[np.isnan(bound)] = np.inf
                alive &= bound >= floor[:, None]
        return np.where(alive, bound, -np.inf)

    def scores(self, queries: np.ndarray, largest: float, a: int, b: int) -> np.ndarray:
        """Exact products with the vectors from a to b; those beyond 64 bits as the nearest number of 64 bits."""
        most = queries.shape[1] * largest * self.largest
        vectors = self.vectors[a:b]
        if most < 2.0**53:
            return (queries @ vectors.T).astype(np.int64)
        if most < 2.0**62:
            return queries.astype(np.int64) @ vectors.astype(np.int64).T
        whole = lambda x: np.array([[int(v) for v in row] for row in x], object)
        return np.clip(whole(queries) @ whole(vectors).T, LEAST + 1, MOST).astype(np.int64)

    def search(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
        """The k best (score, id) of each query but itself, and its kth score, at least ``floor``.

        Query i is the vector with id own[i]. Places beyond the vectors there are have the score ``LEAST``.
        """
        n = len(queries)
        best = np.full((n, k), LEAST)
        ids = np.full((n, k), MOST)
        floor = floor.copy()
        largest = np.abs(queries).max()
        bound = self.bounds(queries, floor)
        order = np.argsort(-bound, axis=1, kind="stable")
        active = np.arange(n)
        for turn in range(order.shape[1]):
            leaf = order[active, turn]
            reach = bound[active, leaf]
            # A vector that ties with the kth may have a smaller id, so equality goes on.
            alive = (reach >= floor[active]) & (reach > -np.inf)
            active, leaf = active[alive], leaf[alive]
            if not active.size:
                break
            by_leaf = np.argsort(leaf, kind="stable")
            cuts = np.flatnonzero(np.diff(leaf[by_leaf])) + 1
            for part in np.split(by_leaf, cuts):
                q, a, b = active[part], self.starts[leaf[part[0]]], self.starts[leaf[part[0]] + 1]
                scores = self.scores(queries[q], largest, a, b)
                scores[self.ids[a:b] == own[q][:, None]] = LEAST
                # Only queries that the leaf gives something in reach of their kth score are merged and sorted.
                top = scores.max(axis=1)
                hit = (top > LEAST) & (top >= floor[q])
                if not hit.any():
                    continue
                q, scores = q[hit], scores[hit]
                names = np.where(scores > LEAST, self.ids[a:b], MOST)
                all_scores, all_names = np.hstack([best[q], scores]), np.hstack([ids[q], names])
                top = np.lexsort((all_names, ~all_scores), axis=1)[:, :k]
                best[q], ids[q] = np.take_along_axis(all_scores, top, 1), np.take_along_axis(all_names, top, 1)
                full = best[q, -1] > LEAST
                floor[q[full]] = np.maximum(floor[q[full]], _below(best[q[full], -1]))
        return best, ids, floor


def _array(column: pd.Series, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, dims)


def quantised(rows: DataFrame, key: str, vector: str, factor: int) -> DataFrame:
    """id, v (floor(factor * x) as packed doubles) and n, the number of components, of the vectors that take part.

    Rows without id, without vector, with an empty one, or with a missing or non-finite component take no part; nor do those with
    a component whose product with ``factor`` is beyond all doubles.
    """
    limit = F.lit(sys.float_info.max / factor)
    whole = (
        F.col(key).isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= limit))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            # A product with a power of two is exact, and so is the floor of a double.
            packed = [np.floor(np.array(x.as_py(), np.float64) * factor) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in packed]), pa.array([len(x) for x in packed], pa.int32())],
                ["id", "v", "n"],
            )

    doubles = F.transform(vector, lambda x: x.cast("double")).alias("v")
    return rows.where(F.coalesce(whole, F.lit(False))).select(F.col(key).cast("long").alias("id"), doubles).mapInArrow(pack, "id long, v binary, n int")


_FOUND = "query_id long, vec_id long, score long, floor double"


def _search(k: int):
    """One shard: its vectors, and blocks of queries."""

    def run(key, shard: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(blocks):
            dims = int(shard["n"].iloc[0])
            shard = shard.sort_values("id", kind="stable")
            tree = BallTree(_array(shard["v"], dims), shard["id"].to_numpy())
            for row in blocks.itertuples():
                own = np.frombuffer(row.ids, np.int64)
                queries = np.frombuffer(row.v, np.float64).reshape(len(own), -1)
                known = np.frombuffer(row.floors, np.float64)
                best, ids, floor = tree.search(queries, own, known, k)
                q, place = np.nonzero((best > LEAST) & (best >= known[:, None]))
                out.append(
                    pd.DataFrame(
                        {"query_id": own[q], "vec_id": ids[q, place], "score": best[q, place], "floor": floor[q]}
                    )
                )
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "floor": []})
        types = {"query_id": "int64", "vec_id": "int64", "score": "int64", "floor": "float64"}
        return (pd.concat(out) if out else empty).astype(types)

    return run


def _blocks(queries: DataFrame, block_rows: int, count: int) -> DataFrame:
    """Queries of one length, about ``block_rows`` to a row: ids, vectors and floors, packed."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        return pd.DataFrame(
            {
                "n": group["n"].iloc[:1].to_numpy(),
                "block": group["block"].iloc[:1].to_numpy(),
                "ids": [group["id"].to_numpy(np.int64).tobytes()],
                "v": [b"".join(group["v"])],
                "floors": [group["floor"].to_numpy(np.float64).tobytes()],
            }
        )

    blocks = max(1, -(-count // block_rows))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    return dealt.groupBy("n", "block").applyInPandas(pack, "n int, block int, ids binary, v binary, floors binary")


def _copied(vectors: DataFrame, parts: int) -> DataFrame:
    """The vectors of each shard once for each part of the blocks."""
    return vectors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def top_k(
    rows: DataFrame,
    key: str,
    vector: str,
    is_query: Column,
    k: int = 5,
    factor: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    blocks_of_group: int = BLOCKS_OF_GROUP,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest whole-number inner products of each query with every other row.

    Components x become floor(factor * x). Ties go to the smaller id; a query with fewer than k others gets them
    all. Vectors are only compared with those of as many components. Rows whose vectors take no part are
    left out. Rows that repeat an id are candidates each, so an id may come more than once in a query's results; a query's id
    is one query, with the smallest vector of its rows, of which none is its result. A score beyond 64 bits is given as the
    nearest number of 64 bits. An empty table gives no rows.
    """
    flagged = quantised(rows.where(is_query), key, vector, factor)
    vectors = stage(quantised(rows, key, vector, factor), "vectors")
    queries = flagged.groupBy("id").agg(F.min(F.struct("v", "n")).alias("x")).select("id", "x.*")
    queries = stage(queries.withColumn("floor", F.lit(float("-inf"))), "queries")
    n, n_queries = vectors.count(), queries.count()
    shards = max(1, -(-n // shard_rows))
    # By the vector as well, so that rows of one id do not meet in one shard.
    shard = F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int")
    dealt = vectors.withColumn("shard", shard)
    blocks = _blocks(queries, block_rows, n_queries)

    def searched(vectors: DataFrame, blocks: DataFrame) -> DataFrame:
        on = ["n", "shard", "part"]
        return vectors.groupBy(*on).cogroup(blocks.groupBy(*on)).applyInPandas(_search(k), _FOUND)

    # First each block looks at one shard; block b at shard b mod shards.
    home_shard = F.pmod(F.col("block"), F.lit(shards)).cast("int").alias("shard")
    home_part = F.floor(F.col("block") / F.lit(shards * blocks_of_group)).cast("int").alias("part")
    home_blocks = blocks.select("*", home_shard, home_part)
    n_blocks = max(1, -(-n_queries // block_rows))
    home = searched(_copied(dealt, -(-n_blocks // (shards * blocks_of_group))), home_blocks)
    floors = home.groupBy(F.col("query_id").alias("id")).agg(F.max("floor").alias("known"))
    if shards > 1:
        better = queries.join(floors, "id", "left").select("id", "v", "n", F.coalesce("known", "floor").alias("floor"))
        everywhere = _blocks(better, block_rows, n_queries).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        everywhere = everywhere.withColumn("part", F.floor(F.col("block") / F.lit(blocks_of_group)).cast("int"))
        found = searched(_copied(dealt, -(-n_blocks // blocks_of_group)), everywhere)
    else:
        found = home
    # Few rows beyond k for a query: what its floor has let pass. Spark cuts to k before and after the shuffle.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
