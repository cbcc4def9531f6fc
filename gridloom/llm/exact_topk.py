"""Exact top-k search by inner product with an impact-ordered, score-at-a-time index.

Rows are dealt by hash into candidate blocks of bounded expected size, and every query goes
to every block. Each block's rows are sorted so that its candidates come first: they are
indexed once by segments, for each dimension and level of its components what the candidates
have within that level, and the block's queries then stream past the index in batches. A query
takes the segments by descending impact (its component's size times the level's reach above the
least useful value), in rounds; as every vector has every dimension, a segment is a dense row, and
a round is one matrix product for all queries of a batch that are still open. Each candidate's sum
says what it can still reach with the segments not yet taken. A query stops only on proof: a
candidate that can't reach the k-th best exact score among those ahead cannot be a member. Every
possible member is then rescored exactly. The k best of each block meet in a window by query. A task
holds one block's index (``LEVELS * dims`` numbers a candidate) and one batch of queries.

The job is quadratic by nature, as the queries are a share of the rows; the index makes a pair cheap.

Defined results: vectors that are null or hold null, NaN or infinite components take no
part; a query is compared with vectors of its own length, and with every row but those
of its own id; of repeated candidates each is a row of its own; a query row that
is repeated answers once, and of unequal rows with one query id the best k together; ties go
to the smaller id; without candidates a query has no rows. Sums and scores are exact: where
they could exceed 2^53 in a block, its candidates are scored with integers of any size and
without the index, and a score beyond 64 bits is given as the nearest 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of candidates, levels of a dimension, rounds of reading (each ends with a proof), queries in a round.
CANDIDATES, LEVELS, ROUNDS, BATCH = 8192, 4, 3, 64
#: Up to here every integer is a double.
EXACT, LONG = 1 << 53, (1 << 63) - 1


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


class ImpactIndex:
    """Segments over the integer vectors of a block."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors.astype(float)
        n, dims = vectors.shape
        # By level and dimension; as many candidates in each level of a dimension as equal components allow.
        edges = np.sort(self.vectors, axis=0)[np.linspace(0, n - 1, LEVELS + 1).astype(int)]
        self.low, self.high = edges[0], edges[-1]
        self.below, self.above = edges[:-1].ravel(), edges[1:].ravel()
        self.widths = self.above - self.below
        #: By segment: the part of each candidate's component that lies within the level. A dimension's parts add up to the component above the least.
        self.segments = np.tile(self.vectors.T, (LEVELS, 1))
        np.clip(self.segments, self.below[:, None], self.above[:, None], out=self.segments)
        self.segments -= self.below[:, None]

    def rounds(self, queries: np.ndarray) -> np.ndarray:
        """By query and segment: the round in which the query takes it, those of the largest impact first; ROUNDS for those that can't change a score."""
        size, up = np.tile(np.abs(queries), LEVELS), np.tile(queries >= 0, LEVELS)
        reach = np.where(up, self.above - np.tile(self.low, LEVELS), np.tile(self.high, LEVELS) - self.below)
        useful = (size > 0) & (self.widths > 0)
        order = np.argsort(np.where(useful, -size * reach, 1), axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None], axis=1)
        return np.minimum(place * ROUNDS // np.maximum(useful.sum(1, keepdims=True), 1), ROUNDS)

    def members(self, queries: np.ndarray, k: int, owns: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(query, positions of all candidates that may be among its k best), in the order of their proofs; own positions are left out."""
        n = len(self.vectors)
        queries = queries.astype(float)
        takes, weights = self.rounds(queries), np.tile(queries, LEVELS)
        # What each candidate can still reach: at first the most that any vector within the block's ranges would have.
        most = np.repeat(np.maximum(queries * self.low, queries * self.high).sum(1)[:, None], n, axis=1)
        for q, own in enumerate(owns):
            most[q, own] = -np.inf
        asking = np.arange(len(queries))
        for now in range(ROUNDS):
            taken = np.where(takes[asking] == now, weights[asking], 0)
            most += taken @ self.segments
            most -= (np.maximum(taken, 0) @ self.widths)[:, None]
            open_ = np.ones(len(asking), bool)
            for at, q in enumerate(asking.tolist()):
                few = min(k, n - len(owns[q]))
                ahead = np.argpartition(most[at], max(0, n - 4 * k))[-4 * k :] if few else owns[q]
                ahead = ahead[most[at, ahead] > -np.inf]
                # The few-th best of those ahead by exact scores: who can't reach it is no member.
                bar = np.partition(self.vectors[ahead] @ queries[q], -few)[-few] if few else np.inf
                found = np.flatnonzero(most[at] >= bar)
                if len(found) <= max(64, 4 * k, n // 8) or now == ROUNDS - 1:
                    open_[at] = False
                    yield q, found
            if not open_.any():
                return
            asking, most = asking[open_], most[open_]

    def possible(self, query: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
        """Positions of all candidates that may be among the k best; own positions are left out."""
        return next(self.members(query[None], k, [own]))[1]

    def best(self, queries: np.ndarray, k: int, ids: np.ndarray, own_ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's id, ids and scores of its k best) of each query."""
        for start in range(0, len(queries), BATCH):
            some, own = queries[start : start + BATCH], own_ids[start : start + BATCH]
            for q, found in self.members(some, k, [np.flatnonzero(ids == x) for x in own]):
                scores = (self.vectors[found] @ some[q].astype(float)).astype(np.int64)
                order = np.lexsort((ids[found], -scores))[:k]
                yield int(own[q]), ids[found][order], scores[order]


class Block:
    """A block's candidates, indexed when its first query comes."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.index: ImpactIndex | None = None

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.parts.append((ids, vectors))

    def answer(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """(query, candidate, score) of the k best of each query, whose components are whole numbers, as the candidates' are."""
        if not self.parts:
            return
        if len(self.parts) > 1 or self.index is None:
            self.parts = [tuple(np.concatenate(x) for x in zip(*self.parts))]
            self.most = float(np.abs(self.parts[0][1]).max())
        held, vectors = self.parts[0]
        # What is summed on the way stays below four times the largest score.
        small = 4 * self.most * np.abs(queries).max(1, initial=0) * queries.shape[1] < EXACT
        for own, query in zip(ids[~small].tolist(), queries[~small]):
            whole = [int(x) for x in query]
            scores = ((sum(int(x) * q for x, q in zip(v, whole)), i) for i, v in zip(held.tolist(), vectors) if i != own)
            yield from ((own, i, max(-LONG - 1, min(LONG, x))) for x, i in sorted(scores, key=lambda s: (-s[0], s[1]))[:k])
        if small.any():
            if self.index is None:
                self.index = ImpactIndex(vectors.astype(np.int64))
            for own, found, scores in self.index.best(queries[small].astype(np.int64), k, held, ids[small]):
                yield from ((own, i, x) for i, x in zip(found.tolist(), scores.tolist()))


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` (the integer inner product of floor(scale * x))."""
    rows = (
        vectors.filter(usable(F.col(vec_col)))
        .select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("double") * F.lit(scale)).alias("v"), is_query.alias("asks"))
        .filter(F.col("id").isNotNull() & (F.size("v") > 0))
    )
    # Of equal rows no more than k can be among the best, and one asks.
    distinct = rows.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"), F.max("asks").alias("asks")).withColumn("dims", F.size("v"))
    blocks = -(-vectors.count() // CANDIDATES) or 1
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    candidates = (
        distinct.withColumn("copy", F.explode(numbers(F.col("times"))))
        .select("id", "v", "dims", F.pmod(F.xxhash64("id", "v", "copy"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asking"))
    )
    queries = distinct.filter("asks").select("id", "v", "dims", F.explode(numbers(F.lit(blocks))).alias("block"), F.lit(True).alias("asking"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, Block()
        for batch in batches:
            keys = [np.asarray(pc.cast(batch.column(name), pa.int64())) for name in ("dims", "block", "asking")]
            ids, flat = np.asarray(batch.column("id")), np.floor(np.asarray(batch.column("v").flatten()))
            offsets = np.r_[0, np.cumsum(keys[0])]
            cuts = np.flatnonzero(np.any([np.diff(x) != 0 for x in keys], axis=0)) + 1
            out: list[tuple[int, int, int]] = []
            for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(ids)].tolist()):
                if a == b:
                    continue
                if at != (keys[0][a], keys[1][a]):
                    at, held = (keys[0][a], keys[1][a]), Block()
                some = flat[offsets[a] : offsets[b]].reshape(b - a, -1)
                if keys[2][a]:
                    out += held.answer(ids[a:b], some, k)
                else:
                    held.add(ids[a:b], some)
            columns = [pa.array([x[i] for x in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    sides = candidates.unionByName(queries).repartition("dims", "block").sortWithinPartitions("dims", "block", "asking")
    parts = sides.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
