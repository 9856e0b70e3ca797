"""Exact top-k by inner product with MaxScore, over batches of integer vectors.

A component is a term, a vector's value in it the impact of a posting; a batch of vectors has the largest and smallest
impact of every term, and so bounds on what a query's term can add. Every query has a threshold: a score that k vectors
are known to reach, first from a few vectors that are looked at before all others, then from what was found so far.

A batch whose bounds over all terms stay below the threshold is skipped. Else the terms are put in order of what their
bounds allow, and split: terms at the end are non-essential if a vector that has the most there, but the least in the
terms before, stays below the threshold. Postings of essential terms are traversed for all vectors of the batch, as a
product of matrices. The others are probed, group by group, while a vector's partial score and the bounds that remain
reach the threshold; where few vectors are still competitive, these alone are looked at. Results of batches are merged
within a task, those of tasks by rank. Vectors are never moved: queries are, in blocks of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Tables

#: Bytes of a block of queries, which is sent to every task; more queries go in several rounds.
BLOCK_BYTES = 32 << 20
#: Vectors that the first thresholds come from, and components that each of them has at most.
SEED, SEED_WIDTH = 2048, 2048
#: Queries and vectors that are multiplied at once.
QUERIES, VECTORS = 1024, 4096
#: Terms that are probed at once, and the share of competitive vectors below which these are looked at one by one.
STEP, FEW = 16, 1 / 64
SCALE = 64
#: Scores beyond are given as this.
MOST = (1 << 63) - 1


def _kind(*matrices: np.ndarray) -> type:
    """A type in which all inner products of rows are exact: floats where sums stay below 2^24 or 2^53, else Python integers."""
    most = max((max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0) for m in matrices)
    total = most * most * max(1, matrices[0].shape[1])
    return np.float32 if total < 1 << 24 else np.float64 if total < 1 << 53 else object


class Best:
    """The k best candidates of some queries of one width so far."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.values, self.k = ids, values, k
        self.floor = [None] * len(ids) if floor is None else list(floor)  # scores that k candidates are known to reach
        self.q, self.i, self.s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)
        self.by_id = np.argsort(ids, kind="stable")

    def own(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) places with equal ids."""
        sorted_ids = self.ids[self.by_id]
        low, high = np.searchsorted(sorted_ids, ids, "left"), np.searchsorted(sorted_ids, ids, "right")
        at = np.flatnonzero(high > low)
        n = (high - low)[at]
        column = np.repeat(at, n)
        return self.by_id[low[column] + np.arange(len(column)) - np.repeat(np.cumsum(n) - n, n)], column

    def add(self, ids: np.ndarray, values: np.ndarray) -> None:
        """Looks at a batch of vectors."""
        kind = _kind(values, self.values)
        values, queries = values.astype(kind), self.values.astype(kind)
        high, low = values.max(axis=0), values.min(axis=0)
        most, least = np.maximum(queries * high, queries * low), np.minimum(queries * high, queries * low)
        worst = -np.inf if kind is not object else -(1 << 200)
        bar = np.array([worst if f is None else f for f in self.floor], kind if kind is object else np.float64)
        rows = np.flatnonzero(most.sum(axis=1) >= bar) if values.shape[1] else np.arange(len(queries))
        if not len(rows):
            return
        queries, most, least, bar = queries[rows], most[rows], least[rows], bar[rows]
        order = np.argsort(-(most - least).sum(axis=0).astype(np.float64), kind="stable")
        rest = np.zeros((len(rows), len(order) + 1), most.dtype)  # the most that terms from a place on can add
        rest[:, :-1] = np.cumsum(most[:, order][:, ::-1], axis=1)[:, ::-1]
        before = np.cumsum(least[:, order], axis=1) - least[:, order]  # the least that terms before a place add
        essential = int((before + rest[:, :-1] >= bar[:, None]).sum(axis=1).max(initial=0))
        at = min(len(order), max(essential, STEP))
        # How many more terms are worth while for all vectors is tried on a few of them.
        tried = values[:: max(1, len(ids) // 64)]
        seen = queries[:, order[:at]] @ tried[:, order[:at]].T
        while at < len(order) and (seen >= (bar - rest[:, at])[:, None]).mean() >= FEW:
            step = order[at : at + STEP]
            seen = seen + queries[:, step] @ tried[:, step].T
            at += len(step)
        partial = queries[:, order[:at]] @ values[:, order[:at]].T
        own_q, own_v = self.own(ids)
        place = np.full(len(self.ids), -1)
        place[rows] = np.arange(len(rows))
        keep = place[own_q] >= 0
        partial[place[own_q[keep]], own_v[keep]] = worst
        k, new = self.k, np.flatnonzero(bar == worst)
        if at == len(order) and len(ids) > k and len(new):
            bar[new] = np.partition(partial[new], -k, axis=1)[:, -k] if kind is not object else np.sort(partial[new], axis=1)[:, -k]
        need = bar - rest[:, at]
        q, v = np.nonzero(partial >= (need if kind is object else need.astype(partial.dtype))[:, None])
        scores = partial[q, v]
        real = scores > worst
        q, v, scores = q[real], v[real], scores[real]
        if at < len(order):
            left = order[at:]
            for x in range(0, len(q), 1 << 16):  # the vectors that are still competitive, one by one
                y = slice(x, x + (1 << 16))
                scores[y] += (queries[q[y]][:, left] * values[v[y]][:, left]).sum(axis=1)
            good = scores >= bar[q]
            q, v, scores = q[good], v[good], scores[good]
        self.merge(rows[q], ids[v], scores)

    def merge(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        exact = self.s.dtype == object and scores.dtype == object
        s = np.concatenate([self.s, scores]) if exact or (len(self.s) and self.s.dtype == object) else np.concatenate([self.s.astype(np.float64), scores.astype(np.float64)])
        q, ids = np.concatenate([self.q, q]), np.concatenate([self.i, ids])
        order = np.lexsort((ids, -s, q)) if s.dtype != object else np.array(sorted(range(len(s)), key=lambda j: (q[j], -s[j], ids[j])), np.int64)
        q, ids, s = q[order], ids[order], s[order]
        first = np.searchsorted(q, q, "left")
        rank = np.arange(len(q)) - first
        keep = rank < self.k
        for j in np.flatnonzero(rank == self.k - 1):
            f = self.floor[q[j]]
            self.floor[q[j]] = s[j] if f is None else max(f, s[j])
        self.q, self.i, self.s = q[keep], ids[keep], s[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.ids[self.q], self.i, np.array([min(max(int(x), -MOST), MOST) for x in self.s], np.int64)


def _look(best: list[Best], ids: np.ndarray, values: np.ndarray) -> None:
    for a in range(0, len(ids), VECTORS):
        for b in best:
            b.add(ids[a : a + VECTORS], values[a : a + VECTORS])


def shard_top(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score): of each query the k best of these vectors (ties to the smaller id), without the query's own id."""
    best = Best(query_ids, queries, k)
    _look([best], ids, values)
    return best.rows()


def _by_width(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, ids and matrix of the vectors of each width."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    widths = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    ends, ids = np.cumsum(widths), ids.to_numpy(zero_copy_only=False)
    out = {}
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        out[int(w)] = at, ids[at], flat[(ends[at] - w)[:, None] + np.arange(w)]
    return out


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; vectors that are null or hold null or non-finite components are left out. Components beyond 4e18 are cut to it."""
    finite = "embedding is not null and vec_id is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('infinity'))"
    return embeddings.where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"transform(embedding, x -> cast(floor(greatest(-4e18D, least(4e18D, cast({scale} as double) * cast(x as double)))) as bigint))").alias("v"))


def _floors(asked: DataFrame, seed: pa.Table, k: int) -> DataFrame:
    """Queries with the score that k of the seed's vectors reach; null where there are fewer."""
    held = asked.sparkSession.sparkContext.broadcast(seed)

    def run(batches):
        vectors = _by_width(held.value["vec_id"], held.value["v"])
        for batch in batches:
            floor: list = [None] * batch.num_rows
            for w, (at, ids, values) in _by_width(batch.column(0), batch.column(1)).items():
                if w not in vectors:
                    continue
                for a in range(0, len(at), QUERIES):
                    best = Best(ids[a : a + QUERIES], values[a : a + QUERIES], k)
                    _look([best], *vectors[w][1:])
                    for j, f in enumerate(best.floor):
                        floor[at[a + j]] = None if f is None or abs(f) > MOST else int(f)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(floor, pa.int64())], names=["vec_id", "v", "floor"])

    return asked.mapInArrow(run, "vec_id bigint, v array<bigint>, floor bigint")


def top_k(vectors: DataFrame, queries, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: of every query (rows of vectors for which the condition `queries` holds) the k vectors with the largest inner product, ties to the smaller id.

    vectors: (vec_id long, v array<long>). A query's own id is no candidate. Vectors are compared with queries of equal
    length only. Rows that repeat id and vector are one query, but each is a candidate. Queries are sent to all tasks
    in blocks of BLOCK_BYTES, a round for each block, so what is broadcast does not grow with the data.
    """
    spark = vectors.sparkSession
    tables = Tables(spark, "search")
    asked = vectors.where(queries).dropDuplicates(["vec_id", "v"])
    n, components = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("v").cast("long")), F.lit(0))).first()
    rounds = max(1, -(-8 * (components + 4 * n) // BLOCK_BYTES))
    seed = vectors.where(F.size("v") <= SEED_WIDTH).limit(SEED).toArrow()
    asked = _floors(asked, seed, k)
    if rounds > 1:
        asked = tables.put(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(rounds)).cast("int")), "queries")
    best_of = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    parts = []
    for i in range(rounds):
        block = (asked.where(F.col("block") == i) if rounds > 1 else asked).select("vec_id", "v", "floor").toArrow()
        held = spark.sparkContext.broadcast(block)

        def run(batches, held=held):
            asked_, best = held.value, {}
            floors = np.array(asked_["floor"].to_pylist(), object)
            for w, (at, ids, values) in _by_width(asked_["vec_id"], asked_["v"]).items():
                best[w] = [Best(ids[a : a + QUERIES], values[a : a + QUERIES], k, floors[at[a : a + QUERIES]]) for a in range(0, len(at), QUERIES)]
            for batch in batches:
                for w, (_, ids, values) in _by_width(batch.column(0), batch.column(1)).items():
                    _look(best.get(w, []), ids, values)
            for b in [b for bs in best.values() for b in bs]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in b.rows()], names=["query_id", "vec_id", "score"])

        found = vectors.select("vec_id", "v").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
        ranked = found.withColumn("rank", F.row_number().over(best_of)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if rounds == 1:
            return ranked
        parts.append(tables.put(ranked, "found"))
        held.unpersist()
    out = spark.read.schema(parts[0].schema).parquet(*[p._lexstrata_path for p in parts])
    # A query id may stand for several vectors, which may be in several blocks.
    return out.withColumn("rank", F.row_number().over(best_of)).where(F.col("rank") <= k)


def search(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """Top k of every vector whose vec_id is divisible by `every`. Repeated ids are candidates each; a row is never its own id's candidate.
    Other columns are not read; without usable vectors, queries or other candidates there are no rows."""
    return top_k(quantised(embeddings), F.expr(f"vec_id % {every} = 0"), k)
