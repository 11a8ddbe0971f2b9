"""Exact top-k by inner product without random access to the lists.

Candidates come in blocks. In a block every component has a sorted list of its values. A
query reads the lists from the end at which they add most to its score: from the top
where its own component is positive, from the bottom where it is negative. After each
round of reading, what a candidate has shown so far and the values at which the lists
stand give an upper bound of its score, and the values at the far ends of the lists a
lower bound. Candidates whose upper bound is below the k-th best known score or lower
bound cannot qualify; reading ends when few others are left, whose scores are then
resolved in whole numbers. All queries of a broadcast share the reading, so the bounds of
many queries are a product of matrices.

The best scores of a task go on to its next block, so later blocks stop earlier. Tasks
take whatever candidates their scan gives them and pass on k rows a query. Queries go out
in broadcasts of bounded size, one pass over the candidates each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trilayer.workspace import new_dir, written

SCALE = 256
K = 5
#: Queries of one broadcast have about so many bytes.
QUERY_BYTES = 16 << 20
#: Candidates of a block, queries bounded together, and the shares of the lists read by
#: the end of each round.
BLOCK = 4096
TOGETHER = 512
ROUNDS = (0.25, 0.5, 0.75)
#: Candidates left per query at which reading ends.
FEW = 64

_NO_ID = np.iinfo(np.int64).max


def whole_numbers(vectors: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as whole numbers. Vectors that are null, or hold null, NaN
    or infinite components, are left out."""
    sound = F.forall("x", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: x.cast("double")).alias("x"),
    ).filter(F.col("x").isNotNull() & sound).select(
        "vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v")
    )


class Lists:
    """The sorted lists of a block of candidates, one per component."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.size = len(values)
        self.order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, axis=0)
        self._shown: dict[tuple, np.ndarray] = {}

    def read(self, depth: int, top: bool, far: bool) -> np.ndarray:
        """What ``depth`` values of each list, from one end, show of the candidates. An
        unread value stands at the last one read, or at the ``far`` end of the list."""
        key = depth, top, far
        if key not in self._shown:
            part = slice(self.size - depth, None) if top else slice(0, depth)
            at = (0 if top else -1) if far else (self.size - depth if top else depth - 1)
            shown = np.tile(self.sorted[at].astype(np.float64), (self.size, 1))
            np.put_along_axis(shown, self.order[part], self.sorted[part].astype(np.float64), axis=0)
            self._shown[key] = shown
        return self._shown[key]


class Best:
    """The k best candidates that each query has met: high scores, then small ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.zeros((queries, k), np.int64)
        self.vec_id = np.zeros((queries, k), np.int64)
        self.known = np.zeros((queries, k), bool)

    def limit(self) -> np.ndarray:
        """The k-th score of each query; minus infinity if it has met fewer."""
        return np.where(self.known[:, -1], self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        old, at = np.nonzero(self.known)
        query = np.concatenate((old, query))
        score = np.concatenate((self.score[old, at], score))
        vec_id = np.concatenate((self.vec_id[old, at], vec_id))
        order = np.lexsort((vec_id, -score, query))
        query, score, vec_id = query[order], score[order], vec_id[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        at = query[keep], rank[keep]
        self.known[:] = False
        self.score[at], self.vec_id[at], self.known[at] = score[keep], vec_id[keep], True


def contenders(queries: np.ndarray, lists: Lists, own: np.ndarray, limit: np.ndarray, k: int):
    """(query, candidate) pairs that may belong to the k best, by reading the lists.

    ``own`` marks pairs that do not count, ``limit`` is a score that the k-th best of each
    query is known to reach.
    """
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    slack = np.abs(queries).sum(axis=1) * float(np.abs(lists.values).max())
    slack = np.where(slack < 2.0**52, 0.0, slack * 1e-12)[:, None]
    active = ~own
    for share in ROUNDS:
        depth = max(1, int(lists.size * share))
        upper = positive @ lists.read(depth, True, False).T
        upper += negative @ lists.read(depth, False, False).T
        if lists.size >= k:
            lower = positive @ lists.read(depth, True, True).T
            lower += negative @ lists.read(depth, False, True).T
            lower[own] = -np.inf
            reached = np.partition(lower, lists.size - k, axis=1)[:, lists.size - k]
            limit = np.maximum(limit, reached - slack[:, 0])
        active &= upper + slack >= limit[:, None]
        if active.sum() <= FEW * len(queries):
            break
    return np.nonzero(active)


def _meet(queries: tuple, best: Best, values: np.ndarray, ids: np.ndarray) -> None:
    """Let all queries of one width read one block of candidates."""
    query_ids, _, weights = queries
    largest = np.abs(weights.astype(np.float64)).sum(axis=1).max()
    if largest * np.abs(values.astype(np.float64)).max(initial=0) >= 2.0**62:
        raise ValueError("a score is beyond 64 bits")
    lists = Lists(values) if values.shape[1] else None
    limit = best.limit()
    found = []
    for low in range(0, len(weights), TOGETHER):
        some = weights[low : low + TOGETHER]
        own = query_ids[low : low + TOGETHER, None] == ids[None, :]
        if lists is None:
            query, candidate = np.nonzero(~own)
        else:
            query, candidate = contenders(
                some.astype(np.float64), lists, own, limit[low : low + TOGETHER], best.k)
        for at in range(0, len(query), 1 << 16):
            q, c = query[at : at + (1 << 16)], candidate[at : at + (1 << 16)]
            found.append((q + low, np.einsum("ij,ij->i", some[q], values[c]), ids[c]))
    if found:
        best.add(*(np.concatenate(part) for part in zip(*found)))


def _by_width(batch: pa.RecordBatch | pa.Table):
    """(width, rows, values) of the vectors ``v`` of a batch, at most BLOCK rows each."""
    column = batch.column("v")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten())
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
    for width in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == width)
        for low in range(0, len(rows), BLOCK):
            some = rows[low : low + BLOCK]
            yield width, some, flat[starts[some][:, None] + np.arange(width)]


def _reader(queries: dict[int, tuple], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {width: Best(len(q[0]), k) for width, q in queries.value.items()}
        for batch in batches:
            ids = np.asarray(batch.column("vec_id").fill_null(_NO_ID))
            for width, rows, values in _by_width(batch):
                if width in best:
                    _meet(queries.value[width], best[width], values, ids[rows])
        for width, found in best.items():
            query, at = np.nonzero(found.known)
            ids = found.vec_id[query, at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries.value[width][1][query], pa.int64()),
                 pa.array(ids, pa.int64(), mask=ids == _NO_ID), pa.array(found.score[query, at])],
                names=["number", "vec_id", "score"],
            )

    return run


def _query_arrays(block: pa.Table) -> dict[int, tuple]:
    """Per width: ids, numbers and components of the queries."""
    ids, numbers = np.asarray(block.column("vec_id")), np.asarray(block.column("number"))
    parts: dict[int, list] = {}
    for width, rows, values in _by_width(block):
        parts.setdefault(width, []).append((ids[rows], numbers[rows], values))
    return {
        width: tuple(np.concatenate(part) for part in zip(*found))
        for width, found in parts.items()
    }


def top_k(vectors: DataFrame, is_query, id_column: str = "vec_id", vector: str = "embedding",
          k: int = K, scale: int = SCALE, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row that meets
    ``is_query``, a condition on ``vec_id``, by the inner product of whole components.

    Candidates are all rows of the same width with another id; with fewer than k, all are
    returned. Equal scores go by the smaller id, a null id being the largest; a row
    without an id is no query. Rows that repeat an id are queries and candidates of their
    own, though not for each other. Vectors that are null or hold null, NaN or infinite
    components take no part; no vectors give no rows. A score beyond 64 bits ends the job.
    Other columns of ``vectors`` are ignored.
    """
    spark = vectors.sparkSession
    sound = whole_numbers(vectors, id_column, vector, scale)
    queries = written(
        sound.filter(is_query).withColumn("number", F.monotonically_increasing_id()), "top-k-queries"
    )
    rows, components = queries.agg(F.count("*"), F.sum(F.size("v"))).first()
    passes = max(1, -(-8 * ((components or 0) + 2 * rows) // query_bytes))
    path = new_dir(spark, "top-k-found")
    schema = "number long, vec_id long, score long"
    for turn in range(passes):
        some = queries.filter(F.pmod(F.xxhash64("number"), F.lit(passes)) == turn)
        sent = spark.sparkContext.broadcast(_query_arrays(some.toArrow()))
        sound.mapInArrow(_reader(sent, k), schema).write.mode("append").parquet(path)
        sent.unpersist()
    best = Window.partitionBy("number").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = (
        spark.read.schema(schema).parquet(path)
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    )
    named = queries.select("number", F.col("vec_id").alias("query_id"))
    return ranked.join(named, "number").select("query_id", "rank", "vec_id", "score")
