"""Connected components of links between 64-bit node ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.workspace import written

#: Links that one task connects by itself (16 MB).
FEW = 1_000_000


def labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links and the smallest node that each reaches, within one task."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        lower = label.copy()
        for side in (left, right):
            np.minimum.at(lower, side, low)
            np.minimum.at(lower, label[side], low)
        while (lower[lower] != lower).any():
            lower = lower[lower]
        if (lower == label).all():
            return nodes, nodes[label]
        label = lower


def _connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as (node, root) of a forest that connects the same nodes."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        a.append(np.asarray(batch.column("a")))
        b.append(np.asarray(batch.column("b")))
        if sum(map(len, a)) > FEW:
            nodes, roots = labels(np.concatenate(a), np.concatenate(b))
            a, b = [nodes[nodes != roots]], [roots[nodes != roots]]
    nodes, roots = labels(np.concatenate(a), np.concatenate(b))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["node", "root"])


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """``edges`` (a, b) as (node, root): the root is the smallest node reachable.

    Every task first connects its own links, which leaves a forest of them. If no more than
    ``few`` remain, one task connects these. Otherwise in each round every node points to
    its smallest neighbour and then to that one's choice; edges are carried over to the
    nodes pointed at, where most fall away, until they are few. Each round is written, so
    lineage stays short. Nulls and self-links are ignored; nodes without links to others
    get no row; no edges give no rows.
    """
    forest = edges.filter("a != b").select("a", "b").mapInArrow(_connect, "node long, root long")
    forest = forest.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    edges = written(forest, "cc-edges")
    mapping = None
    while edges.count() > few:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = written(
            both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("to")),
            "cc-nearest",
        )
        step = written(
            nearest.alias("n").join(nearest.alias("m"), F.col("n.to") == F.col("m.node"))
            .select("n.node", F.col("m.to").alias("to")),
            "cc-step",
        )
        if mapping is None:
            mapping = step.select("node", F.col("to").alias("root"))
        else:
            mapping = _through(mapping, step.toDF("node", "root"))
        mapping = written(mapping, "cc-mapping")
        carried = (
            edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("a_to")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("b_to")), "b")
            .select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        )
        onward = (
            step.alias("s").join(step.alias("t"), F.col("s.to") == F.col("t.node"))
            .filter("t.node != t.to")
            .select(F.col("t.node").alias("a"), F.col("t.to").alias("b"))
        )
        edges = written(_proper(carried.unionByName(onward)), "cc-edges")
    last = edges.coalesce(1).mapInArrow(_connect, "node long, root long")
    last = written(last, "cc-last")
    return last if mapping is None else written(_through(mapping, last), "cc-mapping")


def _through(mapping: DataFrame, step: DataFrame) -> DataFrame:
    """``mapping`` followed by ``step``."""
    return (
        mapping.alias("m").join(step.alias("s"), F.col("m.root") == F.col("s.node"), "left")
        .select("m.node", F.coalesce("s.root", "m.root").alias("root"))
    )


def _proper(edges: DataFrame) -> DataFrame:
    return (
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
