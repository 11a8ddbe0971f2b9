"""Which rows of two tables differ, found by descending a tree of hashes.

Rows are dealt to buckets by a hash of their key. A bucket's sum is the number of its rows
and two sums of row hashes, which do not depend on order; parents add up their children, up
to one root. A tree is a small table that can be kept with its table. Two trees are compared
from the root down, below unequal nodes only, and only rows of unequal buckets are read
again and compared one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

#: Children of a node, as a power of two, and levels below the root: 65,536 buckets.
FAN_BITS = 4
DEPTH = 4
#: Row hashes are added modulo a prime below 2**61, in decimal.
PRIME = (1 << 61) - 1


def _bucket(keys: Sequence[str], depth: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << (FAN_BITS * depth)))


def _digest(columns: Sequence[str], seed: int) -> Column:
    """A hash of the row in which nulls have a place, so that they cannot trade places."""
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(PRIME)).cast("decimal(19,0)")


def hash_tree(rows: DataFrame, keys: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """(level, node, rows, a, b): the sums of every node that has rows; level 0 is the root.

    Columns are taken by name, whatever their order. One aggregate with partial sums, then
    sums of sums; ``depth`` bounds the size of the tree.
    """
    names = sorted(rows.columns)

    def total(name: str) -> Column:
        return (F.sum(name) % F.lit(PRIME)).cast("decimal(19,0)").alias(name)

    leaves = written(
        rows.select(_bucket(keys, depth).alias("node"), _digest(names, 1).alias("a"), _digest(names, 2).alias("b"))
        .groupBy("node").agg(F.count("*").alias("rows"), total("a"), total("b")),
        "hash-leaves",
    )
    levels = leaves.select(
        F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"), F.col("node").alias("leaf"), "rows", "a", "b"
    ).withColumn("node", F.expr(f"shiftright(leaf, {FAN_BITS} * ({depth} - level))"))
    return written(
        levels.groupBy("level", "node").agg(F.sum("rows").alias("rows"), total("a"), total("b")), "hash-tree")


def unequal_buckets(left: DataFrame, right: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(node): buckets in which two trees of the same depth differ. Each level is compared
    only below nodes that differ, so equal trees end at the root."""
    nodes = None
    for level in range(depth + 1):
        sides = [tree.filter(F.col("level") == level).drop("level") for tree in (left, right)]
        if nodes is not None:
            parent = F.expr(f"shiftright(node, {FAN_BITS})")
            sides = [
                side.withColumn("parent", parent).join(nodes, "parent", "left_semi").drop("parent")
                for side in sides
            ]
        a, b = (side.select("node", F.struct("rows", "a", "b").alias(name)) for side, name in zip(sides, "xy"))
        differ = a.join(b, "node", "full").filter(~F.col("x").eqNullSafe(F.col("y"))).select("node")
        found = written(differ, "hash-unequal")
        if level == depth or found.isEmpty():
            return found
        nodes = broadcast_if_small(found.withColumnRenamed("node", "parent"))
    return found


def row_differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    depth: int = DEPTH,
    left_tree: DataFrame | None = None,
    right_tree: DataFrame | None = None,
) -> DataFrame:
    """Keys whose rows differ: key columns, left_rows, right_rows and kind.

    ``kind`` is ``missing`` (no row on the right), ``extra`` (none on the left),
    ``repeated`` (the same rows, not equally often) or ``changed``. Null keys are keys.
    Trees kept from before save reading that side but for its unequal buckets. Rows are told
    apart by 122 bits of hashes. Map columns cannot be hashed.
    """
    if {*left.columns} != {*right.columns}:
        raise ValueError("the tables have different columns")
    left_tree = left_tree if left_tree is not None else hash_tree(left, keys, depth)
    right_tree = right_tree if right_tree is not None else hash_tree(right, keys, depth)
    buckets = broadcast_if_small(unequal_buckets(left_tree, right_tree, depth))
    names = sorted(left.columns)

    def suspects(rows: DataFrame, mine: int) -> DataFrame:
        near = rows.withColumn("node", _bucket(keys, depth)).join(buckets, "node", "left_semi")
        return near.select(
            *keys, _digest(names, 1).alias("_a"), _digest(names, 2).alias("_b"),
            F.lit(mine).alias("_left"), F.lit(1 - mine).alias("_right"),
        )

    counted = suspects(left, 1).unionByName(suspects(right, 0)).groupBy(*keys, "_a", "_b").agg(
        F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    one_side = (F.col("_left") == 0) | (F.col("_right") == 0)
    told = counted.groupBy(*keys).agg(
        F.sum("_left").alias("left_rows"), F.sum("_right").alias("right_rows"),
        F.max(one_side).alias("_changed"), F.max(F.col("_left") != F.col("_right")).alias("_differ"),
    ).filter("_differ")
    kind = (
        F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "extra")
        .when(F.col("_changed"), "changed").otherwise("repeated")
    )
    return told.select(*keys, "left_rows", "right_rows", kind.alias("kind"))
