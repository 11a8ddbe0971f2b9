from __future__ import annotations

import pytest

from trilayer.operators import hash_tree


def base(spark, rows=3000):
    return spark.range(rows).selectExpr(
        "IF(id = 11, NULL, id) AS k", "string(id % 13) AS a", "IF(id % 5 = 0, NULL, double(id)) AS v")


def kinds(left, right, keys=("k",), **how):
    found = hash_tree.row_differences(left, right, list(keys), **how)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_every_kind_of_difference(spark):
    rows = base(spark)
    copy = rows.selectExpr("v", "k", "IF(k = 20, 'x', a) AS a").filter("k IS NULL OR k NOT IN (7, 8)")
    copy = copy.unionByName(rows.filter("k = 30 OR k IS NULL"))
    copy = copy.unionByName(rows.filter("k = 40").selectExpr("9999 AS k", "a", "v"))
    copy = copy.unionByName(rows.filter("k = 50").selectExpr("k", "'other' AS a", "v"))
    assert kinds(rows, copy.repartition(5)) == sorted([
        (7, 1, 0, "missing"), (8, 1, 0, "missing"), (20, 1, 1, "changed"), (30, 1, 2, "repeated"),
        (None, 1, 2, "repeated"), (9999, 0, 1, "extra"), (50, 1, 2, "changed"),
    ], key=str)


def test_nulls_that_trade_places_are_seen(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "k int, a string, b string")
    other = rows.selectExpr("k", "b AS a", "a AS b")
    assert [r[0] for r in kinds(rows, other)] == [1, 2]


def test_equal_trees_end_at_the_root(spark):
    rows = base(spark)
    tree = hash_tree.hash_tree(rows, ["k"])
    other = hash_tree.hash_tree(rows.repartition(7).select("v", "k", "a"), ["k"])
    assert sorted(map(tuple, tree.collect())) == sorted(map(tuple, other.collect()))
    assert hash_tree.unequal_buckets(tree, other).count() == 0


def test_only_unequal_buckets_are_read_again(spark):
    rows = base(spark)
    copy = rows.selectExpr("k", "IF(k = 77, 'changed', a) AS a", "v")
    trees = [hash_tree.hash_tree(side, ["k"], 3) for side in (rows, copy)]
    assert hash_tree.unequal_buckets(*trees, 3).count() == 1
    assert kinds(rows, copy, depth=3, left_tree=trees[0], right_tree=trees[1]) == [(77, 1, 1, "changed")]


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_any_depth_and_empty_tables(spark, depth):
    rows = base(spark, 40)
    assert kinds(rows, rows.limit(0), depth=depth) == sorted(
        ((r["k"], 1, 0, "missing") for r in rows.collect()), key=str)
    assert kinds(rows.limit(0), rows.limit(0), depth=depth) == []
    with pytest.raises(ValueError):
        kinds(rows, rows.drop("v"))
