from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trilayer.operators.anonymity import mondrian


def people(spark, rows):
    return spark.range(rows).selectExpr(
        "id", "IF(id % 31 = 0, NULL, int(pmod(hash(id), 60))) AS age",
        "CASE WHEN id % 17 = 0 THEN double('NaN') ELSE double(pmod(hash(id, 1), 1000)) END AS income",
        "date_add(date'2024-01-01', int(id % 90)) AS joined",
    )


@pytest.mark.parametrize("k", [2, 7, 40])
def test_groups_are_large_enough_and_ranges_hold(spark, k):
    df, columns = people(spark, 900), ["age", "income", "joined"]
    found = mondrian(df, columns, k).collect()
    assert sorted(r["id"] for r in found) == list(range(900))
    groups = {}
    for r in found:
        groups.setdefault(r["group"], []).append(r)
    assert all(len(g) >= k for g in groups.values())
    assert len(groups) > 900 / (4 * k)
    for group in groups.values():
        for c in columns:
            assert len({(r[f"{c}_from"], r[f"{c}_to"]) for r in group}) == 1
            values = [r[c] for r in group if r[c] is not None and r[c] == r[c]]
            low, high = group[0][f"{c}_from"], group[0][f"{c}_to"]
            assert low == (min(values) if len(values) == len(group) else None)
            assert high == (max(values) if values else None)


def test_too_few_rows_and_none(spark):
    found = mondrian(people(spark, 5), ["age", "income"], 6).collect()
    assert len(found) == 5 and {r["age_from"] for r in found} == {r["income_to"] for r in found} == {None}
    assert mondrian(people(spark, 0), ["age"], 3).count() == 0


def test_values_that_cannot_be_told_apart_stay_together(spark):
    df = spark.range(500).select(F.lit(3).alias("age"), F.when(F.col("id") < 3, 1).otherwise(2).alias("b"))
    found = mondrian(df, ["age", "b"], 5)
    assert found.select("group").distinct().count() == 1
    assert found.first()[3:] == (3, 3, 1, 2)
    df = spark.range(500).select((F.col("id") % 2).alias("b"))
    assert mondrian(df, ["b"], 250).select("group", "b_from", "b_to").distinct().count() == 2
