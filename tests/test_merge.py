from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trilayer.operators import joins, merge
from trilayer.operators.merge import (
    DuplicateKeys,
    merge_actions,
    merge_metrics,
    merge_upsert,
    when_matched_delete,
    when_matched_update,
    when_not_matched_insert,
    write_merge,
)
from trilayer.plans.facts import plan_facts
from trilayer.sources.raw import table

TARGET = "a int, b int, v double, note string"
SOURCE = "a int, b int, v double, kind string"
KEY = ["a", "b"]
UPDATE = when_matched_update({"v": "s.v", "note": "'changed'"}, "s.kind = 'UPDATE'")
DELETE = when_matched_delete("s.kind = 'DELETE'")
INSERT = when_not_matched_insert({"a": "s.a", "b": "s.b", "v": "s.v"}, "s.kind = 'INSERT'")


def frames(spark, target, source):
    return spark.createDataFrame(target, TARGET), spark.createDataFrame(source, SOURCE)


@pytest.fixture(params=["broadcast", "shuffle"])
def join_way(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(merge, "within_limits", lambda rows, size: False)
    return request.param


def test_clauses(spark, join_way):
    target, source = frames(
        spark,
        [(1, 1, 1.0, "x"), (1, 2, 2.0, "x"), (2, 1, 3.0, "x"), (None, 1, 4.0, "x"), (3, 3, 5.0, "x")],
        [
            (1, 1, 10.0, "UPDATE"),
            (1, 2, 20.0, "DELETE"),
            (2, 1, 30.0, "INSERT"),  # matched, but no clause: stays
            (9, 9, 90.0, "UPDATE"),  # not matched, no clause: ignored
            (8, 8, 80.0, "INSERT"),
            (None, 1, 40.0, "INSERT"),  # null keys never match
        ],
    )
    actions = merge_actions(target, source, KEY, [UPDATE, DELETE, INSERT])
    assert rows(actions.filter("merge_action <> 'delete'").drop("merge_action")) == rows(
        spark.createDataFrame(
            [
                (1, 1, 10.0, "changed"),
                (2, 1, 3.0, "x"),
                (None, 1, 4.0, "x"),
                (3, 3, 5.0, "x"),
                (8, 8, 80.0, None),
                (None, 1, 40.0, None),
            ],
            TARGET,
        )
    )
    assert tuple(merge_metrics(actions).first()) == (4, 1, 1, 2)


def test_first_true_clause_wins(spark, join_way):
    target, source = frames(spark, [(1, 1, 1.0, "x")], [(1, 1, 10.0, "UPDATE")])
    first = when_matched_update({"note": "'first'"}, "t.v < 5")
    second = when_matched_delete()
    assert rows(merge_upsert(target, source, KEY, [first, second])) == [(1, 1, 1.0, "first")]
    unknown = when_matched_update({"note": "'first'"}, "cast(null as boolean)")
    assert rows(merge_upsert(target, source, KEY, [unknown, second])) == []


def test_one_source_row_can_change_many_target_rows(spark, join_way):
    # A third of the target and more has one key.
    target, source = frames(
        spark,
        [(1, 1, float(n), "x") for n in range(40)] + [(2, 2, 0.0, "x")],
        [(1, 1, 7.0, "UPDATE"), (3, 3, 1.0, "INSERT")],
    )
    merged = merge_upsert(target, source, KEY, [UPDATE, INSERT])
    assert merged.filter("note = 'changed'").count() == 40
    assert merged.count() == 42


def test_duplicate_source_keys(spark, join_way):
    target, source = frames(
        spark,
        [(1, 1, 1.0, "x")],
        [(1, 1, 10.0, "UPDATE"), (1, 1, 20.0, "UPDATE"), (2, 2, 1.0, "other"), (2, 2, 2.0, "other")],
    )
    with pytest.raises(DuplicateKeys):
        merge_upsert(target, source, KEY, [UPDATE])
    merged = merge_upsert(target, source, KEY, [UPDATE], dedupe_by=["v"])
    assert rows(merged) == [(1, 1, 20.0, "changed")]
    # Rows that no clause acts on may repeat.
    assert merge_upsert(target, source.filter("a = 2"), KEY, [UPDATE]).count() == 1


def test_repeated_keys_without_conflict(spark, join_way):
    target, source = frames(
        spark,
        [(1, 1, 1.0, "x"), (1, 1, 1.0, "x"), (2, 2, 2.0, "x")],
        [
            (1, 1, 10.0, "UPDATE"),
            (1, 1, 20.0, "INSERT"),  # matched, so not inserted
            (5, 5, 50.0, "INSERT"),
            (5, 5, 60.0, "INSERT"),  # both are new rows
            (7, 7, 70.0, "UPDATE"),
            (7, 7, 71.0, "UPDATE"),  # match nothing
            (None, 1, 0.0, "UPDATE"),
            (None, 1, 0.0, "UPDATE"),
        ],
    )
    merged = merge_upsert(target, source, KEY, [UPDATE, INSERT])
    assert rows(merged) == rows(spark.createDataFrame(
        [(1, 1, 10.0, "changed"), (1, 1, 10.0, "changed"), (2, 2, 2.0, "x"),
         (5, 5, 50.0, None), (5, 5, 60.0, None)], TARGET))


def test_conditions_on_the_target_decide_between_repeated_keys(spark, join_way):
    target, source = frames(
        spark,
        [(1, 1, 1.0, "x"), (1, 1, 9.0, "x")],
        [(1, 1, 2.0, "UPDATE"), (1, 1, 8.0, "UPDATE")],
    )
    near = when_matched_update({"v": "s.v"}, "abs(s.v - t.v) < 2")
    assert rows(merge_upsert(target, source, KEY, [near])) == [(1, 1, 2.0, "x"), (1, 1, 8.0, "x")]
    wide = when_matched_update({"v": "s.v"}, "abs(s.v - t.v) < 100")
    with pytest.raises(DuplicateKeys):
        merge_upsert(target, source, KEY, [wide])


def test_the_latest_of_each_side_is_taken(spark, join_way):
    target, source = frames(
        spark,
        [(1, 1, 1.0, "x")],
        [(1, 1, 2.0, "UPDATE"), (1, 1, 3.0, "UPDATE"), (1, 1, 9.0, "INSERT"),
         (2, 2, 1.0, "INSERT"), (2, 2, 5.0, "INSERT"), (2, 2, 7.0, "UPDATE")],
    )
    merged = merge_upsert(target, source, KEY, [UPDATE, INSERT], dedupe_by=["v"])
    assert rows(merged) == [(1, 1, 3.0, "changed"), (2, 2, 5.0, None)]


def test_lineitem_key_is_not_unique(spark):
    lines = table(spark, "/root/testdata/sf0.001", "lineitem")
    with pytest.raises(DuplicateKeys):
        merge_upsert(lines, lines, ["l_orderkey", "l_linenumber"], [when_matched_delete()])


def test_empty_sides(spark, join_way):
    target, source = frames(spark, [(1, 1, 1.0, "x")], [(2, 2, 2.0, "INSERT")])
    assert rows(merge_upsert(target, source.limit(0), KEY, [UPDATE, INSERT])) == [(1, 1, 1.0, "x")]
    assert rows(merge_upsert(target.limit(0), source, KEY, [UPDATE, INSERT])) == [
        (2, 2, 2.0, None)
    ]


def test_insert_by_name_leaves_other_columns_null(spark):
    target, source = frames(spark, [], [(2, 2, 2.0, "INSERT")])
    merged = merge_upsert(target, source, KEY, [when_not_matched_insert()])
    assert rows(merged) == [(2, 2, 2.0, None)]
    assert merged.columns == target.columns


def test_small_source_does_not_shuffle_the_target(spark, folder):
    target, source = frames(spark, [(n, 1, 1.0, "x") for n in range(50)], [(1, 1, 9.0, "UPDATE")])
    target.write.parquet(f"{folder}/t")
    source.write.parquet(f"{folder}/s")
    read = spark.read.parquet
    facts = plan_facts(merge_upsert(read(f"{folder}/t"), read(f"{folder}/s"), KEY, [UPDATE]))
    assert facts.has("BroadcastHashJoin")
    assert not facts.has("Exchange")


def test_written_merge_reports_its_metrics(spark, folder):
    target, source = frames(
        spark,
        [(1, 1, 1.0, "x"), (1, 2, 1.0, "x")],
        [(1, 1, 5.0, "UPDATE"), (1, 2, 0.0, "DELETE"), (4, 4, 4.0, "INSERT")],
    )
    actions = merge_actions(target, source, KEY, [UPDATE, DELETE, INSERT])
    assert write_merge(actions, f"{folder}/merged") == {
        "num_affected_rows": 3,
        "num_updated_rows": 1,
        "num_deleted_rows": 1,
        "num_inserted_rows": 1,
    }
    assert spark.read.parquet(f"{folder}/merged").count() == 2


def test_limits():
    assert joins.within_limits(10, 10)
    assert not joins.within_limits(joins.MAX_ROWS + 1, 0)
    assert not joins.within_limits(1, joins.MAX_BYTES + 1)


keys = st.tuples(st.sampled_from([1, 2, 3]), st.sampled_from([1, 2, None]))


@settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(st.tuples(keys, st.integers(0, 5)), max_size=8),
    st.dictionaries(keys, st.tuples(st.integers(0, 5), st.sampled_from(["UPDATE", "INSERT"])), max_size=6),
)
def test_merging_twice_changes_nothing_more(spark, target, source):
    t, s = frames(
        spark,
        [(a, b, float(v), "x") for (a, b), v in target],
        [(a, b, float(v), kind) for (a, b), (v, kind) in source.items() if b is not None],
    )
    once = merge_upsert(t, s, KEY, [UPDATE, INSERT])
    kept = spark.createDataFrame(once.collect(), TARGET)
    twice = merge_upsert(kept, s, KEY, [UPDATE, INSERT])
    changed = {(a, b) for (a, b), (_, kind) in source.items() if kind == "INSERT"}
    same = [row for row in rows(once) if (row[0], row[1]) not in changed]
    assert [row for row in rows(twice) if (row[0], row[1]) not in changed] == same
    assert len(rows(twice)) == len(rows(once))


def test_keys_that_shrink_are_dealt_out_by_number(spark, folder, monkeypatch):
    target, source = f"{folder}/t", f"{folder}/s"
    spark.range(5000).select(F.col("id").alias("a"), F.lit(1.0).alias("v")).write.parquet(target)
    changes = spark.range(4000, 9000).select(F.col("id").alias("a"), F.lit(2.0).alias("v"))
    changes.unionByName(spark.sql("SELECT CAST(null AS BIGINT) a, 3.0D v")).write.parquet(source)
    monkeypatch.setattr("trilayer.operators.merge.within_limits", lambda *measured: False)
    merged = merge_upsert(
        spark.read.parquet(target), spark.read.parquet(source), ["a"],
        [when_matched_update({"v": "s.v"}), when_not_matched_insert()],
    )
    assert "min(xxhash64(a" in plan_facts(merged).text
    assert rows(merged.groupBy("v").count()) == [(1.0, 4000), (2.0, 5000), (3.0, 1)]
