from __future__ import annotations

import pytest
from conftest import rows

from trilayer.operators.declared import RULES, STRICT_RULES, declared_silver, shape_silver
from trilayer.operators.quality import (
    Rule,
    RuleViolation,
    apply_rules,
    check_rules,
    rule_metrics,
)
from trilayer.operators.reconcile import copy_verified, reconcile
from trilayer.sources.trips import raw_trips

DATA = "/root/testdata/sf0.001"
POSITIVE = "v > 0"


def values(spark):
    return spark.createDataFrame([(1,), (-1,), (None,), (5,)], "v int")


def test_warn_keeps_rows_and_counts_them(spark):
    rule = Rule("positive", POSITIVE, "warn")
    assert apply_rules(values(spark), [rule]).count() == 4
    assert rows(rule_metrics(values(spark), [rule])) == [("positive", "warn", 2, 2)]


def test_drop_removes_violations_and_unknowns(spark):
    assert rows(apply_rules(values(spark), [Rule("positive", POSITIVE, "drop")])) == [(1,), (5,)]


def test_fail_stops_the_job_or_changes_nothing(spark):
    rule = Rule("positive", POSITIVE, "fail")
    with pytest.raises(Exception, match="rule positive failed"):
        apply_rules(values(spark), [rule]).collect()
    good = values(spark).filter(POSITIVE)
    assert apply_rules(good, [rule]).count() == 2
    check_rules(good, [rule])
    with pytest.raises(RuleViolation, match="positive: 2 rows"):
        check_rules(values(spark), [rule])


def test_fail_rules_see_rows_that_drop_rules_remove(spark):
    rules = [Rule("drop_null", "v is not null", "drop"), Rule("known", "v is not null", "fail")]
    with pytest.raises(Exception, match="rule known failed"):
        apply_rules(values(spark), rules).collect()


def test_later_filters_do_not_hide_rows_from_fail_rules(spark, folder):
    values(spark).write.parquet(folder)
    checked = apply_rules(spark.read.parquet(folder), [Rule("known", "v is not null", "fail")])
    with pytest.raises(Exception, match="rule known failed"):
        checked.filter("v > 3").collect()


def test_metrics_of_several_rules_and_of_no_rows(spark):
    rules = [Rule("positive", POSITIVE), Rule("small", "v < 3", "drop")]
    assert rows(rule_metrics(values(spark), rules)) == [
        ("positive", "warn", 2, 2),
        ("small", "drop", 2, 2),
    ]
    assert rows(rule_metrics(values(spark).limit(0), rules)) == [
        ("positive", "warn", 0, 0),
        ("small", "drop", 0, 0),
    ]


def test_declared_silver_under_both_rule_sets(spark):
    trips = raw_trips(spark, DATA)
    metrics = {row["rule"]: row["failed"] for row in rule_metrics(shape_silver(trips), RULES).collect()}
    assert metrics["valid_trip_distance"] == 10
    kept = declared_silver(trips)
    assert kept.filter("trip_distance < 0").count() == 0
    assert kept.filter("trip_duration_minutes >= 1440").count() > 0
    # Trips longer than a day are there, so the stricter set stops the update.
    with pytest.raises(Exception, match="plausible_duration"):
        declared_silver(trips, STRICT_RULES).collect()


def test_reconcile_sees_counts_contents_and_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    verdict = reconcile(left, left.repartition(3).select("v", "k")).first()
    assert tuple(verdict) == (3, 3, True, True)
    other = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert tuple(reconcile(left, other).first()) == (3, 3, True, False)
    assert tuple(reconcile(left, left.limit(0)).first()) == (3, 0, False, False)
    assert tuple(reconcile(left.limit(0), left.limit(0)).first()) == (0, 0, True, True)
    with pytest.raises(ValueError):
        reconcile(left, left.drop("v"))


def test_verified_copy_is_independent(spark, folder):
    source = spark.range(10)
    copy = copy_verified(source, f"{folder}/copy")
    assert rows(copy) == rows(source)
