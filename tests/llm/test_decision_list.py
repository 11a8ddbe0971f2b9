from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trilayer.llm import decision_list as dl
from trilayer.llm.queries import op2_quality_rules
from trilayer.plans.facts import plan_facts

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, rule string, n_words string"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1
               for k in range(3)}
    base = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), base)


def measured(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS)
    found = dl.statistics(docs).select("doc_id", *dl.COUNTS, "base_failed").collect()
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: r["doc_id"])]


def test_statistics_of_odd_texts(spark):
    texts = [None, "", " \n ", "a", "a b", "a b c a b c", "x x x x x", "a b c\n\na b c\n a b c",
             "# ## a|b <i>", "é漢\x0b字  x", "w " * 30_000, "p q r " * 20 + "end",
             " ".join(map(str, range(3000))), "a\tb\x0cc\r\nd"]
    assert measured(spark, texts) == [counts(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab \n#", max_size=40), min_size=1, max_size=40))
def test_statistics_of_any_text(spark, texts):
    assert measured(spark, texts) == [counts(t) for t in texts]


def rows_with_rules(spark, n=900):
    """Bad rows are those with a > 0.7, or with b < 2 and c >= 5."""
    bad = "a > 0.7 OR (b < 2 AND c >= 5)"
    return spark.sql(f"""
        SELECT doc_id, a, b, c, NOT ({bad}) AS good FROM (
          SELECT id AS doc_id, pmod(xxhash64(id, 1), 1000) / 1000 AS a,
                 pmod(xxhash64(id, 2), 10) AS b, pmod(xxhash64(id, 3), 10) AS c
          FROM range({n}))""")


def test_rules_are_found_again(spark):
    rows = rows_with_rules(spark)
    rules = dl.learn(rows, ["a", "b", "c"])
    assert 2 <= len(rules) <= dl.MAX_RULES
    text = dl.describe(rules)
    assert any(t.startswith("a >= 0.7") or t.startswith("a >= 0.6") for t in text)
    judged = rows.withColumn("hit", dl.verdict(rules) > 0)
    wrong = judged.filter("hit = good").count()
    assert wrong <= 0.03 * 900
    for rule in rules:  # in order, each covers something the others leave
        assert 1 <= len(rule) <= dl.MAX_CONDITIONS
    first = judged.withColumn("n", dl.verdict(rules)).groupBy("n").count().collect()
    assert {r["n"] for r in first} == set(range(len(rules) + 1))


def test_ordered_conditional_expression(spark):
    rules = [(dl.Condition("a", True, 5.0, 1), dl.Condition("b", False, 2.0, 1)),
             (dl.Condition("a", True, 1.0, 1),)]
    rows = spark.createDataFrame([(6.0, 1.0), (6.0, 2.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in rows.select(dl.verdict(rules)).collect()] == [1, 2, 0, 0]
    assert dl.describe(rules) == ["a >= 5 AND b < 2", "a >= 1"]


def test_input_columns_named_like_its_own(spark):
    docs = spark.createDataFrame([(1, "a b c a b c", 7, 8, 9)],
                                 ["doc_id", "dl_text", "dl_words", "DL_pairs", "n_words"])
    found = dl.statistics(docs, "dl_text").first()
    assert tuple(found[c] for c in dl.COUNTS) == counts("a b c a b c")[:5]
    assert (found["dl_text"], found["dl_words"], found["DL_pairs"]) == ("a b c a b c", 7, 8)


@pytest.mark.parametrize("label", [True, False])
def test_nothing_to_tell_apart(spark, label):
    rows = rows_with_rules(spark, 60).withColumn("good", F.lit(label))
    assert dl.learn(rows, ["a", "b", "c"]) == []
    assert dl.learn(rows.limit(0), ["a", "b", "c"]) == []
    noise = rows.withColumn("good", F.xxhash64("doc_id", F.lit(8)) % 2 == 0)
    assert all(len(r) for r in dl.learn(noise, ["a"]))


def test_labels_with_nulls_repeats_and_a_bound(spark):
    docs = spark.createDataFrame([(i, "t", "", "") for i in (1, 2, 3, 3, None)], DOCS)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (3, 0), (None, 1), (9, 1)], "doc_id long, quality int")
    found = dl.labelled_rows(docs, labels).collect()
    assert sorted((r["doc_id"], r["good"]) for r in found) == [(1, True), (3, False), (3, False)]
    assert dl.labelled_rows(docs, labels, sample=0).count() == 0


def test_whole_table(spark):
    found = op2_quality_rules(spark, DATA)
    nodes = plan_facts(found).nodes
    assert not any("Python" in n or "Arrow" in n or "Pandas" in n for n in nodes)
    rows = {r["doc_id"]: r for r in found.collect()}
    texts = duckdb.connect().execute(
        f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        r = rows[doc_id]
        assert tuple(r[c] for c in (*dl.COUNTS, "base_failed")) == counts(text)
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    open_rows = [r for r in labels if not rows[r["doc_id"]]["base_failed"]]
    good = [r for r in open_rows if r["quality"] == 1]
    bad = [r for r in open_rows if r["quality"] == 0]
    assert sum(rows[r["doc_id"]]["kept"] for r in good) > 0.97 * len(good)
    assert sum(not rows[r["doc_id"]]["kept"] for r in bad) > 0.8 * len(bad)
