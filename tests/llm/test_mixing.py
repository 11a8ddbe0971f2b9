from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from trilayer.llm.mixing import mix, targets
from trilayer.llm.oracles import OP10
from trilayer.llm.queries import op10_mixing
from trilayer.plans.facts import plan_facts

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, text string, taken long, mix_key string"


def shares(sizes, weights, share, most):
    """Deal by weight; fix what is above its limit; deal the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        left = sum(weight[s] for s in names if s not in full)
        got = {s: most * sizes[s] if s in full else rest * weight[s] / left for s in names}
        above = {s for s in names if s not in full and got[s] > most * sizes[s]}
        if not above:
            return got
        full |= above


def brute_force(rows):
    docs = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, s, t in rows]
    sizes = defaultdict(int)
    for _, s, n in docs:
        sizes[s] += n
    wanted, out = shares(sizes, (5, 2, 1), 1.5, 2), []
    for source, target in wanted.items():
        own = [d for d in docs if d[1] == source]

        def key(d):
            name = "" if d[0] is None else str(d[0])
            return hashlib.md5(f"mix-1:{name}".encode()).hexdigest(), name, d[2]

        own.sort(key=key)
        passes = math.floor(target) // sizes[source] if sizes[source] else 0
        left = math.floor(target) - passes * sizes[source]
        i = 0
        while i < len(own):
            same = [d for d in own if key(d) == key(own[i])]
            gives = min(own[i][2], left // len(same))
            left = left - len(same) * own[i][2] if gives == own[i][2] else 0
            out += [(d[0], d[2], sizes[source], target, passes * d[2] + gives) for d in same]
            i += len(same)
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], DOCS)
    found = mix(docs)
    got = sorted(
        (tuple(r) for r in found.select("doc_id", "size", "source_size", "target", "taken").collect()),
        key=str)
    want = brute_force(rows)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    return found


def test_sources_of_all_sizes(spark):
    rows = [(i, f"s{i % 7}" if i % 3 else "hot", "w " * (i * i % 23)) for i in range(300)]
    found = check(spark, rows)
    taken = found.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in taken:
        assert 0 <= r["max(target)"] - r["sum(taken)"] < 1
    assert found.filter("taken > 2 * size").count() == 0


def test_nulls_repeats_and_empty_texts(spark):
    rows = [(1, "a", "x y z"), (1, "a", "x y z"), (1, "a", "x y z"), (2, None, None), (3, None, "p q"),
            (None, "b", "k l m n"), (None, "b", "k l m n"), (4, "empty", ""), (5, "B", "one"),
            (6, "a", "long " * 4000), (7, "é", " \n"), (8, "é", "u v")]
    found = check(spark, rows)
    assert found.columns.count("taken") == 1 and "mix_key" in found.columns


def test_input_columns_named_like_its_own(spark):
    rows = [(i, f"s{i % 3}", "w " * (i % 9)) for i in range(60)]
    names = ["mix_source", "MIX_cut_key", "mix_passes", "input_mix_source", "mix_cut_gives"]
    docs = spark.createDataFrame([(*r, *range(5)) for r in rows],
                                 ["doc_id", "source", "text", *names])
    found = mix(docs).select("doc_id", "size", "source_size", "target", "taken", *names).collect()
    want = brute_force(rows)
    assert sorted(r[:3] + (r["taken"],) for r in found) == sorted(w[:3] + w[4:] for w in want)
    assert all(tuple(r[n] for n in names) == (0, 1, 2, 3, 4) for r in found)
    by_own = docs.select(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_from"), "text")
    own = mix(by_own, "mix_id", "mix_from").select("mix_id", "size", "source_size", "taken")
    assert sorted(map(tuple, own.collect())) == sorted(w[:3] + w[4:] for w in want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mix(docs).count() == 0
    only_empty = spark.createDataFrame([(1, "a", None, 0, ""), (2, "b", "", 0, "")], DOCS)
    assert [r["taken"] for r in mix(only_empty).collect()] == [0, 0]


def test_targets(spark):
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 0, None: 7},
                  {"only": 10}):
        rows = spark.createDataFrame(list(sizes.items()), "mix_source string, source_size long")
        got = {r["mix_source"]: r["target"] for r in targets(rows).collect()}
        assert got == pytest.approx(shares(sizes, (5, 2, 1), 1.5, 2))


def test_whole_table_equals_sql_again_and_again(spark):
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    cursor = engine.execute(OP10)
    names = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall(), key=str)
    for _ in range(2):
        found = op10_mixing(spark, DATA).select(names)
        assert sorted(map(tuple, found.collect()), key=str) == want
    assert not any("Python" in n or "Arrow" in n for n in plan_facts(found).nodes)
