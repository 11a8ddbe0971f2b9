from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, DoubleType, LongType, StringType, StructField, StructType

from trilayer.llm import top_k

VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())),
                      StructField("score", StringType())])


def brute_force(rows, every=50, k=5):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q, v in whole:
        if q is None or q % every:
            continue
        scored = sorted(
            ((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for i, w in whole
             if i != q and len(w) == len(v)))
        found += [(q, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(scored[:k], 1)]
    return sorted(found, key=str)


def answers(found):
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "?") for i, v in rows], VECTORS)


@pytest.mark.parametrize("query_bytes", [top_k.QUERY_BYTES, 2000])
def test_equals_brute_force(spark, monkeypatch, query_bytes):
    """Clusters, small blocks, several broadcasts of queries, equal scores."""
    monkeypatch.setattr(top_k, "BLOCK", 64)
    monkeypatch.setattr(top_k, "TOGETHER", 3)
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 0.3, (5, 12))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.1, 12)).round(2).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]
    found = top_k.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, query_bytes=query_bytes)
    assert answers(found) == brute_force(rows)


def test_bounds_leave_no_contender_out():
    rng = np.random.default_rng(3)
    values = rng.integers(-90, 90, (300, 16))
    queries = rng.integers(-90, 90, (40, 16))
    own = np.zeros((40, 300), bool)
    own[np.arange(40), np.arange(40)] = True
    query, candidate = top_k.contenders(
        queries.astype(float), top_k.Lists(values), own, np.full(40, -np.inf), 5)
    kept = np.zeros((40, 300), bool)
    kept[query, candidate] = True
    scores = np.where(own, -10**9, queries @ values.T)
    fifth = np.sort(scores, axis=1)[:, -5]
    assert kept[scores >= fifth[:, None]].all()
    assert not kept[own].any()
    assert kept.sum() < 40 * 300 // 3


def test_nulls_widths_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (50, [0.5, -0.25]), (50, [-0.1, 0.3]), (1, [nan, 1.0]), (2, [inf, 1.0]),
            (3, None), (4, [None, 1.0]), (None, [0.5, 0.5]), (5, [1.0, 1.0, 1.0]), (100, [1.0, 2.0, 3.0]),
            (150, []), (6, []), (7, [0.5, -0.25]), (7, [0.5, -0.25]), (200, [0.1] * 4), (250, None),
            (300, [-inf])]
    found = top_k.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert answers(found) == brute_force(rows)
    assert top_k.top_k(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    few = top_k.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, k=2)
    assert answers(few) == brute_force(rows, k=2)


def test_scores_beyond_64_bits_end_the_job(spark):
    rows = [(0, [1e8]), (1, [1e9])]
    assert answers(top_k.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0))[0][3] == 65536 * 10**17
    with pytest.raises(Exception, match="beyond 64 bits"):
        top_k.top_k(frame(spark, [(0, [1e12]), (1, [1e12])]), F.col("vec_id") % 50 == 0).collect()


def test_floats_are_scaled_as_doubles(spark):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))])
    rows = [(0, [0.1, 0.7, -0.3]), (1, [0.30000001, 0.9, 0.2])]
    docs = spark.createDataFrame(rows, schema)
    as_double = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert answers(top_k.top_k(docs, F.col("vec_id") % 50 == 0)) == brute_force(as_double)
