from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trilayer.llm import decontaminate as module
from trilayer.llm.decontaminate import decontaminate

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("items", StringType())])
ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])
LONG = " ".join(f"w{i}" for i in range(30))


def parts(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_force(docs, items):
    out = []
    for doc_id, text in docs:
        have, hit, found = parts(text), set(), set()
        for item_id, item in items:
            want = parts(item)
            n = min(10, len(want))
            wins = {tuple(want[i : i + n]) for i in range(len(want) - n + 1)} if n else ()
            for i in range(len(have) - n + 1):
                if n and tuple(have[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    found.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(have), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


CASES = [
    (1, LONG), (2, "lead, " + LONG.upper() + "! tail"), (3, LONG.replace("w7", "x")),
    (4, None), (5, ""), (6, "short item"), (7, "a SHORT, item here short item"), (8, "solo"),
    (8, "solo"), (None, "w20 w21 w22 w23 w24 w25 w26 w27 w28 w29 w20"), (9, "ÉCOLE été2 x"),
    (10, "rep rep rep rep rep rep rep rep rep rep rep rep"), (11, LONG + " " + LONG),
]
WANTED = [(1, LONG), (2, "Short item"), (3, "solo"), (4, None), (5, ""), (None, LONG),
          (6, "été2 x"), (7, " ".join(["rep"] * 11)), (1, LONG), (12, "solo"),
          (13, " ".join(f"w{i}" for i in range(12)) + " other words")]


@pytest.mark.parametrize("few_bits", [False, True])
@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, few_bits, small):
    if few_bits:  # nearly every shingle passes such a filter
        monkeypatch.setattr(module, "MAX_BITS", 64)
        monkeypatch.setattr(module, "SEGMENT_BITS", 64)
    if not small:
        monkeypatch.setattr(module, "broadcast_if_small", lambda df: df)
    docs = spark.createDataFrame([(*r, "x") for r in CASES], DOCS)
    items = spark.createDataFrame(WANTED, ITEMS)
    found = decontaminate(docs, items)
    assert found.columns[:6] == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                                 "contaminated"]
    rows = found.collect()
    assert sorted((tuple(r)[:6] for r in rows), key=str) == brute_force(CASES, WANTED)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["items"] == ["2"]
    assert np.frombuffer(by_id[7]["hit_words"], np.int64).tolist() == [1, 2, 4, 5]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(*r, "x") for r in CASES], DOCS)
    items = spark.createDataFrame(WANTED, ITEMS)
    assert decontaminate(docs.limit(0), items).count() == 0
    clean = decontaminate(docs, items.limit(0)).collect()
    assert len(clean) == len(CASES) and not any(r["contaminated"] for r in clean)


def test_one_pass_whatever_the_benchmark(spark):
    """Fifteen times the windows make no more jobs, and so no more reads of the documents."""
    draw = np.random.Generator(np.random.PCG64(3))
    items = [(i, " ".join(f"v{k}" for k in draw.integers(0, 40, 200))) for i in range(30)]
    docs = [(i, " ".join(f"v{k}" for k in draw.integers(0, 40, 100))) for i in range(20)]
    docs += [(100 + i, f"a b {' '.join(items[i][1].split()[50:61])} c") for i in range(10)]
    jobs = spark.sparkContext.statusTracker()
    counts = []
    for some in (items[:2], items):
        spark.sparkContext.setJobGroup(f"bench-{len(some)}", "decontaminate")
        found = decontaminate(spark.createDataFrame([(*d, "x") for d in docs], DOCS),
                              spark.createDataFrame(some, ITEMS)).collect()
        counts.append(len(jobs.getJobIdsForGroup(f"bench-{len(some)}")))
        assert sorted((tuple(r)[:6] for r in found), key=str) == brute_force(docs, some)
    assert counts[0] == counts[1]


def test_filter_holds_its_values(spark):
    draw = np.random.Generator(np.random.PCG64(9))
    values = draw.integers(-1 << 63, 1 << 63, 5000)
    table = spark.createDataFrame([(int(v),) for v in values], "shingle long")
    shared = module.filter_of(table, [3]).value
    assert len(shared.passing(values.view(np.uint64))) == 5000
    other = draw.integers(-1 << 63, 1 << 63, 100000).view(np.uint64)
    assert len(shared.passing(other)) < 100
