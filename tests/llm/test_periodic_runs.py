from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trilayer.llm import periodic_runs
from trilayer.llm.queries import op13_periodic_runs
from trilayer.llm.words import words

DATA = "/root/testdata/sf0.001"
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("runs", LongType())])


def brute_force(seq, min_length=6, min_exponent=4):
    """Runs by comparing every word with the one a period later, for every period."""
    n, found = len(seq), set()
    for p in range(1, n // min_exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and seq[j] == seq[j + p]:
                j += 1
            length = j + p - i
            if length >= max(min_length, min_exponent * p):
                part = seq[i : i + length]
                shorter = (q for q in range(1, p) if part[q:] == part[:-q])
                if next(shorter, None) is None:
                    found.add((i, length, p))
            i = max(j, i + 1)
    return sorted(found)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapse(seq, runs):
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(seq) if i not in gone)


def test_trees_find_every_run():
    random.seed(13)
    for _ in range(600):
        seq = [random.randint(1, random.choice([1, 2, 3])) for _ in range(random.randint(0, 50))]
        block = [random.randint(1, 4) for _ in range(random.randint(1, 12))]
        seq[len(seq) // 3 : len(seq) // 3] = (block * 8)[: random.randint(0, 80)]
        for limits in ((6, 4), (2, 2)):
            found = periodic_runs.tree_runs(np.array(seq, np.uint64), *limits)
            assert [tuple(r) for r in found.tolist()] == brute_force(seq, *limits)


def test_extensions_are_common_prefixes():
    random.seed(5)
    seq = [random.randint(1, 2) for _ in range(200)]
    extensions = periodic_runs.Extensions(*periodic_runs.SuffixTree(seq).tour())
    for _ in range(500):
        i, j = random.sample(range(201), 2)
        same = next((k for k in range(201) if i + k >= 200 or j + k >= 200 or seq[i + k] != seq[j + k]), 0)
        assert extensions.common(np.array([i]), np.array([j]))[0] == same


def test_stretches_leave_no_run_out():
    """Texts next to each other, with periods of all lengths, at their ends too."""
    random.seed(8)
    texts = ["", "a " * 30, "a " * 30]
    for _ in range(400):
        seq = [f"w{random.randint(1, random.choice([2, 5, 60]))}" for _ in range(random.randint(0, 200))]
        block = [f"x{random.randint(1, 40)}" for _ in range(random.randint(1, 60))]
        at = random.choice([0, len(seq) // 2, len(seq)])
        seq[at:at] = (block * 9)[: random.randint(0, 400)]
        texts.append(random.choice([" ", "\n\t"]).join(seq))
    import pyarrow as pa

    found = words(pa.array(texts), fold=False)
    runs = periodic_runs.word_runs(found)
    owner = np.searchsorted(found.first, runs[:, 0], "right") - 1
    got = {i: [] for i in range(len(texts))}
    for (start, length, p), i in zip(runs.tolist(), owner.tolist()):
        got[i].append((start - int(found.first[i]), length, p))
    for i, text in enumerate(texts):
        assert got[i] == brute_force(split(text)), text
    assert sum(map(len, got.values())) > 100
    for i, text in enumerate(periodic_runs.collapsed(found, runs).to_pylist()):
        assert text == collapse(split(texts[i]), got[i])


def expected(doc_id, text):
    seq = split(text)
    n = len(seq)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            seq = seq[:a] + [seq[a + (i - a) % p] for i in range(a, n)]
    runs = brute_force(seq)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(collapse(seq, runs).encode()).hexdigest(),
    )


def test_whole_table_equals_brute_force(spark):
    found = op13_periodic_runs(spark, DATA)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                             "runs_sha256", "collapsed_sha256"]
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    found = sorted(tuple(r) for r in found.collect())
    assert found == sorted(expected(*r) for r in rows)
    assert sum(r[1] > 0 for r in found) > 10


def test_nulls_long_texts_and_repeats(spark, folder):
    long = "spam " * 60_000 + "and " + " ".join(f"w{i % 700}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b " * 9), (None, "a b " * 9), (4, "É é " * 7),
            (4, "x " * 5), (4, "x " * 6), (5, long)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], DOCS)
    found = periodic_runs.find_runs(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = {}
    for doc_id, n, runs, text in found.collect():
        got.setdefault(doc_id, []).append((n, [tuple(r) for r in runs], text))
    assert got[1] == got[2] == got[3] == [(0, [], "")]
    assert got[None] == [(18, [(0, 18, 2)], "a b")] * 2
    assert sorted(got[4]) == [(5, [], "x x x x x"), (6, [(0, 6, 1)], "x"), (14, [(0, 14, 2)], "É é")]
    (n, runs, text), = got[5]
    assert n == 63_001 and runs == [(0, 60_000, 1), (60_001, 3000, 700)]
    assert text == "spam and " + " ".join(f"w{i}" for i in range(700))
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, min_exponent=1)
    # the query on a table of such rows
    docs.write.parquet(f"{folder}/documents.parquet")
    found = sorted((tuple(r) for r in op13_periodic_runs(spark, folder).collect()), key=str)
    assert [r for r in found if r[0] != 5] == sorted((expected(*r) for r in rows[:-1]), key=str)
