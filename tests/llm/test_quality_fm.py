from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from trilayer.llm import quality_fm
from trilayer.llm.queries import op4_quality
from trilayer.llm.quality_fm import DENSE, HASH_BITS, FactorisationMachine, classify, features, learn

DATA = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, score string, label int"
LABELS = "doc_id long, quality int, toxic int, text string"


def machine():
    fm = FactorisationMachine(np.zeros(DENSE), np.ones(DENSE))
    draw = np.random.Generator(np.random.PCG64(9))
    fm.weights = draw.normal(0, 1, len(fm.weights)).astype(np.float32)
    fm.factors = draw.normal(0, 1, fm.factors.shape).astype(np.float32)
    fm.bias = 0.3
    return fm


def test_linear_time_score_equals_all_pairs():
    texts = pa.array(["a b c d a", "", None, "one\ntwo\ntwo THREE!!", "x"])
    fm = machine()
    hashed, first, dense = features(texts)
    margins = fm.margin(hashed, first, dense)
    for i in range(len(texts)):
        own = hashed[first[i] : first[i + 1]]
        x = np.concatenate([np.full(len(own), 1 / np.sqrt(max(1, len(own)))), fm.dense(dense)[i]])
        place = np.concatenate([own, np.arange(1 << HASH_BITS, (1 << HASH_BITS) + DENSE)]).astype(int)
        total = fm.bias + fm.weights[place] @ x
        for a in range(len(x)):
            for b in range(a):
                total += fm.factors[place[a]] @ fm.factors[place[b]] * x[a] * x[b]
        assert margins[i] == pytest.approx(total, rel=1e-3, abs=1e-3)


def test_features():
    hashed, first, dense = features(pa.array(["A b a", "x\ny\nx\n", None, "ab 12!#"]))
    assert np.diff(first).tolist() == [2, 2, 0, 2]
    assert (dense[2] == 0).all()
    assert dense[0][0] == pytest.approx(1 / 5)  # upper case
    assert dense[3][2] == pytest.approx(2 / 7)  # digits
    assert dense[1][7 + 6] == pytest.approx(1 / 3)  # repeated lines
    assert len(features(pa.array([], pa.string()))[2]) == 0


def test_interactions_alone_are_learned():
    """The label is the parity of two words, which no weight of one word can tell."""
    rows, labels = [], []
    for i in range(400):
        a, b = i % 2, i // 2 % 2
        rows.append(np.array([10 + a, 20 + b], np.uint32))
        labels.append(float(a ^ b))
    fm = FactorisationMachine(np.zeros(DENSE), np.ones(DENSE))
    labels, dense = np.array(labels, np.float32), np.zeros((400, DENSE))
    fm.fit(rows, dense, labels)
    first = np.arange(401) * 2
    margin = fm.margin(np.concatenate(rows).astype(np.int64), first, dense)
    assert ((margin > 0) == (labels > 0.5)).all()


def test_edges(spark):
    good = [(i, f"some plain words number {i} in a line", "en", "", 0) for i in range(40)]
    bad = [(100 + i, "BUY!! NOW!! " * 9, "en", "", 0) for i in range(40)]
    odd = [(500, None, None, "", 0), (501, "", "en", "", 0), (None, "plain words", "en", "", 0),
           (1, "plain words", "en", "", 0), (1, "plain words", "en", "", 0),
           (502, "word " * 50_000, "en", "", 0)]
    docs = spark.createDataFrame(good + bad + odd, DOCS)
    labels = spark.createDataFrame(
        [(i, int(i < 50), 0, "") for i in [*range(30), *range(100, 130)]]
        + [(2, None, 0, ""), (None, 1, 0, ""), (3, 1, 0, ""), (777, 1, 0, "")], LABELS)
    fm = learn(docs, labels)
    found = classify(docs, fm)
    assert found.columns == ["doc_id", "text", "lang", "label", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == 86 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["predicted"] == 1 for r in rows if r["doc_id"] in range(30, 40))
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] in range(130, 140))
    assert classify(docs.limit(0), fm).count() == 0
    assert learn(docs, labels.limit(0)) is None and learn(docs.limit(0), labels) is None
    assert {r["score"] for r in classify(docs, None).collect()} == {0.5}


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(FactorisationMachine, "fit", lambda self, rows, *a: seen.append(len(rows)))
    docs = spark.createDataFrame([(i, f"t {i}", "", "", 0) for i in range(50)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0, "") for i in range(50)], LABELS)
    learn(docs, labels, sample=20)
    assert seen == [20] and quality_fm.SAMPLE == 4000


def test_held_out_rows_of_the_whole_table(spark):
    rows = {r["doc_id"]: r for r in op4_quality(spark, DATA).collect()}
    assert len(rows) == 10_000
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(rows[r["doc_id"]]["held_out"] for r in held)
    right = sum(rows[r["doc_id"]]["predicted"] == r["quality"] for r in held)
    assert right > 0.98 * len(held)
