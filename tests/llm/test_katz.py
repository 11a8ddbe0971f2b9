from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from trilayer.llm import katz
from trilayer.llm.queries import op1_katz

DATA = "/root/testdata/sf0.01"
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("train", BooleanType()), StructField("score", LongType())])


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "</s>"]


class BruteForce:
    """The model from its definition, in dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        for text in texts:
            words = tokens(text)
            for i in range(len(words)):
                for n in range(1, order + 1):
                    gram = self.gram(words, i, n)
                    if gram:
                        self.counts[n][gram] += 1
        self.starts, self.n = len(texts), sum(self.counts[1].values())
        self.discounts = []
        for n in range(1, order + 1):
            seen = Counter(self.counts[n].values())
            self.discounts.append(katz.Discount(
                [seen[r] for r in range(1, katz.K + 2)], self.n, len(self.counts[n])))
        self.follow = defaultdict(list)
        for n in range(2, order + 1):
            for gram in self.counts[n]:
                self.follow[gram[:-1]].append(gram[-1])

    @staticmethod
    def gram(words, i, n):
        if n == 1:
            return (words[i],)
        padded = ["<s>", *words]
        return tuple(padded[i + 2 - n : i + 2]) if i + 2 - n >= 0 else None

    def history(self, h):
        return self.starts if h == ("<s>",) else self.counts[len(h)][h]

    def mass(self, gram):
        return float(self.discounts[len(gram) - 1].mass(np.array([self.counts[len(gram)][gram]]))[0])

    def p(self, gram):
        n = len(gram)
        if n == 1:
            c = self.counts[1][gram]
            return (self.mass(gram) if c else self.discounts[0].left) / self.n
        h = gram[:-1]
        if not self.history(h):
            return self.p(gram[1:])
        if self.counts[n][gram]:
            return self.mass(gram) / self.history(h)
        return self.weight(h) * self.p(gram[1:])

    def weight(self, h):
        taken = sum(self.mass((*h, w)) / self.history(h) for w in self.follow[h])
        return (1 - taken) / (1 - sum(self.p((*h[1:], w)) for w in self.follow[h]))

    def score(self, text):
        words = tokens(text)
        grams = [next(g for n in range(self.order, 0, -1) if (g := self.gram(words, i, n)))
                 for i in range(len(words))]
        return sum(math.log10(self.p(g)) for g in grams)


TEXTS = [("the cat sat on the mat", True), ("The cat ate", True), ("a cat sat", True),
         (None, True), ("", False), ("the dog sat on a cat", False), ("zzz qqq", False),
         ("the cat sat on the mat", True), ("mat the on sat", None), (" \n\t", True),
         ("a b c d e f g h i j the cat " * 7, True)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(katz, "CHUNK_BYTES", 40)
    docs = spark.createDataFrame([(i, t, b, 7) for i, (t, b) in enumerate(TEXTS)], DOCS)
    found, _ = katz.score(docs.repartition(3), order=order)
    model = BruteForce([t for t, b in TEXTS if b], order)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(TEXTS)
    for i, (text, _) in enumerate(TEXTS):
        words = tokens(text)
        row = rows[i]
        assert row["n_tokens"] == len(words)
        assert row["n_known"] == sum(model.counts[1][(w,)] > 0 for w in words)
        assert row["train_tokens"] == model.n
        base = sum(math.log10((model.counts[1][(w,)] + 1) / (model.n + len(model.counts[1]) + 1))
                   for w in words)
        assert row["base_score"] == pytest.approx(base, rel=1e-12)
        assert row["score"] == pytest.approx(model.score(text), rel=1e-9)


def test_probabilities_of_a_history_sum_to_one():
    model = BruteForce([t for t, b in TEXTS if b], 3)
    words = [w for (w,) in model.counts[1]] + ["<unk>"]
    assert sum(model.p((w,)) for w in words) == pytest.approx(1, abs=1e-12)
    for h in [("the",), ("cat",), ("<s>",), ("the", "cat"), ("<s>", "the"), ("on", "the")]:
        assert sum(model.p((*h, w)) for w in words) == pytest.approx(1, abs=1e-12)


def test_stored_tables(spark):
    docs = spark.createDataFrame([(i, t, b, 7) for i, (t, b) in enumerate(TEXTS)], DOCS)
    _, stored = katz.score(docs)
    model = BruteForce([t for t, b in TEXTS if b], 2)
    for order in (1, 2):
        rows = spark.read.parquet(stored.counts).filter(f"order = {order} and chunk < 0").collect()
        totals = np.concatenate([katz.unpack(r["totals"], np.int64) for r in rows])
        assert sorted(totals.tolist()) == sorted(model.counts[order].values())
        keys = np.concatenate([katz.unpack(r["keys"], ascending=True) for r in rows])
        assert len(np.unique(keys)) == len(model.counts[order])
    rows = spark.read.parquet(stored.backoff).filter("chunk < 0").collect()
    weights = np.concatenate([katz.unpack(r["totals"], np.float64) for r in rows])
    want = [model.weight(h) for h in model.follow if len(h) == 1]
    assert sorted(weights.tolist()) == pytest.approx(sorted(want), rel=1e-9)


def test_empty_and_untrained(spark):
    docs = spark.createDataFrame([(1, "a b", False, 7), (None, None, None, 7)], DOCS)
    found, _ = katz.score(docs)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[1]["score"] == 0 and rows[None]["n_tokens"] == 1 and rows[1]["n_known"] == 0
    assert katz.score(docs.limit(0))[0].count() == 0


def test_whole_table_beats_the_base_on_held_out_texts(spark):
    rows = op1_katz(spark, DATA).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in rows)
