from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trilayer.llm import near_dup
from trilayer.llm.queries import op7_near_duplicates

DATA = "/root/testdata/sf0.01"
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("n_shingles", LongType())])


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return frozenset()
    width = min(5, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def brute_force(rows):
    """component_id of each row by comparing all pairs that share a shingle."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    having = {}
    for i, s in enumerate(sets):
        near = {j for g in s for j in having.get(g, ())}
        for j in near:
            common = len(s & sets[j])
            if 100 * common >= 85 * (len(s) + len(sets[j]) - common):
                parent[find(i)] = find(j)
        for g in s:
            having.setdefault(g, []).append(i)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        root = find(i)
        known = smallest.get(root)
        smallest[root] = doc if known is None else known if doc is None else min(doc, known)
    return sorted(
        ((doc, len(sets[i]), smallest[find(i)], doc == smallest[find(i)])
         for i, (doc, _) in enumerate(rows)), key=str)


def test_whole_table_equals_brute_force(spark):
    sql = f"SELECT doc_id, text FROM '{DATA}/documents.parquet'"
    rows = duckdb.connect().execute(sql).fetchall()
    found = op7_near_duplicates(spark, DATA)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted((tuple(r) for r in found.collect()), key=str)
    assert found == brute_force(rows)
    assert sum(not r[3] for r in found) > 20


@pytest.mark.parametrize("size", [near_dup.BLOCK_SETS, 7])
def test_chains_over_many_blocks(spark, monkeypatch, size):
    """Each text differs from the one before in one word, so only neighbours are linked."""
    monkeypatch.setattr(near_dup, "BLOCK_SETS", size)
    monkeypatch.setattr(near_dup, "FOLLOWERS", size)
    monkeypatch.setattr(near_dup, "PACK_LINKS", size)
    chain, text = [], [f"w{i}" for i in range(80)]
    for i in range(60):
        text = [*text[: (i * 7) % 80], f"x{i}", *text[(i * 7) % 80 + 1 :]]
        chain.append((1000 - i, " ".join(text)))
    rows = [*chain, *[(2000 + i, chain[5][1]) for i in range(9)], (1, "alone " * 3)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], DOCS)
    found = sorted((tuple(r) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert found == brute_force(rows)


def test_nulls_short_texts_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "one two three"),
            (None, "one two"), (7, "a b c d e"), (7, "a b c d e"), (7, "z y x w v u"),
            (None, None), (8, "É b c d e"), (9, "é b c d e")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], DOCS)
    found = sorted((tuple(r) for r in near_dup.near_duplicates(docs).collect()), key=str)
    want = brute_force(rows)
    assert [r for r in found if r[0] is not None] == [r for r in want if r[0] is not None]
    assert {r[2:] for r in found if r[0] is None} == {(4, False), (None, True)}
    empty = near_dup.near_duplicates(docs.limit(0))
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert empty.count() == 0


def test_tables_pair_all_half_keys():
    assert near_dup.HALVES**2 == 100
    assert len(near_dup._HASHES) == 2 * near_dup.HALVES * near_dup.WIDTH


def edited(rng, base, share):
    """A copy of the words with this share of them replaced."""
    copy = list(base)
    for at in rng.sample(range(len(copy)), int(share * len(copy))):
        copy[at] = f"e{rng.random()}"
    return copy


def test_recall_of_pairs_just_above_the_limit(spark):
    """Pairs of similarity 0.85 to 0.90, each with no other text like them."""
    rng, rows, want = random.Random(5), [], set()
    while len(want) < 1500:
        base = [f"v{rng.randrange(10**6)}" for _ in range(200)]
        copy = edited(rng, base, rng.choice([0.005, 0.01, 0.015, 0.02]))
        a, b = shingles(" ".join(base)), shingles(" ".join(copy))
        if 0.85 <= len(a & b) / len(a | b) <= 0.90:
            want.add(len(rows))
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dup.near_duplicates(docs).collect()
    linked = {r["component_id"] for r in found if r["component_id"] != r["doc_id"]}
    assert linked <= want
    assert len(linked) >= 0.99 * len(want)


def test_texts_of_one_template_are_not_linked(spark):
    """Texts that share much, though not enough, stay apart; a true copy is found."""
    rng = random.Random(6)
    frame = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join([*frame, *(f"p{rng.random()}" for _ in range(75))])) for i in range(600)]
    rows += [(1000 + i, " ".join(edited(rng, rows[i][1].split(), 0.01))) for i in range(0, 600, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    nodes = near_dup.sketches(docs).filter("n > 0")
    links = near_dup.candidate_links(nodes, 16)
    assert links.select("a", "b").distinct().count() < 2 * len(rows)
    found = sorted((tuple(r) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert found == brute_force(rows)
