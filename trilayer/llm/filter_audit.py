"""How quality filters interact: what each removes, alone and after the others.

Repeated texts are found in two steps. Every text adds one to a few counters of a
counting Bloom filter, which tasks build from 64-bit hashes and which is merged by ranges
of counters. A text one of whose counters stands at one is unique for certain. Only the
texts of the others are shuffled, grouped by the whole text, and the smallest id of each
group is the one that is no repetition. The filter has ``PER_ROW`` counters of two bits
for each row and at most ``MAX_COUNTERS``; with more rows than it has room for, fewer
texts are cleared and more are grouped, but results are the same.

Flags of a row make a mask. Counts per part and mask are additive, and every order of the
filters is read off them, so documents are visited once however many orders there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.llm.words import mix, slices, utf8, words
from trilayer.workspace import written

LETTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"

#: Counters of a text, counters per row of the table, and bounds of their number, which
#: is a power of two. Two bits each, so the largest filter has 64 MB.
PROBES = 3
PER_ROW = 8
MIN_COUNTERS = 1 << 16
MAX_COUNTERS = 1 << 28
#: Counters that one task merges, and hashes that a task gathers before it sends counts.
SEGMENT = 1 << 16
GATHERED = 1 << 18


def counters_for(rows: int, limit: int = MAX_COUNTERS) -> int:
    return min(limit, max(MIN_COUNTERS, 1 << (PER_ROW * max(rows, 1) - 1).bit_length()))


def probes(hashes: np.ndarray, counters: int) -> np.ndarray:
    """The counters of each hash, one row per probe."""
    first = mix(hashes.astype(np.uint64))
    step = mix(first + np.uint64(1)) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((first + turns * step) & np.uint64(counters - 1)).astype(np.int64)


def merged_counters(hashes: DataFrame, counters: int) -> np.ndarray:
    """The counting filter of a column ``hash``: two bits a counter, standing at 2 for
    "two or more". Tasks send what their rows add, by segments of counters."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(parts):
            # two probes of one text that meet count as two, which clears less, never more
            at, added = np.unique(probes(np.concatenate(parts), counters), return_counts=True)
            segments = at // SEGMENT
            cuts = np.flatnonzero(np.diff(segments, prepend=-1))
            ends = np.append(cuts[1:], len(at))
            place = (at % SEGMENT).astype(np.uint32) * np.uint32(2) + (added > 1).astype(np.uint32)
            return pa.RecordBatch.from_pydict({
                "segment": pa.array(segments[cuts], pa.int64()),
                "added": pa.array([place[i:j].tobytes() for i, j in zip(cuts, ends)], pa.binary()),
            })

        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(np.asarray(batch.column("hash")).view(np.uint64))
                held += batch.num_rows
            if held >= GATHERED:
                yield packed(parts)
                parts, held = [], 0
        if parts:
            yield packed(parts)

    def merge(table: pa.Table) -> pa.Table:
        place = np.frombuffer(b"".join(table.column("added").to_pylist()), np.uint32)
        total = np.bincount(place // 2, 1 + place % 2, SEGMENT)
        level = np.minimum(total, 2).astype(np.uint8).reshape(-1, 4)
        bits = (level << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
        return pa.table({"segment": table.column("segment")[:1],
                         "bits": pa.array([bits.tobytes()], pa.binary())})

    found = (
        hashes.mapInArrow(send, "segment long, added binary")
        .groupBy("segment").applyInArrow(merge, "segment long, bits binary")
    )
    whole = np.zeros(counters // 4, np.uint8)
    for segment, bits in found.collect():  # at most MAX_COUNTERS / 4 bytes
        low = segment * SEGMENT // 4
        whole[low : low + SEGMENT // 4] = np.frombuffer(bits, np.uint8)
    return whole


def may_repeat(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether all counters of each hash stand at two or more."""
    at = probes(hashes, 4 * len(bits))
    return ((bits[at // 4] >> (2 * (at % 4)).astype(np.uint8)) & 3 == 2).all(axis=0)


def own_flags(texts: pa.Array) -> np.ndarray:
    """Bits of the filters A to D, which look at one text alone."""
    found = words(texts, fold=False)
    n = found.counts
    rows = found.rows
    order = np.lexsort((found.ids, rows))
    ids, owner = found.ids[order], rows[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (owner[1:] != owner[:-1])
    distinct = np.bincount(owner[new], minlength=len(n))
    raw, at = utf8(texts)

    def count(wanted: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(wanted)))
        return sums[at[1:]] - sums[at[:-1]]

    capitals = count((raw >= 65) & (raw <= 90))
    points = count((raw & 0xC0) != 0x80)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    return (
        (n < MIN_WORDS) * 1
        + (100 * distinct < MIN_DISTINCT_PERCENT * n) * 2
        + (100 * capitals > MAX_CAPITAL_PERCENT * points) * 4
        + (count(symbol[raw]) > 0) * 8
    )


def masks(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
          part: str = "source", max_counters: int = MAX_COUNTERS) -> DataFrame:
    """Per row of ``docs``: the id, its part (null: empty) and mask, bit 0 for A up to
    bit 4 for E.

    A null text counts as empty. A row fails E if a row with a smaller id has the same
    text; rows that share an id do not make each other fail, and a row without an id
    neither fails E nor makes others fail.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    counters = counters_for(docs.count(), max_counters)
    context = docs.sparkSession.sparkContext
    sketch = context.broadcast(merged_counters(rows.select("hash"), counters))

    def run(batches):
        for batch in slices(batches, "text"):
            hashes = np.asarray(batch.column("hash"))
            maybe = may_repeat(hashes.view(np.uint64), sketch.value)
            texts = batch.column("text")
            chosen = pa.array(np.arange(len(maybe)), mask=~maybe)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("part"), batch.column("hash"),
                 pa.array(own_flags(texts), pa.int32()),
                 texts.take(chosen), pa.array(maybe)],
                names=["id", "part", "hash", "own", "text", "maybe"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    marked = written(
        rows.mapInArrow(run, f"id {kind}, part string, hash long, own int, text string, maybe boolean"),
        "audit-flags",
    )
    sketch.unpersist()
    firsts = (
        marked.filter("maybe AND id IS NOT NULL").groupBy("text").agg(F.min("id").alias("id"))
        .select("id", F.xxhash64("text").alias("hash"), F.lit(True).alias("is_first"))
    )
    repeated = F.col("maybe") & F.col("id").isNotNull() & F.col("is_first").isNull()
    return marked.select("id", "part", "hash", "own", "maybe").join(
        firsts, ["id", "hash"], "left"
    ).select(
        F.col("id").alias(id_column), "part",
        (F.col("own") + F.when(repeated, 16).otherwise(0)).alias("mask"),
    )


def mask_counts(flagged: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Rows per part and mask, and how many of them a label calls good or toxic.

    An id with several labels is good, or toxic, if one of them says so.
    """
    known = labels.groupBy(id_column).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    return flagged.select(id_column, "part", "mask").join(known, id_column, "left").groupBy(
        "part", "mask"
    ).agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def orders_of(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order of the filters, step by step, for each part of ``counts``."""
    orders = list(permutations(range(len(letters))))
    every = np.arange(1 << len(letters))
    bits = np.array(orders)
    steps = np.arange(len(letters))
    before = np.cumsum(1 << bits, axis=1) - (1 << bits)
    fails = (every >> bits[..., None]) & 1 == 1
    earlier = every & before[..., None] != 0
    removed = fails & ~earlier
    kept = ~fails & ~earlier
    alone = every == (1 << bits)[..., None]
    names = ["".join(letters[i] for i in order) for order in orders]

    def read(table: pa.Table) -> pa.Table:
        columns = {}
        for name in ("n", "good", "toxic"):
            columns[name] = np.zeros(len(every), np.int64)
            columns[name][np.asarray(table.column("mask"))] = np.asarray(table.column(name))
        gone = removed @ columns["n"]
        shares = np.bincount(bits.ravel(), gone.ravel(), len(letters)).astype(np.int64)
        size = gone.size
        return pa.table({
            "part": pa.array([table.column("part")[0].as_py()] * size, pa.string()),
            "filter_order": np.repeat(names, len(letters)).tolist(),
            "step": pa.array(np.tile(steps + 1, len(orders)), pa.int32()),
            "kept": (kept @ columns["n"]).ravel(),
            "removed": gone.ravel(),
            "redundant": ((fails & earlier) @ columns["n"]).ravel(),
            "unique_fails": (alone @ columns["n"]).ravel(),
            "good_lost": (removed @ columns["good"]).ravel(),
            "toxic_lost": (removed @ columns["toxic"]).ravel(),
            "shapley": shares[bits].ravel(),
        })

    longs = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in longs)
    return counts.groupBy("part").applyInArrow(read, schema)


def audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """Per part, order of the filters and step: rows kept after it, removed by it, failing
    it but removed before, failing it alone, good and toxic rows it removes, and what its
    filter removes summed over all orders. No documents give no rows; other columns of the
    inputs are ignored; very long texts are taken whole, one at a time."""
    return orders_of(mask_counts(masks(docs, id_column, text, part), labels, id_column))
