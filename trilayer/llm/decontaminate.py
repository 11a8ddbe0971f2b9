"""Benchmark decontamination by a prefix-filtered set join.

Each item window (``WINDOW`` consecutive words, or a whole shorter item) is a set of word
shingles; a document window contains it only if it has all of them. So one shingle is a
necessary prefix, and the rarest in the corpus is the best choice: the shingles are
ordered by their number of occurrences in all documents, and document shingles are joined
to the rarest of each window only. Where one meets, its place in the window gives the only
possible alignment; the document must reach that far to the left (position) and to the
right (length). The words of what remains are compared one by one.

Documents are read twice, whatever the benchmark's size: once to count shingles, once to
look for prefixes. Windows, shingles and prefixes are tables built by tasks. A task is
given a Bloom filter of at most ``MAX_BITS`` bits; what passes it is joined exactly, with
the few words around it, so a fuller filter costs time but no result. Texts are never
shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from trilayer.llm.words import ALNUM_WORD, Words, mix, slices, words
from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

WINDOW = 10
SHINGLE = 3
#: Bits of a filter for each value in it, at most in all, and tested for each value.
BITS_EACH = 32
MAX_BITS = 1 << 29
TESTS = 4
#: Bits of a filter that are put together by one group.
SEGMENT_BITS = 1 << 15
#: Places of a prefix in a window.
PLACES = WINDOW - SHINGLE + 1


def shingle_ids(ids: np.ndarray, width: int) -> np.ndarray:
    """Of the ``width`` words from each position on; the last ones are of no use."""
    total = np.full(len(ids), width, np.uint64)
    for k in range(width):
        total[: len(ids) - k] += ids[k:] * np.uint64(2 * k + 3)
        if k == 0:
            total = mix(total)
    return mix(total)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix of 64-bit numbers as bytes."""
    size = pa.binary(rows.shape[1] * 8)
    data = pa.py_buffer(np.ascontiguousarray(rows))
    return pa.FixedSizeBinaryArray.from_buffers(size, len(rows), [None, data]).cast(pa.binary())


def item_windows(items: DataFrame, id_column: str, text: str) -> DataFrame:
    """Rows (item, window, words, width, shingles): the item id as text, an id of the
    window's words, their ids as bytes, and its shingles of ``width`` words in order.
    Items without words give none."""

    def run(batches):
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), ALNUM_WORD)
            names, counts = batch.column("item"), found.counts
            left = found.first[1:][found.rows] - np.arange(len(found.ids))
            for length in np.unique(np.minimum(counts, WINDOW)).tolist():
                if length == 0:
                    continue
                own = counts[found.rows] >= WINDOW if length == WINDOW else (
                    counts[found.rows] == length)
                at = np.flatnonzero(own & (left >= length))
                width = min(length, SHINGLE)
                parts = found.ids[at[:, None] + np.arange(length)]
                ids = shingle_ids(found.ids, width)
                shingles = ids[at[:, None] + np.arange(length - width + 1)]
                offsets = np.arange(len(at) + 1, dtype=np.int32) * shingles.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(found.rows[at])),
                     pa.array(shingle_ids(found.ids, length)[at].view(np.int64)),
                     _binary(parts), pa.array(np.full(len(at), width, np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets),
                                              pa.array(shingles.ravel().view(np.int64)))],
                    names=["item", "window", "words", "width", "shingles"])

    named = items.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"),
        F.col(text).alias("text"),
    )
    return named.mapInArrow(
        run, "item string, window long, words binary, width int, shingles array<long>")


def _places(ids: np.ndarray, test: int, bits: int) -> np.ndarray:
    """Bits that stand for the ids in one test; ``bits`` is a power of two."""
    own = ids if test == 0 else mix(ids + np.uint64(test * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (own >> np.uint64(65 - bits.bit_length())).astype(np.int64)


class Filter:
    """A Bloom filter of shingles, and the widths that they have."""

    def __init__(self, bits: np.ndarray, widths: list[int]):
        self.bits, self.widths = bits, widths

    def passing(self, ids: np.ndarray) -> np.ndarray:
        """Indexes of the ids that may be in it."""
        at = np.arange(len(ids))
        for test in range(TESTS):
            place = _places(ids[at], test, len(self.bits) * 8)
            at = at[self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0]
        return at

    def shingles(self, found: Words):
        """Per width its positions that may be in it, and the ids of these."""
        left = found.first[1:][found.rows] - np.arange(len(found.ids))
        for width in self.widths:
            ids = shingle_ids(found.ids, width)
            at = np.flatnonzero(left >= width)
            at = at[self.passing(ids[at])]
            yield width, at, ids[at]


def filter_of(values: DataFrame, widths: list[int]) -> Broadcast:
    """Filter of a table of shingles. Tasks put its segments together; the driver gets the
    bits, ``MAX_BITS`` at most."""
    count, bits = values.count(), SEGMENT_BITS
    while bits < min(count * BITS_EACH, MAX_BITS):
        bits *= 2

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            place = np.unique(np.concatenate([_places(ids, k, bits) for k in range(TESTS)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place // SEGMENT_BITS), pa.array(place % SEGMENT_BITS)],
                names=["segment", "place"])

    def build(table: pa.Table) -> pa.Table:
        own = np.zeros(SEGMENT_BITS, bool)
        own[table.column("place").to_numpy()] = True
        packed = np.packbits(own, bitorder="little").tobytes()
        return pa.table({"segment": table.column("segment")[:1],
                         "bits": pa.array([packed], pa.binary())})

    placed = values.mapInArrow(run, "segment long, place long").distinct()
    built = placed.groupBy("segment").applyInArrow(build, "segment long, bits binary")
    whole = np.zeros((bits // SEGMENT_BITS, SEGMENT_BITS // 8), np.uint8)
    for row in built.toLocalIterator():
        whole[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return values.sparkSession.sparkContext.broadcast(Filter(whole.ravel(), widths))


def _occurrences(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """How often each shingle that passes the filter occurs in all documents."""

    def run(batches):
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), ALNUM_WORD)
            for _, _, ids in shared.value.shingles(found):
                some, counts = np.unique(ids, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.view(np.int64)), pa.array(counts, pa.int64())],
                    names=["shingle", "n"])

    counted = docs.select("text").mapInArrow(run, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def _meets(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """Rows (row, id, n_words, meets): per document the shingles that pass the filter, each
    with its position, the words around it that a window with it can have, and how many of
    these come before."""
    meet = StructType([StructField("position", LongType()), StructField("shingle", LongType()),
                       StructField("lead", IntegerType()), StructField("around", BinaryType())])
    schema = docs.select("row", "id").schema.add("n_words", "long").add("meets", ArrayType(meet))
    kind = pa.struct([("position", pa.int64()), ("shingle", pa.int64()), ("lead", pa.int32()),
                      ("around", pa.binary())])

    def run(batches):
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), ALNUM_WORD)
            meets: list[list] = [[] for _ in range(batch.num_rows)]
            rows = found.rows
            for width, at, ids in shared.value.shingles(found):
                reach = WINDOW if width == SHINGLE else width
                back = PLACES - 1 if width == SHINGLE else 0
                own = rows[at]
                low = np.maximum(at - back, found.first[own])
                high = np.minimum(at + reach, found.first[own + 1])
                for row, place, shingle, a, b in zip(
                    own.tolist(), at.tolist(), ids.view(np.int64).tolist(), low.tolist(),
                    high.tolist(),
                ):
                    meets[row].append({
                        "position": place - int(found.first[row]), "shingle": shingle,
                        "lead": place - a, "around": found.ids[a:b].tobytes()})
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(found.counts, pa.int64()),
                 pa.array(meets, pa.list_(kind))], names=schema.names)

    return docs.select("row", "id", "text").mapInArrow(run, schema)


def _hit_words(spans: DataFrame) -> DataFrame:
    """Rows (row, hits): positions of the words inside any of a document's windows."""

    def run(batches):
        for batch in batches:
            hits = []
            for pairs in batch.column("spans").to_pylist():
                start = np.array([p["start"] for p in pairs], np.int64)
                length = np.array([p["length"] for p in pairs], np.int64)
                edge = np.zeros(int((start + length).max()) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + length, -1)
                hits.append(np.flatnonzero(np.cumsum(edge) > 0).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(hits, pa.binary())], names=["row", "hits"])

    return spans.mapInArrow(run, "row long, hits binary")


def _prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Per window its shingle that documents hold least often, the first of equals, with
    its place. Windows of which a shingle is in no document are in none."""
    shingles = windows.select("window", F.posexplode("shingles").alias("place", "shingle"))
    ranked = shingles.join(broadcast_if_small(counts), "shingle", "left")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "shingle")
    chosen = ranked.groupBy("window").agg(F.min(order).alias("best")).filter("best.n > 0")
    return windows.join(chosen, "window").select(
        "window", "words", F.col("best.place").alias("place"),
        F.col("best.shingle").alias("shingle"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                  text: str = "text", item_column: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_words, n_hit, n_items, items_sha256, contaminated,
    the items and the positions of hit words (64-bit little-endian).

    Null and empty texts have no words and are clean; items without words match nothing;
    a null item id is an empty one; repeated items count once. Without items all are clean.
    Repeated ids are rows of their own. A long text's hits are put together by one task.
    """
    listed = written(item_windows(benchmark, item_column, item_text), "bench-windows")
    windows = written(listed.groupBy("window").agg(
        *(F.first(c).alias(c) for c in ("words", "width", "shingles"))), "bench-distinct")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())
    docs = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_column).alias("id"), F.col(text).alias("text"))

    known = windows.select(F.explode("shingles").alias("shingle")).distinct()
    counts = written(_occurrences(docs, filter_of(known, widths)), "bench-counts")
    prefixes = written(_prefixes(windows, counts), "bench-prefixes")
    shared = filter_of(prefixes.select("shingle").distinct(), widths)
    rows = written(_meets(docs, shared), "bench-meets")

    aligned = rows.select("row", F.explode("meets").alias("meet")).select("row", "meet.*").join(
        broadcast_if_small(prefixes), "shingle")
    same = F.expr("substring(around, (lead - place) * 8 + 1, octet_length(words)) = words")
    hits = written(aligned.filter((F.col("lead") >= F.col("place")) & same).select(
        "row", "window", (F.col("position") - F.col("place")).alias("start"),
        F.floor(F.octet_length("words") / 8).cast("long").alias("length")), "bench-hits")
    spans = hits.groupBy("row").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    owners = listed.select("window", "item").distinct()
    items = hits.select("row", "window").distinct().join(broadcast_if_small(owners), "window")
    items = items.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = written(_hit_words(spans).join(items, "row"), "bench-found")

    found = rows.drop("meets").join(broadcast_if_small(found), "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    hits = F.coalesce("hits", F.lit(b""))
    return found.select(
        F.col("id").alias(id_column),
        "n_words",
        F.floor(F.octet_length(hits) / 8).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.octet_length(hits) > 0).alias("contaminated"),
        items.alias("items"),
        hits.alias("hit_words"),
    )
