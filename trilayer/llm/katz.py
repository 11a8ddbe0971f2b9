"""Scores of texts under a Katz backoff model of word n-grams.

A text is its words and one end mark; contexts begin with a start mark. An n-gram seen
c times in training after a history seen h times has probability d(c) * c / h, where d is
the Good-Turing discount of its order for c up to ``K`` (an absolute one where the counts
of counts give none), and c - ``LEAST`` counts beyond, so that every history keeps some
mass. An unseen one has the backoff weight of its history times its probability under the
history without its first word. The weight makes the probabilities of a history sum to
one exactly: what its seen n-grams leave, over what the shorter history gives to the
words unseen after it. Words unseen in training share what the single words leave.

Everything is kept as sorted arrays of 64-bit n-gram ids, cut into ranges:

* Documents are packed into chunks, each holding its distinct words and, per token, the
  place among them. Chunks are bucketed by their number, so later joins leave them where
  they are.
* Per order, each chunk sends its distinct n-grams with their training counts to the range
  they belong to. There they are added up, so a very common n-gram costs one entry per
  chunk. The range is stored (table ``counts``, partitioned by order), and every chunk
  gets back the totals in the order it asked. The smallest chunk that has an n-gram is
  told so, and so each n-gram is counted once in what follows.
* Each chunk adds up, per history, the probabilities of the n-grams it answers for and
  those under the shorter history; the ranges of histories add these up to the backoff
  weights (table ``backoff``, partitioned by order) and return those asked for.
* With totals and weights at hand each chunk evaluates its tokens, order by order.

The tables grow with the corpus and are never at the driver, which sees the counts of
counts only. Ids of different n-grams are equal with a chance of about 2**-64.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from trilayer.llm.words import mix, runs, slices, words
from trilayer.workspace import new_dir

ORDER = 2
K = 5
LEAST = 1e-3
CHUNK_BYTES = 8 << 20
#: N-grams of a range, about.
RANGE_KEYS = 1 << 20

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit values as zstd-compressed byte planes, of differences if they ascend."""
    values = np.ascontiguousarray(values).view(np.uint64)
    if ascending and len(values):
        values = np.concatenate((values[:1], np.diff(values)))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes, kind=np.uint64, ascending: bool = False) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], size * 8, "zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(8, size)
    values = np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)
    if ascending:
        values = np.cumsum(values, dtype=np.uint64)
    return values.view(kind)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and the place of each value among them."""
    order = np.argsort(values)
    ordered = values[order]
    at = runs(ordered)
    places = np.empty(len(values), np.int64)
    places[order] = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return ordered[at[:-1]] if len(values) else values, places


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2**bits ranges begins in the sorted keys, and the end."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


class Discount:
    """Good-Turing discounts of one order, from the counts of counts."""

    def __init__(self, counts_of_counts: list[int], tokens: int, types: int):
        n = [0, *counts_of_counts]
        self.tokens, self.types = tokens, types
        self.small = np.ones(K + 1)
        cut = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        for r in range(1, K + 1):
            ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
            value = (ratio - cut) / (1 - cut) if cut < 1 else 0.0
            self.small[r] = value if 0.05 < value < 1 else (r - 0.5) / r
        left = sum(n[r] * r * (1 - self.small[r]) for r in range(1, K + 1))
        self.left = left + LEAST * (types - sum(n[1 : K + 1]))

    def mass(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        small = self.small[np.minimum(counts, K)] * counts
        return np.where(counts > K, counts - LEAST, small)


class Chunk:
    """Tokens of some documents, and what has been learned of their n-grams so far."""

    def __init__(self, row: dict):
        self.vocabulary = unpack(row["vocabulary"], ascending=True)
        self.tokens = unpack(row["tokens"], np.int64)
        self.sizes = unpack(row["sizes"], np.int64)
        train = np.array(row["train"], bool)
        self.document = np.repeat(np.arange(len(self.sizes)), self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.tokens)) - np.repeat(first, self.sizes)
        self.train = train[self.document]
        self.number = row["chunk"]

    def grams(self, order: int):
        """Positions that have an n-gram of this order, its id and its history's."""
        word = self.vocabulary[self.tokens]
        if order == 1:
            return np.arange(len(word)), word, word
        at = np.flatnonzero(self.place >= order - 2)
        history = self._history(word, order)[at]
        return at, mix(history * _STEP + word[at] + np.uint64(order)), history

    def _history(self, word: np.ndarray, order: int) -> np.ndarray:
        """Id of the order - 1 tokens before each position, the start mark included."""
        total = np.zeros(len(word), np.uint64)
        for back in range(order - 1, 0, -1):
            token = np.full(len(word), START)
            token[back:] = word[:-back] if back < len(word) else token[back:]
            token = np.where(self.place >= back, token, START)
            known = self.place >= back - 1
            total = np.where(known, mix(total * _STEP + token + np.uint64(1)), total)
        return total


def _requests(keys: np.ndarray, bits: int, *columns):
    """Per range that has keys: its number, the keys and the slices of the columns."""
    at = cuts(keys, bits)
    for number in np.flatnonzero(np.diff(at)).tolist():
        low, high = at[number], at[number + 1]
        yield number, pack(keys[low:high], True), *(pack(c[low:high]) for c in columns)


def packed(docs: DataFrame, id_column: str, text: str, train: str) -> DataFrame:
    """The chunks of ``docs``, written as a table bucketed by chunk."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"),
                       F.coalesce(F.col(train), F.lit(False)).alias("train"))
    schema = StructType([
        StructField("chunk", LongType()), StructField("ids", ArrayType(rows.schema["id"].dataType)),
        StructField("train", ArrayType(BooleanType())), StructField("n_train", LongType()),
        StructField("n_tokens", LongType()), StructField("sizes", BinaryType()),
        StructField("vocabulary", BinaryType()), StructField("tokens", BinaryType()),
    ])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", CHUNK_BYTES):
            found = words(batch.column("text"))
            total = len(found.ids) + batch.num_rows
            ids = np.full(total, END)
            last = found.first[1:] + np.arange(batch.num_rows)
            is_word = np.ones(total, bool)
            is_word[last] = False
            ids[is_word] = found.ids
            vocabulary, places = distinct(ids)
            train = batch.column("train")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([batch.column("id").to_pylist()],
                                              pa.list_(batch.schema.field("id").type)),
                 pa.array([train.to_pylist()]), pa.array([train.true_count]),
                 pa.array([total]), pa.array([pack(found.counts + 1)]),
                 pa.array([pack(vocabulary, True)]), pa.array([pack(places)])],
                names=schema.names)
            number += 1

    spark = docs.sparkSession
    name, path = f"katz_{uuid.uuid4().hex}", new_dir(spark, "katz-chunks")
    (rows.mapInArrow(run, schema).write
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
     .option("path", path).option("compression", "none").saveAsTable(name))
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are in the shared folder
    return chunks


def _answered(chunks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Chunks with all answers of the given tables, in order of table and range."""
    if not answers:
        return chunks.withColumn("answers", F.lit(None).cast(
            "array<struct<step:int,part:int,totals:binary,mine:binary>>"))
    every = None
    for step, table in enumerate(answers):
        own = table.filter("chunk >= 0").select(
            "chunk", F.struct(F.lit(step).alias("step"), "part", "totals", "mine").alias("answer"))
        every = own if every is None else every.unionByName(own)
    gathered = every.groupBy("chunk").agg(
        F.sort_array(F.collect_list("answer")).alias("answers"))
    return chunks.join(gathered, "chunk", "left")


class Known:
    """A chunk with what it has been told, evaluated up to an order. ``weighed`` tells
    whether the backoff weights of that order are among the answers."""

    def __init__(self, row: dict, order: int, discounts: list[Discount], documents: int,
                 weighed: bool):
        self.chunk = chunk = Chunk(row)
        steps: dict[int, list] = {}
        for answer in row["answers"] or ():
            steps.setdefault(answer["step"], []).append(answer)

        def told(step: int, field: str, kind) -> np.ndarray:
            parts = [unpack(answer[field], kind) for answer in steps.get(step, ())]
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        size = len(chunk.tokens)
        self.unigrams = self.total = told(0, "totals", np.int64)[chunk.tokens]
        first = discounts[0]
        spare = first.left / first.tokens if first.tokens else 1.0
        mass = first.mass(self.total) / max(1, first.tokens)
        self.probability = np.where(self.total > 0, mass, spare)
        for n in range(2, order + 1):
            step = 2 * n - 3  # counts of order n; its weights come next
            self.at, ids, self.history = chunk.grams(n)
            _, places = distinct(ids)
            total = np.zeros(size, np.int64)
            total[self.at] = told(step, "totals", np.int64)[places]
            before = np.zeros(size, np.int64)
            before[1:] = self.total[:-1]
            before[chunk.place == 0] = documents if n == 2 else 0
            seen = (total > 0) & (before > 0)
            self.own = discounts[n - 1].mass(total) / np.maximum(before, 1)
            self.lower = self.probability
            asks = (~seen & (before > 0))[self.at]
            self.asked = np.unique(self.history[asks])
            mine = told(step, "mine", np.int64) > 0
            newest = np.zeros(len(mine), np.int64)
            newest[places] = np.arange(len(places))  # one position of each n-gram
            self.answers_for = newest[mine][seen[self.at[newest[mine]]]]
            if n < order or weighed:
                weight = np.ones(size)
                weights = told(step + 1, "totals", np.float64)
                weight[self.at[asks]] = weights[np.searchsorted(self.asked, self.history[asks])]
                self.probability = np.where(seen, self.own, weight * self.probability)
            self.total = total

    def context_sums(self):
        """Per history of the n-grams this chunk answers for, or asked for: what its
        n-grams take, what they would take under a shorter one, and whether it is asked."""
        histories = self.history[self.answers_for]
        kinds = np.union1d(histories, self.asked)
        place, at = np.searchsorted(kinds, histories), self.at[self.answers_for]
        taken = np.bincount(place, self.own[at], len(kinds))
        lower = np.bincount(place, self.lower[at], len(kinds))
        return kinds, taken, lower, np.isin(kinds, self.asked).astype(np.int64)


_ANSWER = "chunk long, part int, totals binary, mine binary"
_COUNTED = f"{_ANSWER}, keys binary, of_counts array<long>, tokens long, types long"


def _add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One range of one order: totals for each chunk, and the range's own row."""
    order = np.argsort(np.asarray(table.column("chunk")), kind="stable")
    table = table.take(pa.array(order))
    keys = [unpack(k, ascending=True) for k in table.column("keys").to_pylist()]
    counts = [unpack(c, np.int64) for c in table.column("counts").to_pylist()]
    flat = np.concatenate(keys)
    by_key = np.argsort(flat, kind="stable")
    at = runs(flat[by_key])
    sums = np.add.reduceat(np.concatenate(counts)[by_key], at[:-1])
    totals, first = np.empty(len(flat), np.int64), np.zeros(len(flat), np.int64)
    totals[by_key] = np.repeat(sums, np.diff(at))
    first[by_key[at[:-1]]] = 1
    ends = np.cumsum([len(k) for k in keys])
    spans = list(zip(ends - [len(k) for k in keys], ends))
    stored = sums > 0
    of_counts = np.bincount(np.minimum(sums[stored], K + 2), minlength=K + 3)[1 : K + 2]
    none = [None] * len(keys)
    return pa.table({
        "chunk": pa.array([*table.column("chunk").to_pylist(), -1], pa.int64()),
        "part": pa.array([key[0].as_py()] * (len(keys) + 1), pa.int32()),
        "totals": pa.array([*(pack(totals[i:j]) for i, j in spans), pack(sums[stored])],
                           pa.binary()),
        "mine": pa.array([*(pack(first[i:j]) for i, j in spans), None], pa.binary()),
        "keys": pa.array([*none, pack(flat[by_key][at[:-1]][stored], True)], pa.binary()),
        "of_counts": pa.array([*none, of_counts.tolist()], pa.list_(pa.int64())),
        "tokens": pa.array([*none, int(sums.sum())], pa.int64()),
        "types": pa.array([*none, int(stored.sum())], pa.int64()),
    })


def _weigh(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One range of histories: backoff weights for each chunk that asked, and all."""
    order = np.argsort(np.asarray(table.column("chunk")), kind="stable")
    table = table.take(pa.array(order))
    keys = [unpack(k, ascending=True) for k in table.column("keys").to_pylist()]
    columns = {n: np.concatenate([unpack(c, np.float64) for c in table.column(n).to_pylist()])
               for n in ("taken", "lower")}
    needed = [unpack(c, np.int64) > 0 for c in table.column("needed").to_pylist()]
    flat = np.concatenate(keys)
    by_key = np.argsort(flat, kind="stable")
    at = runs(flat[by_key])
    taken, lower = (np.add.reduceat(columns[n][by_key], at[:-1]) for n in ("taken", "lower"))
    weight = np.maximum(1 - taken, 0) / np.maximum(1 - lower, 1e-300)
    each = np.empty(len(flat))
    each[by_key] = np.repeat(weight, np.diff(at))
    ends = np.cumsum([len(k) for k in keys])
    answers = [pack(each[j - len(k) : j][n]) for k, j, n in zip(keys, ends, needed)]
    none = [None] * len(keys)
    return pa.table({
        "chunk": pa.array([*table.column("chunk").to_pylist(), -1], pa.int64()),
        "part": pa.array([key[0].as_py()] * (len(keys) + 1), pa.int32()),
        "totals": pa.array([*answers, pack(weight)], pa.binary()),
        "mine": pa.array([*none, None], pa.binary()),
        "keys": pa.array([*none, pack(flat[by_key][at[:-1]], True)], pa.binary()),
    })


class Model:
    """The stored tables and what is read of them at the driver."""

    def __init__(self, counts: str, backoff: str, discounts: list[Discount], documents: int):
        self.counts, self.backoff = counts, backoff
        self.discounts, self.documents = discounts, documents


@contextmanager
def _exchanges_freed(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes what a query has shuffled as soon as it is done. Each exchange
    of an order ends in a written table, so the files of earlier orders serve nobody."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
          train: str = "train", order: int = ORDER) -> tuple[DataFrame, Model]:
    """Per row of ``docs``: the id, n_tokens, n_known, train_tokens, base_score and score,
    under the model learned from the rows whose boolean ``train`` holds.

    Null texts are empty: one end mark. A null ``train`` is false. Repeated rows count as
    often as they occur. Without training rows every text scores 0 per token in the model
    (all mass is on the unknown word). No rows give no rows.
    """
    spark = docs.sparkSession
    chunks = packed(docs, id_column, text, train)
    tokens, documents = chunks.agg(F.sum("n_tokens"), F.sum("n_train")).first()
    bits = max(3, ((tokens or 0) // RANGE_KEYS).bit_length())
    documents = documents or 0
    counts, backoff = new_dir(spark, "katz-counts"), new_dir(spark, "katz-backoff")
    discounts: list[Discount] = []
    answers: list[DataFrame] = []
    with _exchanges_freed(spark):
        for n in range(1, order + 1):
            table = _counted(chunks, n, bits)
            table.write.parquet(f"{counts}/order={n}", compression="none")
            table = spark.read.schema(_COUNTED).parquet(f"{counts}/order={n}")
            seen = table.filter("chunk < 0").agg(
                *[F.sum(F.col("of_counts")[r]) for r in range(K + 1)], F.sum("tokens"),
                F.sum("types")).first()
            *of_counts, total, types = (v or 0 for v in seen)
            discounts.append(Discount(of_counts, total, types))
            answers.append(table.select("chunk", "part", "totals", "mine"))
            if n > 1:
                table = _weighed(chunks, answers, n, bits, discounts, documents)
                table.write.parquet(f"{backoff}/order={n}", compression="none")
                table = spark.read.schema(f"{_ANSWER}, keys binary").parquet(f"{backoff}/order={n}")
                answers.append(table.select("chunk", "part", "totals", "mine"))
    model = Model(counts, backoff, discounts, documents)
    return _evaluated(chunks, answers, order, model, docs.schema[id_column].dataType,
                      id_column), model


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


_CHUNK = ("chunk", "train", "sizes", "vocabulary", "tokens", "answers")


def _counted(chunks: DataFrame, n: int, bits: int) -> DataFrame:
    def run(batches):
        for row in _rows(batches):
            chunk = Chunk(row)
            at, ids, _ = chunk.grams(n)
            kinds, places = distinct(ids)
            counts = np.bincount(places[chunk.train[at]], minlength=len(kinds))
            for part, keys, own in _requests(kinds, bits, counts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([chunk.number]), pa.array([keys]),
                     pa.array([own])], names=["part", "chunk", "keys", "counts"])

    sent = _answered(chunks, []).select(*_CHUNK).mapInArrow(
        run, "part int, chunk long, keys binary, counts binary")
    return sent.groupBy("part").applyInArrow(_add_up, _COUNTED)


def _weighed(chunks, answers, n, bits, discounts, documents) -> DataFrame:
    def run(batches):
        for row in _rows(batches):
            known = Known(row, n, discounts, documents, False)
            kinds, taken, lower, needed = known.context_sums()
            for part, keys, *own in _requests(kinds, bits, taken, lower, needed):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([known.chunk.number]),
                     pa.array([keys]), *(pa.array([c]) for c in own)],
                    names=["part", "chunk", "keys", "taken", "lower", "needed"])

    sent = _answered(chunks, answers).select(*_CHUNK).mapInArrow(
        run, "part int, chunk long, keys binary, taken binary, lower binary, needed binary")
    return sent.groupBy("part").applyInArrow(_weigh, f"{_ANSWER}, keys binary")


def _evaluated(chunks, answers, order, model, kind, id_column) -> DataFrame:
    discounts, documents = model.discounts, model.documents
    schema = StructType([
        StructField(id_column, kind), StructField("n_tokens", LongType()),
        StructField("n_known", LongType()), StructField("train_tokens", LongType()),
        StructField("base_score", DoubleType()), StructField("score", DoubleType())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.select(_CHUNK).to_pylist()[0]
                known = Known(row, order, discounts, documents, True)
                chunk, first = known.chunk, np.cumsum(known.chunk.sizes) - known.chunk.sizes
                total = discounts[0].tokens
                base = np.log10((known.unigrams + 1) / (total + discounts[0].types + 1))
                logs = np.log10(known.probability)
                size = len(chunk.sizes)
                yield pa.RecordBatch.from_arrays(
                    [one.column("ids").flatten(), pa.array(chunk.sizes),
                     pa.array(np.add.reduceat((known.unigrams > 0).astype(np.int64), first)),
                     pa.array(np.full(size, total)), pa.array(np.add.reduceat(base, first)),
                     pa.array(np.add.reduceat(logs, first))], names=schema.names)

    return _answered(chunks, answers).select(*_CHUNK, "ids").mapInArrow(run, schema)
