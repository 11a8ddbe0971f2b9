"""Document quality by a factorisation machine.

Features of a text are its distinct words, hashed into ``2**HASH_BITS`` places with equal
values of length one in all, and ``DENSE`` structure statistics and metadata (lengths,
shares of character classes, repetition), standardised. Besides a weight each feature has
a vector of ``RANK`` factors; the interaction of two features is the product of their
values and of their vectors. With s = sum of v x over the features and q = sum of (v x)**2,
all pairwise interactions together are (s*s - q) / 2 summed over the factors, so a text is
scored in time linear in its words.

Weights and factors are learned by adaptive gradient descent on log loss from at most
``SAMPLE`` labelled rows; scoring reads all rows and whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trilayer.llm.words import runs, slices, utf8, words
from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

HASH_BITS = 16
RANK = 8
SAMPLE = 4000
BATCH = 50
#: Descent steps, whatever the number of rows.
STEPS = 1000
THRESHOLD = 0.3

_CLASSES = (
    [*range(65, 91)],  # upper case
    [*range(97, 123), *range(128, 256)],  # lower case, and other than ASCII
    [*range(48, 58)],
    [10],
    [33],
    [ord(c) for c in "#*$%&|<>"],
    [ord(c) for c in ".,;:?'\"()-"],
)
DENSE = len(_CLASSES) + 10
_LINE = np.ones(256, bool)
_LINE[10] = False


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed distinct words of all texts, where each text's begin, and the statistics."""
    raw, at = utf8(texts)
    size = np.diff(at)
    found = words(texts)
    place = (found.ids >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    keys = np.sort(found.rows << HASH_BITS | place)
    cut = runs(keys)
    own = keys[cut[:-1]] if len(keys) else keys
    often = np.diff(cut) if len(keys) else np.zeros(0, np.int64)
    first = np.searchsorted(own, np.arange(len(size) + 1) << HASH_BITS)
    distinct = np.diff(first)

    n = found.counts
    dense = np.zeros((len(size), DENSE))
    known = np.maximum(size, 1)
    for k, members in enumerate(_CLASSES):
        is_member = np.zeros(256, bool)
        is_member[members] = True
        dense[:, k] = _sums(np.take(is_member, raw), at) / known
    k = len(_CLASSES)
    many = np.maximum(n, 1)
    dense[:, k] = np.log1p(size)
    dense[:, k + 1] = np.log1p(n)
    dense[:, k + 2] = distinct / many
    dense[:, k + 3] = _sums(found.end - found.start, found.first) / many
    same = np.zeros(len(found.ids), bool)
    same[1:] = (found.ids[1:] == found.ids[:-1]) & (found.rows[1:] == found.rows[:-1])
    dense[:, k + 4] = _sums(same, found.first) / many
    top = np.zeros(len(size))
    some = distinct > 0
    if some.any():
        top[some] = np.maximum.reduceat(often, first[:-1][some])
    dense[:, k + 5] = top / many
    lines = words(texts, _LINE)
    marked = np.lexsort((lines.ids, lines.rows))
    again = np.zeros(len(marked), bool)
    again[1:] = (lines.ids[marked][1:] == lines.ids[marked][:-1]) & (
        lines.rows[marked][1:] == lines.rows[marked][:-1])
    dense[:, k + 6] = _sums(again, lines.first) / np.maximum(lines.counts, 1)
    dense[:, k + 7] = np.log1p(lines.counts)
    dense[:, k + 8] = n / np.maximum(lines.counts, 1) / 100
    short = (found.end - found.start) == 1
    dense[:, k + 9] = _sums(short, found.first) / many
    return own & ((1 << HASH_BITS) - 1), first, dense


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return (total[at[1:]] - total[at[:-1]]).astype(float)


class FactorisationMachine:
    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 4):
        self.mean, self.spread = mean, spread
        size = (1 << HASH_BITS) + len(mean)
        self.bias = 0.0
        self.weights = np.zeros(size, np.float32)
        draw = np.random.Generator(np.random.PCG64(seed))
        self.factors = draw.normal(0, 0.05, (size, RANK)).astype(np.float32)

    def dense(self, statistics: np.ndarray) -> np.ndarray:
        scaled = np.clip((statistics - self.mean) / self.spread, -4, 4)
        return scaled.astype(np.float32)

    def _parts(self, hashed, first, statistics):
        """Linear part, factor sums and sums of squares of each text."""
        count = np.diff(first)
        value = (1 / np.sqrt(np.maximum(count, 1))).astype(np.float32)
        x = self.dense(statistics)
        own = slice(1 << HASH_BITS, None)
        linear, sums = x @ self.weights[own], x @ self.factors[own]
        squares = (x * x) @ (self.factors[own] ** 2)
        some = np.flatnonzero(count)
        if len(some):
            at = first[:-1][some]
            picked = self.factors[hashed]
            linear[some] += np.add.reduceat(self.weights[hashed], at) * value[some]
            sums[some] += np.add.reduceat(picked, at, axis=0) * value[some, None]
            squares[some] += np.add.reduceat(picked * picked, at, axis=0) * value[some, None] ** 2
        return linear, sums, squares, x, value

    def margin(self, hashed, first, statistics) -> np.ndarray:
        linear, sums, squares, _, _ = self._parts(hashed, first, statistics)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(*features(texts)).astype(float), -30, 30)))

    def fit(self, rows: list[np.ndarray], statistics: np.ndarray, labels: np.ndarray,
            steps: int = STEPS, rate: float = 0.1, penalty: float = 1e-4, seed: int = 4):
        draw = np.random.Generator(np.random.PCG64(seed))
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.bias = float(np.log(share / (1 - share)))
        past_w = np.full(len(self.weights), 1e-2, np.float32)
        past_v = np.full(self.factors.shape, 1e-2, np.float32)
        own = 1 << HASH_BITS
        for _ in range(-(-steps * BATCH // len(rows))):
            order = draw.permutation(len(rows))
            for low in range(0, len(order), BATCH):
                batch = order[low : low + BATCH]
                hashed = np.concatenate([rows[i] for i in batch]).astype(np.int64)
                first = np.concatenate(([0], np.cumsum([len(rows[i]) for i in batch])))
                linear, sums, squares, x, value = self._parts(hashed, first, statistics[batch])
                margin = self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)
                error = (1 / (1 + np.exp(-margin)) - labels[batch]).astype(np.float32)
                self.bias -= 0.1 * float(error.mean())
                of = np.repeat(np.arange(len(batch)), np.diff(first))
                v = value[of]
                at, where = np.unique(hashed, return_inverse=True)
                step_w = np.bincount(where, error[of] * v, len(at))
                each = (error[of] * v)[:, None] * (sums[of] - self.factors[hashed] * v[:, None])
                step_v = np.stack([np.bincount(where, each[:, k], len(at))
                                   for k in range(RANK)], axis=1)
                at = np.concatenate([at, np.arange(own, own + x.shape[1])])
                step_w = np.concatenate([step_w, error @ x]).astype(np.float32)
                dense_v = x.T @ (error[:, None] * sums) - self.factors[own:] * (
                    error @ (x * x))[:, None]
                step_v = np.concatenate([step_v, dense_v]).astype(np.float32)
                step_w += penalty * self.weights[at]
                step_v += penalty * self.factors[at]
                past_w[at] += step_w**2
                past_v[at] += step_v**2
                self.weights[at] -= rate * step_w / np.sqrt(past_w[at])
                self.factors[at] -= 0.3 * rate * step_v / np.sqrt(past_v[at])


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
          label: str = "quality", sample: int = SAMPLE) -> FactorisationMachine | None:
    """A machine from at most ``sample`` labelled documents, those of the smallest hash of
    the id. Null labels and ids are left out; an id labelled more than once has its mean
    label, at least a half counting as 1. Without labelled documents there is none."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label).alias("label")).dropna()
    known = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    known = broadcast_if_small(written(known, "fm-labels"))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(known, "id")

    def run(batches):
        for batch in slices(batches, "text"):
            hashed, first, dense = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label"),
                 pa.array([hashed[i:j].astype(np.uint32).tobytes()
                           for i, j in zip(first, first[1:])], pa.binary()),
                 pa.array([row.tobytes() for row in dense], pa.binary())],
                names=["id", "label", "words", "dense"])

    found = rows.mapInArrow(run, "id string, label int, words binary, dense binary")
    found = written(found, "fm-sample").orderBy("id", "words", "dense").limit(sample).collect()
    if not found:
        return None
    dense = np.array([np.frombuffer(r["dense"], float) for r in found])
    machine = FactorisationMachine(dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6))
    machine.fit([np.frombuffer(r["words"], np.uint32) for r in found], dense,
                np.array([r["label"] for r in found], np.float32))
    return machine


def classify(docs: DataFrame, machine: FactorisationMachine | None, text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1, higher: better) and predicted; input columns of these
    names are replaced. Null texts are scored as empty ones. Without a machine every text
    has score 0.5."""
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer")

    def run(batches):
        for batch in slices(batches, text):
            if shared.value is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                scores = shared.value.score(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores),
                 pa.array((scores >= threshold).astype(np.int32))], names=schema.names)

    return docs.mapInArrow(run, schema)
