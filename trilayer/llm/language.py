"""Language identification by interpolated Kneser-Ney character models.

Characters become symbols of ``BITS`` bits, by a table that no sample changes: letters of
the basic plane are their own lower-case code points, letters beyond it are hashed to the
places of that plane without a letter, everything else is a boundary. Per language
an order-``ORDER`` model with modified counts is learned: the highest order from counts,
lower orders from the numbers of distinct left neighbours, each with its own absolute
discount, interpolated down to the uniform distribution. A model is stored as sorted
arrays of n-gram hashes with log probabilities, and of context hashes with log backoff
weights. A text belongs to the language of the lowest cross-entropy per symbol.

Rejection is calibrated on sampled documents that the models have not seen: per language
the mean cross-entropy, its spread between documents and within them set how far a text
of its length may lie above the mean.

Every language named is learned, from a sample of at most ``PER_LANGUAGE`` of its
distinct texts and, beyond the first ``LEAST`` of them, about ``CHARACTERS`` characters.
Each model is built by a task of its own and written; the driver hands them on in blocks
of at most ``LANGUAGES`` languages and about ``BLOCK_BYTES``. Each block is one pass over
the texts, which keeps the better of its own best language and that of the blocks before.
Scoring reads all rows and whole texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trilayer.llm.words import mix, runs, slices
from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

ORDER = 4
#: Bits of a symbol; four of them fill 64.
BITS = 16
SYMBOLS = 1 << BITS
#: Log probabilities kept of codes already looked up.
KEPT = 1 << 24
PER_LANGUAGE = 400
#: Characters of a language's sample, whose last text may pass them.
CHARACTERS = 1 << 20
#: Texts sampled of each language however long they are.
LEAST = 8
#: Languages of which a task holds the models at once, and their size.
LANGUAGES = 50
BLOCK_BYTES = 256 << 20
#: One in so many sampled rows calibrates instead of training.
CALIBRATE = 4
#: Standard deviations that a text may lie above its language's mean.
DEVIATIONS = 8.0
#: Characters scored at once.
PIECE = 1 << 18
UNKNOWN = "und"
#: Columns of a result.
ADDED = ("lang_pred", "score", "entropy", "rejected")

_PAD = "\n" * (ORDER - 1)
_symbols: list[np.ndarray] = []


def symbol_of() -> np.ndarray:
    """Symbol of each code point, 0 for all that are no letters."""
    if not _symbols:
        letters = np.array([p for p in range(0x110000) if chr(p).isalpha()])
        lower = np.array([ord(chr(p).lower()[0]) for p in letters], np.uint64)
        free = np.setdiff1d(np.arange(1, SYMBOLS), letters)
        hashed = free[mix(lower) % np.uint64(len(free))]
        table = np.zeros(0x110000, np.uint16)
        table[letters] = np.where(lower < SYMBOLS, lower, hashed)
        _symbols.append(table)
    return _symbols[0]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Rows and strings of about ``PIECE`` characters in all. Each string begins with the
    ORDER - 1 characters before it, padding at first; a text's last one ends in padding."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        text = _PAD + (text or "") + "\n"
        for low in range(ORDER - 1, len(text), PIECE):
            part = text[low - ORDER + 1 : low + PIECE]
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield np.array(rows), parts
                rows, parts, size = [], [], 0
    if parts:
        yield np.array(rows), parts


def grams(parts: list[str]):
    """Codes of the ORDER symbols ending at each position, and which part and whether
    the position counts: padding and all but the first of a run of boundaries do not."""
    symbols = np.take(symbol_of(), points("".join(parts)))
    code = symbols.astype(np.int64)
    whole = code.copy()
    for k in range(1, ORDER):
        whole[k:] |= code[:-k] << (BITS * k)
    sizes = np.array([len(p) for p in parts])
    first = np.cumsum(sizes) - sizes
    counts = symbols != 0
    counts[1:] |= symbols[:-1] != 0
    for k in range(ORDER - 1):
        counts[first + k] = False
    return whole, first, counts


def _counted(sample: DataFrame, function, fields: str, by: list[str]) -> DataFrame:
    """Sums of n over the rows that ``function`` makes of a language's texts."""

    def run(batches):
        for batch in slices(batches, "text"):
            names = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            for name in sorted(set(names)):
                for _, parts in pieces(list(texts[names == name])):
                    values, n = function(parts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(n), pa.string()), pa.array(values, pa.int64()),
                         pa.array(n, pa.int64())], names=["lang", "value", "n"])

    return sample.mapInArrow(run, fields).groupBy(*by).agg(F.sum("n").alias("n"))


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index in the sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    index = np.searchsorted(keys, wanted)
    index[index == len(keys)] = 0
    return index, keys[index] == wanted


def gram_hash(codes: np.ndarray, order: int) -> np.ndarray:
    return mix(codes.astype(np.uint64) ^ np.uint64(order << 56))


class KneserNey:
    """One language: per order sorted hashes with log probabilities, and contexts with
    log backoff weights."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        levels = [(codes, counts.astype(float))]
        for order in range(ORDER - 1, 0, -1):
            kinds, numbers = np.unique(self._last(levels[-1][0], order), return_counts=True)
            levels.append((kinds, numbers.astype(float)))
        self.grams, self.contexts = [], []
        lower = np.full(SYMBOLS, -np.log(SYMBOLS))
        for order, (kinds, numbers) in enumerate(reversed(levels), start=1):
            ones, twos = (numbers == 1).sum(), (numbers == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            before = self._last(kinds >> BITS, order - 1)
            at = runs(before)
            totals = np.add.reduceat(numbers, at[:-1])
            spare = discount * np.diff(at) / totals
            which = np.repeat(np.arange(len(totals)), np.diff(at))
            below = lower[kinds] if order == 1 else self.log_probability(
                self._last(kinds, order - 1), order - 1)
            logs = np.log((numbers - discount) / totals[which] + spare[which] * np.exp(below))
            self._store(self.grams, gram_hash(kinds, order), logs)
            self._store(self.contexts, gram_hash(before[at[:-1]], order), np.log(spare))

    @staticmethod
    def _last(codes: np.ndarray, order: int) -> np.ndarray:
        """Their last symbols; a shifted negative code has ones before."""
        return codes & ((1 << BITS * order) - 1)

    @staticmethod
    def _store(into: list, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        into.append((keys[order], values[order].astype(np.float32)))

    def log_probability(self, codes: np.ndarray, order: int) -> np.ndarray:
        """Of the last symbol given those before it."""
        if order == 0:
            return np.full(len(codes), -BITS * np.log(2))
        keys, values = self.grams[order - 1]
        index, known = _lookup(keys, gram_hash(codes, order))
        result = np.zeros(len(codes))
        result[known] = values[index[known]]
        rest = codes[~known]
        if len(rest):
            below = self.log_probability(self._last(rest, order - 1), order - 1)
            keys, weights = self.contexts[order - 1]
            index, seen = _lookup(keys, gram_hash(self._last(rest >> BITS, order - 1), order))
            below[seen] += weights[index[seen]]
            result[~known] = below
        return result


class Models:
    """A block of languages' models and the limits of rejection; ``more`` has the blocks of
    the languages that sort after them, as broadcasts."""

    def __init__(self, models: dict[str, KneserNey]):
        self.models = models
        self.names = sorted(models)
        self.limits: dict[str, tuple[float, float, float]] = {}
        self.more: list[Broadcast] = []
        self._keys = self._rows = None

    def __getstate__(self):
        return {**self.__dict__, "more": [], "_keys": None, "_rows": None}

    def _rows_of(self, codes: np.ndarray) -> np.ndarray:
        """Each code's log probabilities. Codes looked up are kept at the place of their
        hash, until another one takes it."""
        if self._keys is None:
            places = max(1 << 10, min(1 << 21, 1 << (KEPT // max(len(self.names), 1)).bit_length() - 1))
            self._keys = np.zeros(places, np.int64)
            self._keys[gram_hash(self._keys[:1], ORDER) & np.uint64(places - 1)] = -1
            self._rows = np.zeros((places, len(self.names)), np.float32)
        places = (gram_hash(codes, ORDER) & np.uint64(len(self._keys) - 1)).astype(np.int64)
        found = np.take(self._rows, places, axis=0)
        missing = np.flatnonzero(self._keys[places] != codes)
        if len(missing):
            new, first, which = np.unique(codes[missing], return_index=True, return_inverse=True)
            logs = [self.models[n].log_probability(new, ORDER) for n in self.names]
            logs = np.array(logs, np.float32).reshape(len(self.names), len(new)).T
            found[missing] = logs[which]
            into, one = np.unique(places[missing[first]], return_index=True)
            self._keys[into], self._rows[into] = new[one], logs[one]
        return found

    def entropies(self, texts: list[str | None]):
        """Per text: cross-entropy in nats per symbol under each language, the number of
        symbols scored, and the number of letters."""
        sums = np.zeros((len(texts), len(self.names)))
        sizes, found = np.zeros(len(texts)), np.zeros(len(texts))
        for rows, parts in pieces(texts):
            codes, first, counts = grams(parts)
            logs = self._rows_of(codes[counts])
            upto = np.concatenate(([0], np.cumsum(counts)))
            ends = np.append(first[1:], len(codes))
            lows, highs = upto[first], upto[ends]
            some = highs > lows
            if some.any():
                np.add.at(sums, rows[some], np.add.reduceat(logs, lows[some], axis=0))
            np.add.at(sizes, rows, highs - lows)
            is_letter = np.concatenate(([0], np.cumsum(codes & (SYMBOLS - 1) > 0)))
            lead = np.minimum(first + ORDER - 1, ends)
            np.add.at(found, rows, is_letter[ends] - is_letter[lead])
        return -sums / np.maximum(sizes, 1)[:, None], sizes, found

    def calibrate(self, samples: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        """``samples``: per language cross-entropies and symbols of unseen documents."""
        for name in self.names:
            values, sizes = samples.get(name, (np.zeros(0), np.zeros(0)))
            if len(values) < 2:
                self.limits[name] = (np.inf, 0.0, 0.0)
                continue
            mean = float(np.median(values))
            within = float(np.median((values - mean) ** 2 * sizes) / 0.455)
            self.limits[name] = (mean, float(values.std()), within)

    def rejects(self, name: str, entropy: float, size: float) -> bool:
        mean, between, within = self.limits.get(name, (np.inf, 0.0, 0.0))
        return entropy > mean + DEVIATIONS * np.sqrt(between**2 + within / max(size, 1))


def sample_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """At most so many distinct texts per language, those of the smallest hash; beyond the
    first ``LEAST`` only while those before have no more than ``CHARACTERS``."""
    docs = docs.filter("lang IS NOT NULL AND text IS NOT NULL").withColumn(
        "hash", F.xxhash64("text", F.lit("sample")))
    counts = docs.select("lang", "hash").distinct().groupBy("lang").agg(
        F.count("*").alias("texts"))
    counts = broadcast_if_small(written(counts, "language-texts"))
    place = F.pmod("hash", F.lit(1 << 40)) / (1 << 40)
    few = docs.withColumn("place", place).join(counts, "lang").filter(
        F.col("place") * F.col("texts") < 2 * per_language + 20
    ).groupBy("lang", "hash").agg(F.first("place").alias("place"), F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("place", "text")
    before = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    few = few.withColumn("number", F.row_number().over(order)).withColumn("before", before)
    return few.filter(
        (F.col("number") <= per_language)
        & ((F.col("number") <= LEAST) | (F.col("before") <= CHARACTERS))
    ).select("lang", "text", "number")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> Models:
    """Models of the languages that ``docs`` name. Rows without text or language are left
    out; without any there are no models, and every text is unknown."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sample = written(sample_rows(rows, per_language), "language-sample")
    built = written(_built(sample.filter(F.col("number") % CALIBRATE != 0)), "language-models")
    sizes = sorted((r["lang"], r["size"]) for r in built.select("lang", "size").collect())
    first = None
    for names in _blocks(sizes):
        block = _block(sample, built, names)
        if first is None:
            first = block
        else:
            first.more.append(docs.sparkSession.sparkContext.broadcast(block))
    return first or Models({})


def _built(train: DataFrame) -> DataFrame:
    """Rows (lang, size in bytes, model); a task holds the distinct n-grams of a language."""

    def codes(parts):
        whole, _, counts = grams(parts)
        return np.unique(whole[counts], return_counts=True)

    def build(table: pa.Table) -> pa.Table:
        values, n = (table.column(c).to_numpy() for c in ("value", "n"))
        order = np.argsort(values)
        model = pickle.dumps(KneserNey(values[order], n[order]))
        return pa.table({"lang": table.column("lang")[:1], "size": pa.array([len(model)], pa.int64()),
                         "model": pa.array([model], pa.binary())})

    counted = _counted(train, codes, "lang string, value long, n long", ["lang", "value"])
    return counted.groupBy("lang").applyInArrow(build, "lang string, size long, model binary")


def _blocks(sizes: list[tuple[str, int]]) -> Iterator[list[str]]:
    names, total = [], 0
    for name, size in sizes:
        if names and (len(names) == LANGUAGES or total + size > BLOCK_BYTES):
            yield names
            names, total = [], 0
        names.append(name)
        total += size
    if names:
        yield names


def _block(sample: DataFrame, built: DataFrame, names: list[str]) -> Models:
    rows = built.filter(F.col("lang").isin(names)).select("lang", "model").collect()
    models = Models({r["lang"]: pickle.loads(r["model"]) for r in rows})
    own = sample.filter(F.col("lang").isin(names))
    held = own.filter(F.col("number") % CALIBRATE == 0)
    values = _entropy_of_own(held, models).toPandas()
    models.calibrate({
        str(name): (part["entropy"].to_numpy(), part["size"].to_numpy())
        for name, part in values.groupby("lang")
    })
    return models


def _entropy_of_own(held: DataFrame, models: Models) -> DataFrame:
    def run(batches):
        for batch in slices(batches, "text"):
            values, sizes, _ = models.entropies(batch.column("text").to_pylist())
            names = batch.column("lang").to_pylist()
            rows = [i for i, n in enumerate(names) if n in models.names and sizes[i] >= 20]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in rows], pa.string()),
                 pa.array([values[i, models.names.index(names[i])] for i in rows], pa.float64()),
                 pa.array([sizes[i] for i in rows], pa.float64())],
                names=["lang", "entropy", "size"])

    return held.select("lang", "text").mapInArrow(
        run, "lang string, entropy double, size double"
    )


def identify(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, entropy (nats per symbol) and rejected; input columns
    of these names are replaced.

    The score is the posterior of the language at one symbol's evidence per letter, at
    most 40. Null texts and texts without a letter are ``und`` with score 0, and rejected.
    Ties go to the language that sorts first. Between blocks the rows are written.
    """
    docs = docs.drop(*ADDED)
    found = _scored(docs, docs.sparkSession.sparkContext.broadcast(models), text)
    for block in models.more:
        found = _scored(written(found, "language-block"), block, text)
    return found


def _scored(docs: DataFrame, shared: Broadcast, text: str) -> DataFrame:
    """Of a block of languages, and of those whose result is already there."""
    schema = StructType([f for f in docs.schema.fields if f.name not in ADDED])
    kept = list(schema.names)
    schema = schema.add("lang_pred", "string").add("score", "double").add(
        "entropy", "double").add("rejected", "boolean")
    again = "lang_pred" in docs.columns

    def run(batches):
        for batch in slices(batches, text):
            model = shared.value
            values, sizes, found = model.entropies(batch.column(text).to_pylist())
            names, scores, best, bad = [], [], [], []
            before = [batch.column(c).to_pylist() for c in ADDED] if again else None
            for row, (own, size, count) in enumerate(zip(values, sizes, found)):
                if not count or not model.names:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    best.append(None)
                    bad.append(True)
                    continue
                k, sharp = int(own.argmin()), min(count, 40.0)
                result = [model.names[k], 0.0, float(own[k]),
                          bool(model.rejects(model.names[k], own[k], size))]
                total = float(np.exp(-(own - own[k]) * sharp).sum())
                if again:
                    other = [column[row] for column in before]
                    gap = (other[2] - result[2]) * sharp
                    if gap <= 0:
                        total, result = 1 / other[1] + total * np.exp(gap), other
                    else:
                        total += np.exp(-gap) / other[1]
                for column, value in zip((names, best, bad), (result[0], *result[2:])):
                    column.append(value)
                scores.append(float(1 / total))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(best, pa.float64()), pa.array(bad, pa.bool_())],
                names=schema.names)

    return docs.mapInArrow(run, schema)
