"""Periodic runs of words: stretches that repeat one period several times over.

Runs are found by suffix trees. Ukkonen's algorithm builds the tree of a word sequence and
that of its reversal; the Euler tour of each, reduced to the shallowest node between
neighbouring leaves, gives the lowest common ancestor of two leaves, and with it the
longest common extension of two positions, in constant time. Every run contains the
longest Lyndon word that begins at one of its positions, under one of two opposite orders
of the alphabet. So each position offers two candidate roots, which are extended to the
right and to the left.

Most texts have no runs. Trees are therefore built only for stretches that can hold one: in
a run of period q every word, and every window of words, that follows the first q words
has an earlier occurrence at most q words back. Stretches where that holds for long enough
are cut out, with margins, so that every run lies wholly in one of them.

A tree takes some 300 bytes per word of the longest such stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.llm.words import Words, slices, windows, words

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words of a window; periods up to it are looked for by single words.
WINDOW = 8


class SuffixTree:
    """Ukkonen's tree of a sequence of symbols from 1 on; 0 is put at its end."""

    def __init__(self, symbols: list[int]):
        s = self.symbols = [*symbols, 0]
        n, width = len(s), max(s) + 1
        start, stop, link, leaf = [0], [0], [0], [-1]
        edge: dict[int, int] = {}
        node = length = at = rest = 0
        for i, c in enumerate(s):
            rest += 1
            last = 0
            while rest:
                if not length:
                    at = i
                key = node * width + s[at]
                child = edge.get(key)
                if child is None:
                    edge[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    leaf.append(i - rest + 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    first = start[child]
                    size = min(stop[child], i + 1) - first
                    if length >= size:
                        at += size
                        length -= size
                        node = child
                        continue
                    if s[first + length] == c:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    split = len(start)
                    edge[key] = split
                    start.extend((first, i))
                    stop.extend((first + length, n))
                    link.extend((0, 0))
                    leaf.extend((-1, i - rest + 1))
                    start[child] = first + length
                    edge[split * width + s[first + length]] = child
                    edge[split * width + c] = split + 1
                    if last:
                        link[last] = split
                    last = split
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - rest + 1
        keys = np.fromiter(edge.keys(), np.int64, len(edge))
        order = np.argsort(keys)
        self._children = np.fromiter(edge.values(), np.int64, len(edge))[order].tolist()
        parents = keys[order] // width
        self._first = np.searchsorted(parents, np.arange(len(start) + 1)).tolist()
        self._start, self._stop, self._leaf = start, stop, leaf

    def tour(self, opposite: bool = False) -> tuple[list[int], list[int]]:
        """Suffixes in the order of the leaves, and the depth of the shallowest node that
        an Euler tour passes between each leaf and the one before. ``opposite`` turns the
        order of the symbols; the end still comes first."""
        start, stop, leaf, first, children = (
            self._start, self._stop, self._leaf, self._first, self._children)
        suffixes, between = [], []
        todo = [(0, 0, 0)]
        while todo:
            node, depth, via = todo.pop()
            if leaf[node] >= 0:
                suffixes.append(leaf[node])
                between.append(via)
                continue
            below = children[first[node] : first[node + 1]]
            if opposite:
                head = 1 if leaf[below[0]] >= 0 and self.symbols[start[below[0]]] == 0 else 0
                below = below[:head] + below[head:][::-1]
            for child in below[:0:-1]:
                todo.append((child, depth + stop[child] - start[child], depth))
            child = below[0]
            todo.append((child, depth + stop[child] - start[child], via))
        return suffixes, between


class Extensions:
    """Longest common extensions of pairs of positions, each in constant time."""

    def __init__(self, suffixes: list[int], between: list[int]):
        n = len(suffixes)
        self.rank = np.empty(n, np.int64)
        self.rank[suffixes] = np.arange(n)
        self.levels = [np.array(between, np.int32)]
        step = 1
        while 2 * step <= n:
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that the different suffixes at ``i`` and ``j`` have in common."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        found = np.zeros(len(low), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            values = self.levels[k]
            found[at] = np.minimum(values[low[at]], values[high[at] - (1 << k) + 1])
        return found


def _lyndon_ends(rank: list[int]) -> list[int]:
    """Where the longest Lyndon word from each position ends: at the next smaller suffix."""
    n = len(rank)
    ends, later = [n] * n, []
    for i in range(n - 1, -1, -1):
        while later and rank[later[-1]] > rank[i]:
            later.pop()
        if later:
            ends[i] = later[-1]
        later.append(i)
    return ends


def tree_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
    """Runs of a sequence as rows (start, length, period), by start, then period.
    ``min_exponent`` is 2 or more."""
    n = len(ids)
    symbols = np.unique(ids, return_inverse=True)[1].reshape(-1) + 1
    tree = SuffixTree(symbols.tolist())
    forward = Extensions(*tree.tour())
    other = np.empty(n + 1, np.int64)
    other[tree.tour(opposite=True)[0]] = np.arange(n + 1)
    del tree
    backward = Extensions(*SuffixTree(symbols[::-1].tolist()).tour())
    found = []
    for rank in (forward.rank, other):
        i = np.arange(n)
        j = np.array(_lyndon_ends(rank[:n].tolist()), np.int64)
        end = j + forward.common(i, j)
        start = i - backward.common(n - i, n - j)
        long = (end - start >= min_length) & (end - start >= min_exponent * (j - i))
        found.append(np.stack((start, end - start, j - i), axis=1)[long])
    return np.unique(np.concatenate(found), axis=0)[:, [0, 1, 2]] if n else np.zeros((0, 3), np.int64)


def _back(ids: np.ndarray, rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` positions, how far back its id occurred before in its row;
    ``size + 1`` if it did not."""
    back = np.full(size, size + 1, np.int64)
    order = np.argsort(ids, kind="stable")
    i, r, p = ids[order], rows[order], at[order]
    again = np.flatnonzero((i[1:] == i[:-1]) & (r[1:] == r[:-1])) + 1
    back[p[again]] = p[again] - p[again - 1]
    return back


def stretches(found: Words, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """(begin, end) of the stretches of words outside which there is no run."""
    n = len(found.ids)
    longest = int(found.counts.max(initial=0))
    word_back = _back(found.ids, found.rows, np.arange(n), n)
    ids, rows, at = windows(found, WINDOW, short_whole=False)
    window_back = _back(ids, rows, at, n)
    spans, low = [], 1
    while min_exponent * low <= longest:
        high = 2 * low - 1  # periods low .. high
        by_word = high <= WINDOW
        margin = 0 if by_word else WINDOW - 1
        back = word_back if by_word else window_back
        least = max(min_length - high, (min_exponent - 1) * low) - margin
        near = np.concatenate(([False], back <= high, [False]))
        edge = np.flatnonzero(near[1:] != near[:-1])
        begin, end = edge[::2], edge[1::2]
        keep = end - begin >= max(least, 1)
        spans.append(np.stack((begin[keep] - high, end[keep] + margin), axis=1))
        low = high + 1
    spans = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
    if not len(spans):
        return spans
    row = np.searchsorted(found.first, spans[:, 1] - 1, "right") - 1
    spans[:, 0] = np.maximum(spans[:, 0], found.first[row])
    spans[:, 1] = np.minimum(spans[:, 1], found.first[row + 1])
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    # Texts that follow each other stay apart, though one stretch may end where one begins.
    row = np.searchsorted(found.first, spans[:, 0], "right")
    new = np.ones(len(spans), bool)
    new[1:] = (spans[1:, 0] > reach[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return np.stack((spans[first, 0], np.maximum.reduceat(spans[:, 1], first)), axis=1)


def word_runs(found: Words, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
    """Runs of all texts as rows (start, length, period), ``start`` counting the words of
    all texts, in order."""
    parts = [np.zeros((0, 3), np.int64)]
    for begin, end in stretches(found, min_length, min_exponent).tolist():
        runs = tree_runs(found.ids[begin:end], min_length, min_exponent)
        parts.append(runs + np.array([begin, 0, 0]))
    return np.concatenate(parts)


def collapsed(found: Words, runs: np.ndarray) -> pa.Array:
    """The words of each text without those that a run repeats, joined by one space."""
    n = len(found.ids)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth)[:n] == 0)
    size = found.end[kept] - found.start[kept] + 1
    ends = np.cumsum(size)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(found.start[kept] - (ends - size), size)
    data = np.append(found.raw, np.uint8(32))[source]
    data[ends - 1] = 32
    upto = np.concatenate(([0], ends))[np.searchsorted(kept, found.first)]
    low, high = upto[:-1], np.maximum(upto[:-1], upto[1:] - 1)
    whole = data.tobytes()
    texts = [whole[i:j] for i, j in zip(low.tolist(), high.tolist())]
    return pa.array(texts, pa.binary()).cast(pa.string())


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def find_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
              min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row of ``docs``: the id, n_words, runs (array of start, length and period, by
    start, then period) and the collapsed text.

    A run is a stretch of words with smallest period ``period``, at least ``min_length``
    words and ``min_exponent`` periods long, that no neighbouring word extends; starts are
    word numbers. A word that a run contains after its first period is not in the collapsed
    text. A null text has no words, like an empty one; repeated rows and ids are kept as
    they are; other columns are ignored. Texts are taken whole, long ones one at a time.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), fold=False)
            runs = word_runs(found, min_length, min_exponent)
            first = np.searchsorted(runs[:, 0], found.first)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            values = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - found.first[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                names=["start", "length", "period"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found.counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), values),
                 collapsed(found, runs)],
                names=["id", "n_words", "runs", "collapsed"],
            )

    return rows.mapInArrow(
        run, f"id {kind}, n_words long, runs array<{RUN}>, collapsed string"
    ).withColumnRenamed("id", id_column)
