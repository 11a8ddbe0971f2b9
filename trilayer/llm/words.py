"""Words of whole texts as 64-bit ids, computed with numpy over Arrow buffers.

Texts are taken as UTF-8 bytes. A word is a run of bytes outside a set of separator
bytes; bytes of multi-byte characters never separate, so byte classes equal the
character classes of the patterns in the docstrings. A-Z count as a-z on request. Equal
words have equal ids; different words differ except with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Separators of `[^\x20\x09-\x0D]+`.
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False

#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, A-Z being lower-cased first.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, 256, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
#: One odd factor for each place in a window.
_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(
    1, 1 << 63, 16, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, BLOCK), np.uint64(base))
        known[0] = 1
        known = _powers[base] = np.cumprod(known)
        if size > 4 * BLOCK:
            del _powers[base]
    return known[:size]


@dataclass
class Words:
    """Words of several texts: row ``i`` owns ``first[i]:first[i + 1]``."""

    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    raw: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, begin: int, end: int) -> bytes:
        return self.raw[self.start[begin] : self.end[end - 1]].tobytes()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the offset of each; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    size = len(texts)
    if size == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + size + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(texts: pa.Array, is_word: np.ndarray = SPACE_WORD, fold: bool = True) -> Words:
    """Words of each text. Works in blocks, so that working memory beyond the result
    stays small; a block ends at a separator or a text's end."""
    raw, at = utf8(texts)
    values = _FOLDED if fold else _BYTE
    edges = np.unique(at[:-1]) if len(at) > 1 else np.zeros(1, np.int64)
    edges = edges[edges < len(raw)]
    ids, starts, ends, low = [], [], [], 0
    while low < len(raw):
        high = min(low + BLOCK, len(raw))
        while high < len(raw):  # move the cut to a separator or the start of a text
            gap = np.flatnonzero(~is_word[raw[high : high + BLOCK]])
            cut = high + int(gap[0]) if len(gap) else min(high + BLOCK, len(raw))
            k = np.searchsorted(edges, high)
            if k < len(edges) and edges[k] <= cut:
                high = int(edges[k])
                break
            high = cut
            if len(gap):
                break
        block = raw[low:high]
        inside = np.take(is_word, block)
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        cuts = edges[np.searchsorted(edges, low, "right") : np.searchsorted(edges, high)] - low
        opens[cuts] = inside[cuts]
        closes[cuts - 1] = inside[cuts - 1]
        s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(np.take(values, block) * _power(_BASE, len(block)), out=sums[1:])
        ids.append(mix((sums[e] - sums[s]) * _power(_INVERSE, len(block))[s]))
        starts.append(s + low)
        ends.append(e + low)
        low = high
    if not ids:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(at), np.int64), raw)
    start = np.concatenate(starts)
    return Words(
        np.concatenate(ids), start, np.concatenate(ends), np.searchsorted(start, at), raw
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20):
    """Row slices of the batches with about ``limit`` bytes of text each, one row at least."""
    for batch in batches:
        _, at = utf8(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
            yield batch.slice(low, high - low)
            low = high


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end of the last."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    new = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.concatenate(([0], new, [len(sorted_values)]))


def windows(found: Words, width: int, short_whole: bool = True):
    """Ids of all runs of ``width`` words within a text, and the text of each.

    A text of fewer words, but not none, has one id for its whole sequence if
    ``short_whole``. Returns ids, rows and the position of each window's first word.
    """
    n = len(found.ids)
    rows = found.rows
    left = found.first[1:][rows] - np.arange(n)  # words from here to the end of the text
    total = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        step = found.ids[k:] * _FACTORS[k % len(_FACTORS)]
        step[left[: n - k] <= k] = 0
        total[: n - k] += step
        if k % len(_FACTORS) == len(_FACTORS) - 1:
            total = mix(total)
    keep = left >= width
    if short_whole:
        keep |= (left == found.counts[rows]) & (left < width)
    at = np.flatnonzero(keep)
    return mix(total[at]), rows[at], at
