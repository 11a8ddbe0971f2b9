from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from trilayer.llm import words as module
from trilayer.llm.words import ALNUM_WORD, SPACE_WORD, slices, windows, words

PATTERNS = ((SPACE_WORD, r"[^\x20\x09-\x0D]+"), (ALNUM_WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbZ1é漢 \n\t.,-", max_size=40)), max_size=8),
       st.sampled_from([1, 3, 7, 1 << 20]))
def test_words_equal_the_pattern(texts, block):
    old, module.BLOCK = module.BLOCK, block
    try:
        for is_word, pattern in PATTERNS:
            found = words(pa.array(texts, pa.string()), is_word)
            own = [re.findall(pattern, lowered(t)) for t in texts]
            assert found.counts.tolist() == [len(o) for o in own]
            flat = [w for o in own for w in o]
            assert [lowered(found.text(i, i + 1).decode()) for i in range(len(flat))] == flat
            ids = dict(zip(flat, found.ids.tolist()))
            assert [ids[w] for w in flat] == found.ids.tolist()
            assert len(set(ids.values())) == len(ids)
    finally:
        module.BLOCK = old


def test_windows_of_each_text():
    texts = ["a b c d", "a b", None, "a b c x", "b c d"]
    found = words(pa.array(texts))
    ids, rows, at = windows(found, 3)
    assert rows.tolist() == [0, 0, 1, 3, 3, 4]
    assert at.tolist() == [0, 1, 4, 6, 7, 10]
    assert ids[0] == ids[3] and ids[1] == ids[5] and len(np.unique(ids)) == 4
    assert len(windows(found, 3, short_whole=False)[0]) == 5
    assert len(windows(found, 40)[0]) == 4


def test_slices_keep_rows_and_order():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 5, None, "y" * 50, "", "z"] * 3})
    parts = list(slices(iter([batch]), "t", 12))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert max(len(p.column("t").to_pylist()) for p in parts) < 15


def test_long_single_word_and_text():
    found = words(pa.array(["w" * (3 << 20), "a " * (1 << 20)]))
    assert found.counts.tolist() == [1, 1 << 20]
    assert len(np.unique(found.ids)) == 2
