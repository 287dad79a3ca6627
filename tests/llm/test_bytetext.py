from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from dormouse.llm.bytetext import LETTERS, NOT_BLANK, Texts, slices, windows
from tests.llm.plain import blank_words, letter_words, lower, odd_rows


def texts():
    random_ones = random.Random(1)
    letters = ["a", "B", " ", "\n", "é", "漢", ".", "7", "\x00", "😀"]
    made = ["".join(random_ones.choices(letters, k=random_ones.randint(0, 40))) for _ in range(300)]
    return [text for _, text in odd_rows()] + made


def test_words_of_every_text():
    rows = texts()
    column = Texts.of(pa.array(rows, pa.string()))
    for member, plain in ((NOT_BLANK, blank_words), (LETTERS, letter_words)):
        starts, ends = column.runs(member)
        owner = column.of_positions(starts)
        found = [[] for _ in rows]
        for text, b, e in zip(owner, starts, ends):
            found[text].append(column.data[b:e].tobytes().decode())
        assert [[lower(w) for w in ws] for ws in found] == [
            [lower(w) for w in plain(text)] for text in rows
        ]


def test_hashes_are_equal_for_equal_words_only():
    rows = ["the cat The CAT tac", "cat", "É é"]
    column = Texts.of(pa.array(rows))
    starts, ends = column.runs(NOT_BLANK)
    the, cat, the2, cat2, tac, cat3, big, small = column.hashes(starts, ends, lower=True)
    assert the == the2 and cat == cat2 == cat3 and len({the, cat, tac, big, small}) == 5
    plain = column.hashes(starts, ends)
    assert plain[0] != plain[2]


def test_windows_depend_on_order():
    a, b = np.array([1, 2, 3], np.uint64), np.array([3, 2, 1], np.uint64)
    assert windows(a, 3)[0] != windows(b, 3)[0] and len(windows(a, 4)) == 0


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(texts(), pa.string())], names=["text"])
    parts = list(slices(batch, "text", 1000))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(p.num_rows for p in parts) > 1
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_sliced_arrays_keep_their_own_bytes():
    column = Texts.of(pa.array(["aa", None, "bb", "cc"]).slice(1, 2))
    assert column.data.tobytes() == b"bb" and column.offsets.tolist() == [0, 0, 2]
