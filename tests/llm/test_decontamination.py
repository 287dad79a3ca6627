from __future__ import annotations

import numpy as np

from pyspark import SparkContext
from pyspark.core.broadcast import Broadcast

from dormouse.llm import decontamination as d
from tests.llm.plain import letter_words, odd_rows, table


def plain(text, items, size):
    words = letter_words(text)
    hit, found = set(), set()
    for key, item in items:
        own = letter_words(item)
        if key is None or not own:
            continue
        for at in range(max(1, len(own) - size + 1)):
            window = own[at : at + size]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(str(key))
    return len(words), sorted(hit), sorted(found)


ITEMS = [(1, "a b c d e f"), (10, "C d, e!"), (2, None), (3, ""), (None, "x y z"), (4, "q"), (4, "r s t u"), (1, "a b c d e f")]
TEXTS = [
    (20, "zz a b c d e f zz q"), (21, "a b c d e"), (22, "A-B-C d e f a b c d e f"), (23, "q q q"), (24, "x y z"),
    (25, "r s t u r s t u"), (26, "b c d E"), (27, "é q ä"),
]


def test_equals_the_plain_version_in_one_block_and_in_many(spark, tmp_path):
    rows = TEXTS + odd_rows()
    docs = table(spark, tmp_path, rows, files=2, extra=True)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block_bytes in (1 << 20, 4):
        found = d.marked(docs, "text", items, "item_id", "text", "found", size=4, block_bytes=block_bytes)
        assert found.columns == [*docs.columns, "found"]
        got = sorted(
            (
                (r.doc_id, r.found.n_words, [w for h in r.found.hit_words for w in range(h.begin, h.end)], r.found["items"])
                for r in found.collect()
            ),
            key=repr,
        )
        assert got == sorted(((k, *plain(t, ITEMS, 4)) for k, t in rows), key=repr)


def test_spans_are_taken_out_and_nothing_else(spark, tmp_path):
    rows = [(1, "Ä. a b, C d! rest"), (2, "clean text"), (3, None), (4, "a b c d a b c d"), (5, "")]
    docs = table(spark, tmp_path, rows, extra=True)
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    out = d.decontaminated(docs, "text", items, "item_id", "text")
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Ä.  ! rest", 2: "clean text", 3: None, 4: " ", 5: ""}


def test_empty_tables(spark, tmp_path):
    docs = table(spark, tmp_path, TEXTS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.decontaminated(docs, "text", none, "item_id", "text").count() == len(TEXTS)
    assert d.marked(docs.where("false"), "text", none, "item_id", "text", "f").count() == 0


def test_index_finds_all_places():
    rng = np.random.default_rng(4)
    for symbols, count in ((3, 400), (20, 400), (2, 1), (5, 0)):
        sequence = rng.integers(1, symbols, count) if count else np.zeros(0, np.int64)
        index = d.FMIndex(sequence, symbols)
        phrases = rng.integers(1, symbols, (60, 4))
        lengths = rng.integers(1, 5, 60)
        phrases[np.arange(4) >= lengths[:, None]] = 0
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high):
            places = sorted(index.locate(np.arange(a, max(a, b))).tolist())
            assert places == [i for i in range(count - n + 1) if (sequence[i : i + n] == p[:n]).all()]


def test_wavelet_ranks():
    sequence = np.random.default_rng(5).integers(0, 11, 300)
    tree = d.WaveletMatrix(sequence, 11)
    at = np.arange(301)
    for symbol in range(11):
        wanted = np.concatenate(([0], np.cumsum(sequence == symbol)))
        assert (tree.rank(np.full(301, symbol), at) == wanted).all()
    assert (tree.symbol(np.arange(300)) == sequence).all()


def test_blocks_are_held_one_at_a_time(spark, tmp_path, monkeypatch):
    live, most = set(), []
    send, destroy = SparkContext.broadcast, Broadcast.destroy

    def sent(self, value):
        made = send(self, value)
        live.add(id(made))
        most.append(len(live))
        return made

    def destroyed(self, blocking=False):
        live.discard(id(self))
        destroy(self, blocking)

    monkeypatch.setattr(SparkContext, "broadcast", sent)
    monkeypatch.setattr(Broadcast, "destroy", destroyed)
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(20)], "item_id long, text string")
    rows = [(i, f"x a{i} b{i} c{i} y") for i in range(30)]
    found = d.marked(table(spark, tmp_path, rows), "text", items, "item_id", "text", "found", block_bytes=9)
    assert len(most) >= 15 and max(most) == 1
    assert {r.doc_id: r.found["items"] for r in found.collect()} == {i: [str(i)] if i < 20 else [] for i in range(30)}
