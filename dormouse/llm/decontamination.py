"""Benchmark decontamination: an FM-index over each shard of documents, searched for test phrases.

A shard is a run of rows within a task. Its words become numbers; words that no test phrase has
cannot take part in a match, so they only end runs, and runs shorter than the shortest phrase are
left out. Over what remains stand a suffix array, its Burrows-Wheeler transform in a wavelet
matrix, and every 16th suffix position. Phrases are found by backward search and located by walking
to a sampled position. Nothing is shuffled, so no phrase or document can make a task hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.llm.bytetext import LETTERS, Texts, slices
from dormouse.llm.spread import all_columns, free_name, in_tasks, kept, named, quoted, undotted

WINDOW_WORDS = 10
SAMPLED_SUFFIXES = 16
# Test phrases are broadcast in blocks of about this many bytes of text, one block after the other.
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 2 << 20

_RESULT = (
    "struct<n_words:bigint,spans:array<struct<begin:int,end:int>>,items:array<string>,"
    "hit_words:array<struct<begin:int,end:int>>>"
)


@dataclass
class Phrases:
    """Distinct windows of the items of one block, as numbers of words (2 and up)."""

    words: np.ndarray  # sorted hashes
    windows: np.ndarray  # one row each, padded by 0
    lengths: np.ndarray
    item_starts: np.ndarray  # the items of window w: items[item_starts[w]:item_starts[w + 1]]
    items: np.ndarray

    @classmethod
    def of(cls, ids: list[str], column: list[str], size: int) -> Phrases:
        texts = Texts.of(pa.array(column, pa.string()))
        starts, ends = texts.runs(LETTERS)
        hashes = texts.hashes(starts, ends, lower=True)
        words, numbers = np.unique(hashes, return_inverse=True)
        owner = texts.of_positions(starts)
        made: dict[tuple[int, ...], set[int]] = {}
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        for item in range(len(texts)):
            own = numbers[bounds[item] : bounds[item + 1]] + 2
            for at in range(max(1, len(own) - size + 1) if len(own) else 0):
                made.setdefault(tuple(own[at : at + size].tolist()), set()).add(item)
        table = np.zeros((len(made), size), np.int32)
        for row, window in enumerate(made):
            table[row, : len(window)] = window
        held = [sorted(s) for s in made.values()]
        return cls(
            words,
            table,
            (table > 0).sum(axis=1),
            np.concatenate(([0], np.cumsum([len(s) for s in held], dtype=np.int64))),
            np.array([ids[i] for s in held for i in s], dtype=object),
        )


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit row for each binary digit, most significant first."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.digits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for digit in reversed(range(self.digits)):
            bit = (sequence >> digit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            sequence = np.concatenate((sequence[bit == 0], sequence[bit == 1]))

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        start, end = np.zeros_like(position), position
        for level in range(self.digits):
            ones, zeros = self.ones[level], self.zeros[level]
            bit = ((symbol >> (self.digits - 1 - level)) & 1).astype(bool)
            start = np.where(bit, zeros + ones[start], start - ones[start])
            end = np.where(bit, zeros + ones[end], end - ones[end])
        return end - start

    def symbol(self, position: np.ndarray) -> np.ndarray:
        found = np.zeros_like(position)
        for level in range(self.digits):
            ones, zeros = self.ones[level], self.zeros[level]
            bit = ones[position + 1] - ones[position]
            found = 2 * found + bit
            position = np.where(bit == 1, zeros + ones[position], position - ones[position])
        return found


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling. A suffix comes before its extensions."""
    count = len(sequence)
    rank = np.unique(sequence, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        after = np.zeros(count, np.int64)
        after[: max(0, count - step)] = rank[step:]
        key = rank * np.int64(count + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(count, np.int64)
        rank[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        if count == 0 or rank[order[-1]] == count:
            return order
        step *= 2


class FMIndex:
    """Backward search in a sequence of numbers from 1 to ``symbols`` - 1; 0 is put at its end."""

    def __init__(self, sequence: np.ndarray, symbols: int, sampled: int = SAMPLED_SUFFIXES):
        ended = np.concatenate((sequence, [0])).astype(np.int64)
        suffixes = suffix_array(ended)
        self.count = len(ended)
        self.tree = WaveletMatrix(ended[suffixes - 1], symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(ended, minlength=symbols))))
        self.marked = suffixes % sampled == 0
        self.marks = np.concatenate(([0], np.cumsum(self.marked)))
        self.positions = suffixes[self.marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row, and row after the last, of the suffixes that begin with each phrase."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.count, np.int64)
        for column in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((column < lengths) & (low < high))
            symbol = phrases[live, column].astype(np.int64)
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position in the sequence of the suffix in each row."""
        found = np.zeros(len(rows), np.int64)
        at, live = rows.copy(), np.arange(len(rows))
        steps = 0
        while len(live):
            known = self.marked[at]
            found[live[known]] = self.positions[self.marks[at[known]]] + steps
            live, at = live[~known], at[~known]
            symbol = self.tree.symbol(at)
            at = self.before[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return found


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1 and so on for counts[0] numbers, then those of starts[1]."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def find(texts: Texts, phrases: Phrases) -> tuple[np.ndarray, ...]:
    """Of a shard: words' starts, ends and texts, which words are hit, and (text, item) found."""
    starts, ends = texts.runs(LETTERS)
    owner = texts.of_positions(starts)
    hit = np.zeros(len(starts) + 1, np.int64)
    nothing = np.zeros(0, np.int64), np.zeros(0, object)
    if not len(phrases.windows) or not len(starts):
        return starts, ends, owner, hit[:-1] > 0, *nothing
    hashes = texts.hashes(starts, ends, lower=True)
    number = np.minimum(np.searchsorted(phrases.words, hashes), len(phrases.words) - 1)
    known = phrases.words[number] == hashes
    # Runs of known words within a text that can hold the shortest phrase, each ended by symbol 1.
    opens = known.copy()
    opens[1:] &= ~known[:-1] | (owner[1:] != owner[:-1])
    closes = known.copy()
    closes[:-1] &= ~known[1:] | (owner[1:] != owner[:-1])
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    long = last - first + 1 >= phrases.lengths.min()
    first, last = first[long], last[long]
    where = _ranges(first, last - first + 2)  # the word after a run stands for its end
    if not len(where):
        return starts, ends, owner, hit[:-1] > 0, *nothing
    sequence = np.where(
        np.isin(np.arange(len(where)), np.cumsum(last - first + 2) - 1),
        1,
        number[np.minimum(where, len(number) - 1)] + 2,
    )
    index = FMIndex(sequence, len(phrases.words) + 2)
    low, high = index.search(phrases.windows, phrases.lengths)
    rows = _ranges(low, np.maximum(0, high - low))
    window = np.repeat(np.arange(len(low)), np.maximum(0, high - low))
    at = where[index.locate(rows)]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + phrases.lengths[window], -1)
    pairs = np.unique(np.stack((owner[at], window), axis=1), axis=0)
    held = phrases.item_starts[pairs[:, 1] + 1] - phrases.item_starts[pairs[:, 1]]
    items = phrases.items[_ranges(phrases.item_starts[pairs[:, 1]], held)]
    return starts, ends, owner, np.cumsum(hit)[:-1] > 0, np.repeat(pairs[:, 0], held), items


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    """Spans in order, those that touch or overlap made one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [{"begin": b, "end": e} for b, e in out]


def _results(column: pa.Array, phrases: Phrases, before: list | None) -> list[dict]:
    texts = Texts.of(column)
    starts, ends, owner, hit, doc, items = find(texts, phrases)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    results = [
        {"n_words": int(n), "spans": [], "items": [], "hit_words": []} for n in np.diff(bounds)
    ]
    if before is not None:
        results = before
    change = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    spans: dict[int, list[tuple[int, int]]] = {}
    for first, after in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1)):
        while first < after:  # a run of hit words may reach over texts
            text = int(owner[first])
            stop = min(int(after), int(bounds[text + 1]))
            spans.setdefault(text, []).append((int(first), stop))
            first = stop
    found: dict[int, set[str]] = {}
    for text, item in zip(doc.tolist(), items.tolist()):
        found.setdefault(text, set()).add(item)
    for text, own in spans.items():
        r, base = results[text], int(bounds[text])
        own = [(b - base, e - base) for b, e in own]
        r["hit_words"] = _merged([(h["begin"], h["end"]) for h in r["hit_words"]] + own)
        r["items"] = sorted({*r["items"], *found.get(text, ())})
        begin, data = int(texts.offsets[text]), texts.data
        r["spans"] = [
            {
                "begin": int(np.count_nonzero((data[begin : starts[base + h["begin"]]] & 0xC0) != 0x80)),
                "end": int(np.count_nonzero((data[begin : ends[base + h["end"] - 1]] & 0xC0) != 0x80)),
            }
            for h in r["hit_words"]
        ]
    return results


def marked(
    documents: DataFrame,
    text: str,
    benchmark: DataFrame,
    item: str,
    item_text: str,
    result: str,
    size: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All columns of the documents, and a struct ``result`` about test phrases in the text.

    It holds ``n_words``, the merged ``spans`` of code points to remove (end exclusive), the
    ``items`` found as sorted strings, and the same spans counted in words (``hit_words``).
    A window of an item is ``size`` words in a row, or all of an item that has fewer. An item
    without id or text, or without words, has no windows. A null or empty document has no words.
    Repeated rows get the same result each; a column named like ``result`` is replaced.

    The benchmark is taken in blocks of about ``block_bytes`` of text. However many there are, tasks and
    driver hold one at a time; between two blocks the rows are kept.
    """
    rows = documents.drop(result)
    items = benchmark.select(F.col(item).cast("string").alias("id"), F.col(item_text).alias("text"))
    items = items.where(F.col("id").isNotNull() & F.col("text").isNotNull()).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    rows, names = undotted(rows)
    schema = f"{named(rows)}, {quoted(result)} {_RESULT}"
    marked_rows = rows
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        phrases = documents.sparkSession.sparkContext.broadcast(
            Phrases.of([r.id for r in own], [r.text for r in own], size)
        )
        marked_rows = in_tasks(marked_rows, _search(names[text], result, phrases), schema)
        if block + 1 < blocks:
            # Each block is a job of its own, after which tasks hold no phrases of it any more.
            marked_rows = kept(marked_rows)
            phrases.destroy()
    return marked_rows.toDF(*names, result)


def _search(text: str, result: str, phrases):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SHARD_BYTES):
                before = part.column(result).to_pylist() if result in part.schema.names else None
                found = _results(part.column(text), phrases.value, before)
                names = [n for n in part.schema.names if n != result]
                kind = pa.struct(
                    [
                        ("n_words", pa.int64()),
                        ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                        ("items", pa.list_(pa.string())),
                        ("hit_words", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                    ]
                )
                arrays = [part.column(n) for n in names] + [pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, result])

    return search


def hit_count(result: str) -> Column:
    return F.aggregate(
        f"{result}.hit_words", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"]
    )


def without_spans(text: Column, spans: Column) -> Column:
    """The text without its spans of code points; one blank stands where a span was."""
    begun = F.concat(F.lit([0]).cast("array<int>"), F.transform(spans, lambda s: s["end"]))
    ended = F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.char_length(text)))
    pieces = F.transform(
        F.arrays_zip(begun.alias("b"), ended.alias("e")),
        lambda p: F.substring(text, p["b"] + 1, p["e"] - p["b"]),
    )
    return F.when(F.size(spans) > 0, F.array_join(pieces, " ")).otherwise(text)


def decontaminated(
    documents: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str
) -> DataFrame:
    """The documents with benchmark passages taken out of their text; other columns as they are.

    Documents without a passage come out unchanged, and a null text stays null.
    """
    result = free_name(documents, "_found")
    rows = marked(documents, text, benchmark, item, item_text, result)
    spans = F.col(f"{result}.spans")
    return rows.withColumn(text, without_spans(F.col(text), spans)).select(*all_columns(documents))
