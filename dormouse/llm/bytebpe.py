"""Byte-level BPE: boundaries by a scan of transition functions, cached merges of the slices, decoding.

Each code point becomes a symbol that already knows what follows it. A symbol is a function from
state to state of a small automaton; functions compose associatively, so prefixes of a long text are
composed block by block, all blocks at a time, and the state before every code point follows. No
regular expression runs and no loop goes over characters.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dormouse.llm.bytetext import Texts, slices
from dormouse.llm.spread import in_tasks, named, quoted, undotted

# Symbols of a code point.
LETTER, NUMBER, OTHER, JOINING_BLANK, LAST_BLANK, BLANK, QUOTE_1, QUOTE_2, END = range(9)
# States: between slices; in a run of letters, numbers, others; after a blank that joins what
# follows; in a run of blanks; with one or two letters of a contraction to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, JOINING, IN_BLANKS, ONE_MORE, TWO_MORE = range(8)

# The code points of Unicode's White_Space property.
WHITE_SPACE = [
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0020, 0x0085, 0x00A0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# Endings that a slice of their own begins with an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ["re", "ve", "ll"]

# Pieces that are longer are merged one by one with a heap; pieces kept at a time by each task.
LONG_PIECE_BYTES = 128
CACHED_PIECES = 1 << 19
BLOCK = 64


@cache
def _classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BLANK of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    table[WHITE_SPACE] = BLANK
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a slice begins at it."""
    if state == ONE_MORE:
        return FRESH, False
    if state == TWO_MORE:
        return ONE_MORE, False
    if symbol == END:
        return FRESH, True
    if symbol in (QUOTE_1, QUOTE_2) and state not in (IN_OTHER, JOINING):
        return (ONE_MORE if symbol == QUOTE_1 else TWO_MORE), True
    if symbol == JOINING_BLANK:
        return JOINING, True
    if symbol == LAST_BLANK:
        return FRESH, True
    if symbol == BLANK:
        return IN_BLANKS, state != IN_BLANKS
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(symbol, IN_OTHER)
    return run, state not in (run, JOINING)


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all functions that symbols compose to: each symbol's, composition, values; and begins."""
    symbols = [tuple(_step(s, c)[0] for s in range(8)) for c in range(9)]
    numbers: dict[tuple[int, ...], int] = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    while todo:
        f = todo.pop()
        for g in symbols:
            made = tuple(g[x] for x in f)
            if made not in numbers:
                numbers[made] = len(numbers)
                todo.append(made)
    known = list(numbers)
    values = np.array(known, np.uint8)
    composed = np.array([[numbers[tuple(g[x] for x in f)] for g in known] for f in known], np.uint16)
    begins = np.array([[_step(s, c)[1] for c in range(9)] for s in range(8)])
    return np.array([numbers[s] for s in symbols], np.uint16), composed, values, begins


def _prefixes(functions: np.ndarray, composed: np.ndarray) -> np.ndarray:
    """The composition of all functions up to and with each; by blocks, then over the blocks."""
    count = len(functions)
    if count <= BLOCK:
        out = functions.copy()
        for i in range(1, count):
            out[i] = composed[out[i - 1], out[i]]
        return out
    blocks = -(-count // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint16)
    padded[:count] = functions
    table = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    flat, width = composed.ravel(), np.int32(composed.shape[1])
    for i in range(1, BLOCK):
        table[i] = flat[table[i - 1] * width + table[i]]
    before = np.zeros(blocks, np.uint16)
    before[1:] = _prefixes(table[-1], composed)[:-1]
    return flat[before * width + table].T.ravel()[:count]


def slice_starts(texts: Texts) -> np.ndarray:
    """Byte positions where slices begin, in order; the slices of a text cover it wholly."""
    data = texts.data
    if not len(data):
        return np.zeros(0, np.int64)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    # One place more after each text, which holds its end.
    at = np.arange(len(first)) + texts.of_positions(first)
    size = len(first) + len(texts)
    padded = np.zeros(size + 2, np.uint32)
    padded[at] = points
    symbols = np.full(size + 2, END, np.uint8)
    symbols[at] = _classes()[points]
    blank = symbols == BLANK
    ends_blanks = blank[:-1] & ~blank[1:] & (symbols[1:] != END)
    space = padded[:-1] == 0x20
    symbols[:-1][ends_blanks & space] = JOINING_BLANK
    symbols[:-1][ends_blanks & ~space] = LAST_BLANK
    quotes = np.flatnonzero(padded[:-2] == 0x27)
    one, two = padded[quotes + 1], padded[quotes + 2]
    short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
    long = np.zeros(len(quotes), bool)
    for a, b in LONG_ENDINGS:
        long |= (one == ord(a)) & (two == ord(b))
    symbols[quotes[short]] = QUOTE_1
    symbols[quotes[long]] = QUOTE_2
    symbols = symbols[:size]
    of_symbol, composed, values, begins = _functions()
    state = np.full(size, FRESH, np.uint8)
    state[1:] = values[_prefixes(of_symbol[symbols], composed)[:-1], FRESH]
    return first[begins[state[at], symbols[at]]]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of each range, range after range."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Ranks:
    """A vocabulary of byte strings with ranks, as numbered in a rank file."""

    def __init__(self, file: bytes):
        pairs = [line.split() for line in file.splitlines() if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = [b""] * (max(self.rank.values(), default=-1) + 1)
        for token, rank in self.rank.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        made = [
            (self.rank[t[:i]] << 32 | self.rank[t[i:]], rank)
            for t, rank in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        ]
        self.none = np.int64(len(tokens))
        self._hashed(np.array([k for k, _ in made], np.int64), np.array([r for _, r in made], np.int64))
        decimal = [f"{r},".encode() for r in range(len(tokens))]
        self.decimal_lengths = np.array([len(d) for d in decimal], np.int64)
        width = max(map(len, decimal), default=1)
        self.decimal = np.frombuffer(b"".join(d.ljust(width) for d in decimal), np.uint8).reshape(-1, width)

    def _hashed(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Pairs and their merged ranks, in a table with free places after occupied ones."""
        self.bits = max(4, int(len(keys) * 6).bit_length())
        size = 1 << self.bits
        self.keys, self.merged = np.full(size, -1, np.int64), np.full(size, self.none, np.int64)
        place = self._place(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[place[todo]] == -1]
            self.keys[place[free]] = keys[free]
            won = self.keys[place[todo]] == keys[todo]
            self.merged[place[todo[won]]] = ranks[todo[won]]
            todo = todo[~won]
            place[todo] = (place[todo] + 1) & (size - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's union, ``none`` where the vocabulary has none."""
        keys = left << 32 | right
        place = self._place(keys)
        out = self.merged[place]
        found = self.keys[place]
        todo = np.flatnonzero((found != keys) & (found != -1))
        out[found != keys] = self.none
        while len(todo):
            place[todo] = (place[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[place[todo]]
            out[todo[found == keys[todo]]] = self.merged[place[todo[found == keys[todo]]]]
            todo = todo[(found != keys[todo]) & (found != -1)]
        return out

    def merge_one(self, piece: bytes) -> list[int]:
        """The merges of a long piece, by a heap of pairs."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        if piece in self.rank:
            return [self.rank[piece]]
        ends = list(range(1, len(ids) + 1))  # where the token at each start ends; 0: no token starts
        before = list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            middle = ends[start]
            if middle < len(ids):
                rank = self.rank.get(piece[start : ends[middle]])
                if rank is not None:
                    heapq.heappush(heap, (rank, start, ends[middle]))

        for start in range(len(ids)):
            offer(start)
        while heap:
            rank, start, end = heapq.heappop(heap)
            middle = ends[start]
            if not middle or middle >= len(ids) or ends[middle] != end:
                continue  # one of the two has been merged since
            ends[start], ends[middle], ids[start] = end, 0, rank
            if end < len(ids):
                before[end] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        return [ids[i] for i in range(len(ids)) if ends[i]]

    def merge(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each piece; all pieces make their next merge at a time."""
        count = len(starts)
        ids = self.of_byte[data[spread(starts, lengths)]]
        piece = np.repeat(np.arange(count), lengths)
        done_ids, done_piece = [], []
        while len(ids):
            ranks = np.full(len(ids), self.none, np.int64)
            same = piece[1:] == piece[:-1]
            ranks[:-1][same] = self.pair_ranks(ids[:-1][same], ids[1:][same])
            heads = np.flatnonzero(np.concatenate(([True], ~same)))
            least = np.minimum.reduceat(ranks << 32 | np.arange(len(ids)), heads)
            going = (least >> 32) < self.none
            at = (least & 0xFFFFFFFF)[going]
            ids[at] = least[going] >> 32
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            active = np.repeat(going, np.diff(np.concatenate((heads, [len(ids)]))))
            done_ids.append(ids[~active])
            done_piece.append(piece[~active])
            ids, piece = ids[active & stay], piece[active & stay]
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(count, np.int64)
        ids, piece = np.concatenate(done_ids), np.concatenate(done_piece)
        order = np.argsort(piece, kind="stable")
        return ids[order], np.bincount(piece, minlength=count)


class Encoder:
    """Encodes texts with the ranks; remembers the merges of pieces, by hash, up to a bound."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.counts, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, text after text, and how many each has."""
        starts = slice_starts(texts)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        ends = np.concatenate((starts[1:], [len(texts.data)]))
        hashes = texts.hashes(starts, ends)
        keys, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > CACHED_PIECES:
            self._forget()
        place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = self.keys[place] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            self._learn(texts.data, keys[new], starts[sample[new]], (ends - starts)[sample[new]])
            place = np.searchsorted(self.keys, keys)
        at, counts = self.at[place][inverse], self.counts[place][inverse]
        total = np.bincount(texts.of_positions(starts), counts, len(texts)).astype(np.int64)
        return self.pool[spread(at, counts)], total

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        ids, counts = np.zeros(0, np.int64), np.zeros(len(keys), np.int64)
        short = lengths <= LONG_PIECE_BYTES
        ids, counts[short] = self.ranks.merge(data, starts[short], lengths[short])
        at = np.zeros(len(keys), np.int64)
        at[short] = len(self.pool) + np.cumsum(counts[short]) - counts[short]
        pool = [self.pool, ids]
        size = len(self.pool) + len(ids)
        for i in np.flatnonzero(~short):
            found = self.ranks.merge_one(data[starts[i] : starts[i] + lengths[i]].tobytes())
            at[i], counts[i] = size, len(found)
            pool.append(np.array(found, np.int64))
            size += len(found)
        self.pool = np.concatenate(pool)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at, self.counts = np.insert(self.at, where, at), np.insert(self.counts, where, counts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and where each begins, from ids alone."""
        lengths = self.ranks.lengths[ids]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        data = self.ranks.bytes[spread(self.ranks.starts[ids], lengths)]
        return data, ends[np.concatenate(([0], np.cumsum(counts)))]

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The decoded texts; what is not UTF-8 becomes the replacement character."""
        data, bounds = self.decode(ids, counts)
        flat = data.tobytes()
        found = [flat[b:e].decode("utf-8", "replace") for b, e in zip(bounds[:-1], bounds[1:])]
        return pa.array(found, pa.string())

    def decimals(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[bytes]:
        """The ids of each text in decimal, joined by commas."""
        lengths = self.ranks.decimal_lengths[ids]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))]
        inside = np.arange(self.ranks.decimal.shape[1]) < lengths[:, None]
        flat = self.ranks.decimal[ids][inside].tobytes()
        for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield flat[begin : max(begin, end - 1)]


_encoders: dict[bytes, Encoder] = {}


def encoder(file: bytes) -> Encoder:
    """The encoder of a rank file, made once in each Python worker."""
    key = hashlib.sha256(file).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Ranks(file))
    return _encoders[key]


def rank_file(path: str) -> bytes:
    """The driver reads the file, and tasks get it by broadcast: a vocabulary of a few megabytes."""
    with open(path, "rb") as file:
        return file.read()


def encoded(
    documents: DataFrame,
    text: str,
    ranks: str,
    ids: str = "ids",
    starts: str = "id_bytes",
    back: str | None = None,
) -> DataFrame:
    """The documents with their ids, and the byte of the text at which each id's bytes begin.

    With ``back``, a column of that name has the text that the ids decode to, by the same task. A
    null or empty text has no ids. Columns named like the new ones are replaced.
    """
    made = [ids, starts] + [back] * bool(back)
    rows, plain = undotted(documents.drop(*(c for c in made if c != text)))
    text = plain[text]
    file = documents.sparkSession.sparkContext.broadcast(rank_file(ranks))
    int_lists = pa.list_(pa.int32())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(file.value)
        for batch in batches:
            for part in slices(batch, text):
                found, counts = own.encode(Texts.of(part.column(text)))
                bounds = np.concatenate(([0], np.cumsum(counts)))
                lengths = own.ranks.lengths[found]
                at = np.cumsum(lengths) - lengths
                at -= np.repeat(np.concatenate((at, [0]))[np.minimum(bounds[:-1], len(at))], counts)
                lists = [
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, pa.int32())).cast(int_lists)
                    for v in (found, at)
                ]
                if back:
                    lists.append(own.texts(found, counts))
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=[*part.schema.names, *made])

    schema = f"{named(rows)}, {quoted(ids)} array<int>, {quoted(starts)} array<int>"
    schema += f", {quoted(back)} string" if back else ""
    return in_tasks(rows, encode, schema).toDF(*plain, *made)


def decoded(rows: DataFrame, ids: str, ranks: str, text: str = "text") -> DataFrame:
    """The rows with the text that their ids stand for; null ids give an empty text.

    Ids that end within a character give the replacement character there.
    """
    rest, plain = undotted(rows.drop(*([text] if text != ids else [])))
    ids = plain[ids]
    file = rows.sparkSession.sparkContext.broadcast(rank_file(ranks))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(file.value)
        for batch in batches:
            lists = batch.column(ids)
            counts = np.nan_to_num(np.array(lists.value_lengths().fill_null(0)), nan=0).astype(np.int64)
            texts = own.texts(np.array(lists.flatten(), np.int64), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text])

    return in_tasks(rest, decode, f"{named(rest)}, {quoted(text)} string").toDF(*plain, text)


def digests(documents: DataFrame, key: str, text: str, ranks: str) -> DataFrame:
    """``key`` with the number of ids, a hash of the ids, and a hash of what they decode to.

    Ids are encoded and decoded in the same task, so that only hashes leave it.
    """
    rows = documents.select(key, text)
    file = documents.sparkSession.sparkContext.broadcast(rank_file(ranks))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(file.value)
        for batch in batches:
            for part in slices(batch, text):
                found, counts = own.encode(Texts.of(part.column(1)))
                data, bounds = own.decode(found, counts)
                ids = [hashlib.sha256(d).hexdigest() for d in own.decimals(found, counts)]
                flat = data.tobytes()
                back = [hashlib.sha256(flat[b:e]).hexdigest() for b, e in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = f"{named(rows.select(key))}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return in_tasks(rows, digest, schema)
