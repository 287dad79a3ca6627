"""Secrets in text: known forms, and values in credential contexts that would take long to guess.

How long follows from the cheapest way to put a value together: a dynamic program over its
characters chooses between dictionary words, dates, repeats, keyboard walks and brute force. The
dictionary has passwords' words, and the words that are frequent in the corpus itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dormouse.llm.bytetext import Texts, byte_set, slices
from dormouse.llm.spread import in_tasks, kept, named, quoted, undotted

KINDS = ["assign", "access", "hex", "guess"]
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
HEX = byte_set((0x30, 0x39), (0x61, 0x66))

_ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
# Words that any match of the patterns above or below holds, in lower case.
_ASSIGN_WORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
_CONTEXT_WORDS = [*_ASSIGN_WORDS, b"passphrase", b"passcode", b"pwd", b"credential", b"access", b"private"]
_CONTEXT = re.compile(
    rb"(?i:password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key"
    rb"|private[_-]?key|credentials?)"
    rb"""["']?\x20*(?:=>|[:=])\x20*["'`]?([^\x00-\x20\x7f"'`<>,;()\[\]{}]+)"""
)

# A value is a secret from so many guesses on, in decimal digits.
MIN_GUESS_DIGITS = 8.0

# Words of the corpus with at least this share of all its documents' words, each counted once a
# document, and in so many documents, are in the dictionary: so at most as many words.
FREQUENT_SHARE, LEAST_DOCUMENTS = 1 / (1 << 17), 3
MIN_LETTERS, MAX_LETTERS = 3, 24

# Frequent parts of passwords, the likeliest first.
PASSWORD_WORDS = """
password qwerty admin welcome login letmein dragon monkey master hello secret test user root guest
default changeme abc iloveyou sunshine princess football baseball shadow superman batman michael
jordan hunter ranger buster soccer hockey killer george andrew charlie thomas robert daniel
jessica ashley nicole summer winter spring autumn love money freedom whatever trustno computer
internet server database mysql oracle postgres public private access token key example sample demo
temp service system manager company office mobile apple google house flower cookie pepper ginger
""".split()
# The rows of a keyboard.
KEYBOARD = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
_SHIFTED = dict(zip("~!@#$%^&*()_+{}|:\"<>?", "`1234567890-=[]\\;',./"))

_WORD_RANK = {word: rank for rank, word in enumerate(PASSWORD_WORDS, 1)}
_LONGEST_WORD = max(map(len, PASSWORD_WORDS))
_LEET = str.maketrans("01345@$!7", "oleasasit")
_KEY_AT = {key: (row, column) for row, keys in enumerate(KEYBOARD) for column, key in enumerate(keys)}
_DATES = [
    (re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"), 365 * 120),
    (re.compile(r"(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"), 365 * 120),
    (re.compile(r"(?:19|20)\d\d"), 120),
]
# Each part costs a choice of its kind besides what its own choices cost.
_CHOICE = math.log10(5)
_MIN_RUN, _MAX_RUN = 3, 64


def _brute(character: str) -> float:
    if character.isdigit():
        return 1.0
    return math.log10(26) if character.isalpha() and character.isascii() else math.log10(33)


def _adjacent(a: str, b: str) -> bool:
    """Next to each other on the keyboard, or neighbours in the alphabet or among digits."""
    if a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1:
        return True
    p, q = _KEY_AT.get(_SHIFTED.get(a, a)), _KEY_AT.get(_SHIFTED.get(b, b))
    return bool(p and q) and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def corpus_words(documents: DataFrame, text: str) -> dict[str, int]:
    """Ranks of the corpus' frequent words in lower case, the most frequent first."""
    words = documents.select(F.explode(F.array_distinct(F.split(F.lower(F.col(quoted(text))), r"\P{L}+"))).alias("word"))
    words = words.where(F.length("word").between(MIN_LETTERS, MAX_LETTERS))
    counts = kept(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    least = max(LEAST_DOCUMENTS, total * FREQUENT_SHARE)
    # At most 1 / FREQUENT_SHARE words can have that share.
    rows = counts.where(F.col("n") >= least).toArrow()
    ordered = sorted(zip(rows["n"].to_pylist(), rows["word"].to_pylist()), key=lambda r: (-r[0], r[1]))
    return {word: rank for rank, (_, word) in enumerate(ordered, 1)}


def guess_digits(
    value: str, enough: float = math.inf, ranks: dict[str, int] | None = None
) -> tuple[float, list[tuple[str, int, int]]]:
    """Decimal digits of the guesses that the cheapest segmentation needs, and its parts.

    Brute-force parts have no bound in length; the others reach over at most a few dozen characters
    at a time, so the work is in proportion to the length. It ends where all ways on need ``enough``
    digits already; then these are returned, without parts. ``ranks`` adds words to the dictionary.
    """
    known = ranks or {}
    longest = max(_LONGEST_WORD, MAX_LETTERS) if known else _LONGEST_WORD

    def rank_of(word: str) -> int | None:
        return min(filter(None, (_WORD_RANK.get(word), known.get(word))), default=None)

    count = len(value)
    low = value.lower()
    plain = low.translate(_LEET)
    cost, back = [0.0] + [math.inf] * count, [("", 0)] * (count + 1)
    in_brute = [False] * (count + 1)

    def offer(kind: str, start: int, end: int, digits: float) -> None:
        if cost[start] + digits < cost[end] - 1e-12:
            cost[end], back[end], in_brute[end] = cost[start] + digits, (kind, start), kind == "brute"

    dates: dict[int, list[tuple[int, float]]] = {}
    for pattern, choices in _DATES:
        for at in range(count):
            match = pattern.match(value, at) if value[at].isdigit() else None
            if match:
                dates.setdefault(at, []).append((match.end(), math.log10(choices)))
    # Runs of one character, and of neighbours: from each start, where the run ends.
    same_end, walk_end = [count] * count, [count] * count
    for at in range(count - 2, -1, -1):
        same_end[at] = same_end[at + 1] if low[at] == low[at + 1] else at + 1
        walk_end[at] = walk_end[at + 1] if _adjacent(low[at], low[at + 1]) else at + 1
    check = 32
    for at in range(count):
        if at == check:
            check *= 2
            # No part costs less than nothing, and every way leads over a place from here on.
            if (least := min(cost[at:])) >= enough:
                return least, []
        joined = 0.0 if in_brute[at] else _CHOICE
        if cost[at] + joined + _brute(value[at]) < cost[at + 1] - 1e-12:
            start = back[at][1] if in_brute[at] else at
            cost[at + 1], back[at + 1], in_brute[at + 1] = (
                cost[at] + joined + _brute(value[at]),
                ("brute", start),
                True,
            )
        for end in range(at + 3, min(count, at + longest) + 1):
            own = rank_of(low[at:end])
            rank = own or rank_of(plain[at:end])
            if rank:
                word = value[at:end]
                # lower case, first capital, all capitals or mixed; and letters put as digits
                spelt = 1 + (word != low[at:end]) * (2 if word.istitle() or word.isupper() else len(word))
                spelt *= 1 if own else 2
                offer("word", at, end, _CHOICE + math.log10(rank * spelt))
        for end, digits in dates.get(at, ()):
            offer("date", at, end, _CHOICE + digits)
        for kind, stop, choices in (("repeat", same_end[at], 95), ("walk", walk_end[at], 47 * 4)):
            for end in {*range(at + _MIN_RUN, min(stop, at + _MAX_RUN) + 1), stop}:
                if end - at >= _MIN_RUN:
                    offer(kind, at, end, _CHOICE + math.log10(choices * (end - at)))
    parts, end = [], count
    while end:
        kind, start = back[end]
        parts.append((kind, start, end))
        end = start
    return cost[count], parts[::-1]


def _with_any(data: bytes, texts: Texts, words: list[bytes]) -> np.ndarray:
    """Numbers of the texts that hold one of the words."""
    found = []
    for word in words:
        at = data.find(word)
        while at >= 0:
            found.append(at)
            at = data.find(word, at + len(word))
    return np.unique(texts.of_positions(np.array(sorted(found), np.int64)))


def find(texts: Texts, ranks: dict[str, int] | None = None) -> dict[int, list[tuple[int, int, int]]]:
    """(start, kind number, end) in bytes of each text's spans; a base match stays whatever else is found."""
    data = texts.data.tobytes()
    low = data.lower()
    bounds = texts.offsets.tolist()
    found: dict[int, list[tuple[int, int, int]]] = {}
    for i in _with_any(low, texts, _ASSIGN_WORDS).tolist():
        for match in _ASSIGN.finditer(data[bounds[i] : bounds[i + 1]]):
            if len(match[1]) >= MIN_ASSIGNED:
                found.setdefault(i, []).append((match.start(), 0, match.end()))
    for i in _with_any(data, texts, [b"AKIA"]).tolist():
        for match in _ACCESS.finditer(data[bounds[i] : bounds[i + 1]]):
            if len(match[0]) >= MIN_ACCESS:
                found.setdefault(i, []).append((match.start(), 1, match.end()))
    starts, ends = texts.runs(HEX)
    long = ends - starts >= MIN_HEX
    starts, ends = starts[long], ends[long]
    for i, start, end in zip(texts.of_positions(starts).tolist(), starts.tolist(), ends.tolist()):
        found.setdefault(i, []).append((start - bounds[i], 2, end - bounds[i]))
    for i in _with_any(low, texts, _CONTEXT_WORDS).tolist():
        for match in _CONTEXT.finditer(data[bounds[i] : bounds[i + 1]]):
            value = match[1].rstrip(b".:!?").decode("utf-8", "replace")
            if MIN_ASSIGNED <= len(value) and guess_digits(value, MIN_GUESS_DIGITS, ranks)[0] >= MIN_GUESS_DIGITS:
                end = match.start(1) + len(match[1].rstrip(b".:!?"))
                found.setdefault(i, []).append((match.start(1), 3, end))
    return found


def scanned(documents: DataFrame, text: str, result: str) -> DataFrame:
    """All columns, and ``result``: an array of spans with ``kind``, ``begin`` and ``end``.

    Spans are in code points, end exclusive, in order of their begin and then of their kind. A null
    or empty text has none; every row is scanned by itself, so repeated rows get equal spans. A
    column named like ``result`` is replaced. Words that are frequent in the documents are counted
    first and broadcast.
    """
    rows, plain = undotted(documents.drop(result))
    text = plain[text]
    ranks = documents.sparkSession.sparkContext.broadcast(corpus_words(rows, text))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = Texts.of(part.column(text))
                spans: list[list[dict]] = [[] for _ in range(len(texts))]
                for i, own in find(texts, ranks.value).items():
                    data = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
                    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                    spans[i] = [
                        {"kind": KINDS[k], "begin": int(points[b]), "end": int(points[e])}
                        for b, k, e in sorted(own)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(spans, kind)], names=[*part.schema.names, result]
                )

    schema = f"{named(rows)}, {quoted(result)} array<struct<kind:string,begin:int,end:int>>"
    return in_tasks(rows, scan, schema).toDF(*plain, result)
