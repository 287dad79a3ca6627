"""Plain versions of what the operators compute, for small inputs, and documents with odd rows."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(_LOWER)


def blank_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def letter_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def odd_rows():
    """Null and empty texts, null and repeated keys, equal rows, long and strange texts."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (None, "no key here."), (5, "word"),
        (6, "tab\there ÄÖ漢字 \x0b😀 it's  don't\r\n'll"), (7, "long " * 30000 + "end"),
        (8, "x" * 20000), (None, None), (9, "One line. Two lines.\nOne line. Two lines.\n"),
    ]


def table(spark, path, rows, columns="doc_id long, text string", files=1, extra=False):
    """A stored table of the rows; ``extra`` adds columns with names that operators use inside."""
    names = [c.split()[0] for c in columns.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    data = {
        c.split()[0]: pa.array([row[i] for row in rows], kinds[c.split()[1]])
        for i, c in enumerate(columns.split(","))
    }
    if extra:
        for name in ("row", "n", "_row", "_found", "words", "entry", "_part", "own", "place", "key0", "a.b"):
            data[name] = pa.array([f"{name}{i}" for i in range(len(rows))], pa.string())
    whole = pa.table(data)
    size = -(-max(1, len(rows)) // files)
    for number in range(files):
        part = whole.slice(number * size, size)
        (path / "t").mkdir(exist_ok=True, parents=True)
        pq.write_table(part, path / "t" / f"part-{number}.parquet")
    assert names
    return spark.read.parquet(str(path / "t"))


def shingles(text, size=5):
    words = blank_words(lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_copies(rows, percent=75):
    """Of (key, text) rows: key, number of shingles, smallest key reachable."""
    sets = [shingles(text) for _, text in rows]
    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for gram in own:
            holders[gram].append(i)
    common = Counter()
    for held in holders.values():
        for x in range(len(held)):
            for y in range(x + 1, len(held)):
                common[held[x], held[y]] += 1
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [
        (key, len(sets[i]), least.get(root(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)
    ]


LINE_END = re.compile(r"(?<=\n)|(?<=[.!?] )")


def without_later_copies(texts, min_words=30):
    """Texts in order, without lines that are in a run of enough words that an equal run stands before."""
    left, before = [], set()
    for text in texts:
        own = LINE_END.split(text or "")
        keys = [line.rstrip(" \n\r\t") for line in own]
        gone = set()
        for start in range(len(keys)):
            words = 0
            for end in range(start, len(keys)):
                words += 1 + keys[end].count(" ")
                if words >= min_words:
                    run = tuple(keys[start : end + 1])
                    if run in before:
                        gone |= set(range(start, end + 1))
                    before.add(run)
        left.append("".join(line for i, line in enumerate(own) if i not in gone))
    return left
