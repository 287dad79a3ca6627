from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from dormouse.llm import collocations, countingfilter
from tests.llm.plain import lower, odd_rows, table

COLUMNS = "doc_id long, text string, lang string"


def plain(rows, min_count=30):
    """(lang, phrase, a, l, r, score) of all candidates that stay, and words of each language."""
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for n in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        often = {g: n for g, n in f.items() if n >= min_count}
        covered = {
            g[i : i + n]
            for g, b in often.items()
            for n in range(2, len(g))
            for i in range(len(g) - n + 1)
            if 100 * b >= 80 * often[g[i : i + n]]
        }
        for g, a in often.items():
            if len(g) > 1 and g not in covered:
                score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                out.append((lang, " ".join(g), a, f[g[:k]], f[g[k:]], score))
    return sorted(out), {lang: n for lang, n in totals.items() if n}


def made_rows(seed, count=600):
    choose = random.Random(seed)
    words = ["a", "B", "c\x01d", "é", "Ünd", "x'y", "\x1f", "word", "漢字", "e"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", ";!"]
    rows = []
    for i in range(count):
        text = "".join(choose.choice(words[: 3 + i % 8]) + choose.choice(marks) for _ in range(choose.randint(0, 60)))
        # A passage that a third of all rows share.
        text += " the very Same passage of words" if i % 3 == 0 else ""
        rows.append((i, text, choose.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(k, t, "en") for k, t in odd_rows()] + [(9000, "go on " * 40000, "xx"), (9001, "go on", "xx")]


def found(spark, tmp_path, rows, **more):
    docs = table(spark, tmp_path, rows, COLUMNS, files=3, extra=more.pop("extra", False))
    words, phrases, totals = collocations.phrase_counts(docs, "text", "lang", **more)
    return collocations.collocations(words, phrases), totals


@pytest.mark.parametrize(("seed", "shard_bytes"), [(1, 1 << 30), (2, 3000), (3, 1)])
def test_equals_the_plain_version(spark, tmp_path, seed, shard_bytes):
    rows = made_rows(seed)
    got, totals = found(spark, tmp_path, rows, shard_bytes=shard_bytes, extra=seed == 2)
    wanted, words = plain(rows)
    assert len(wanted) > 40
    assert sorted((r.lang, r.phrase, r.a, r.l, r.r, r.score) for r in got.collect()) == wanted
    assert {r.lang: r.n for r in totals.collect()} == words


def test_rounds_of_merging(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(collocations, "CUT_BITS", 2)
    monkeypatch.setattr(collocations, "FILTER_KEYS", 300)
    rows = made_rows(4)
    got, _ = found(spark, tmp_path, rows, shard_bytes=2000)
    assert sorted((r.lang, r.phrase, r.a, r.l, r.r, r.score) for r in got.collect()) == plain(rows)[0]


def test_a_shard_is_counted_in_ranges_of_keys():
    choose = np.random.default_rng(6)
    ids = np.minimum(choose.zipf(1.2, 400_000), 30_000).astype(np.int32)
    ids[choose.random(len(ids)) < 0.1] = 0
    wanted, peaks = [], []
    for in_ranges in (False, True):
        tracemalloc.start()
        if in_ranges:
            got = [f for own in collocations._counts_in_ranges(ids, 15, 10) for f in countingfilter.by_prefix(own, 10)]
        else:
            high, low = (np.concatenate(k) for k in zip(*collocations._packed_phrases(ids, 15)))
            high, low = countingfilter.permuted(high, low, 30)
            wanted = countingfilter.by_prefix(countingfilter.counted(high, low, None, 30), 10)
            del high, low
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert len(wanted) == 1024
    packed = [[(prefix, countingfilter.packed(own, prefix, 10)) for prefix, own in parts] for parts in (wanted, got)]
    assert packed[0] == packed[1]
    # All ranges' counts are held here; a task hands each on before the next.
    assert peaks[1] < 0.7 * peaks[0]


@pytest.mark.parametrize(("words", "keys"), [(1, 1), (5, 40), (7, 1 << 18)])
def test_phrases_across_parts_of_a_shard(monkeypatch, words, keys):
    monkeypatch.setattr(collocations, "PACKED_WORDS", words)
    monkeypatch.setattr(collocations, "SORTED_KEYS", keys)
    ids = np.random.default_rng(7).integers(0, 4, 300).astype(np.int32)
    wanted = Counter(
        tuple(ids[i : i + n].tolist()) for n in (2, 3, 4) for i in range(len(ids) - n + 1) if ids[i : i + n].all()
    )
    found = Counter()
    for counts in collocations._counts_in_ranges(ids, 2, 3):
        high, low = countingfilter.restored(counts.high, counts.low, counts.bits)
        for h, l, n in zip(high.tolist(), low.tolist(), counts.counts.tolist()):
            found[tuple(x for x in (h >> 2, h & 3, l >> 2, l & 3) if x)] += n
    assert found == wanted


def test_leading(spark, tmp_path):
    rows = made_rows(5)
    got, totals = found(spark, tmp_path, rows, min_count=3)
    wanted, words = plain(rows, 3)
    by_lang = defaultdict(list)
    for lang, phrase, a, _, _, score in wanted:
        by_lang[lang].append((-score, -a, phrase.encode()))
    rows = collocations.leading(got, totals, 7).collect()
    assert sorted((r.lang, r.rank, r.phrase.encode(), r.n) for r in rows) == sorted(
        (lang, i + 1, phrase, words[lang]) for lang, own in by_lang.items() for i, (_, _, phrase) in enumerate(sorted(own)[:7])
    )


def test_empty_table_and_texts(spark, tmp_path):
    for name, rows in (("a", []), ("b", [(1, None, "en"), (2, "", None), (3, " .\n", "en"), (3, " .\n", "en")])):
        got, totals = found(spark, tmp_path / name, rows)
        assert got.count() == 0 and totals.count() == 0


@pytest.mark.parametrize("bits", [1, 7, 30, 33, 48, 62])
@pytest.mark.parametrize("prefix_bits", [0, 1, 5])
def test_filters_lose_nothing(bits, prefix_bits):
    prefix_bits = min(bits, prefix_bits)
    choose = np.random.default_rng(bits)
    few = min(1 << bits, 700)
    keys = [choose.integers(0, 1 << bits, few, dtype=np.uint64) for _ in range(2)]
    at = choose.integers(0, few, 4000)
    parts = np.array_split(at, 5)
    wanted = Counter(zip(keys[0][at].tolist(), keys[1][at].tolist()))
    cut = defaultdict(list)
    for part in parts:
        high, low = countingfilter.permuted(keys[0][part], keys[1][part], bits)
        own = countingfilter.counted(high, low, None, bits)
        for prefix, piece in countingfilter.by_prefix(own, prefix_bits):
            cut[prefix].append(countingfilter.unpacked(countingfilter.packed(piece, prefix, prefix_bits)))
    got, order = {}, []
    for prefix in sorted(cut):
        whole = countingfilter.merged(cut[prefix])
        order += list(zip(whole.high.tolist(), whole.low.tolist()))
        high, low = countingfilter.restored(whole.high, whole.low, bits)
        got |= dict(zip(zip(high.tolist(), low.tolist()), whole.counts.tolist()))
    assert got == wanted and order == sorted(set(order))


def test_filters_hold_large_counts_in_few_bytes():
    counts = countingfilter.Counts(
        np.arange(1000, dtype=np.uint64) << np.uint64(20), np.arange(1000, dtype=np.uint64), np.full(1000, 1), 34
    )
    counts.counts[[3, 999]] = 255, 1 << 40
    data = countingfilter.packed(counts, 0, 0)
    back = countingfilter.unpacked(data)
    assert (back.high == counts.high).all() and (back.low == counts.low).all() and (back.counts == counts.counts).all()
    assert len(data) < 11 * 1000
