from __future__ import annotations

import random

import numpy as np
import pytest

from dormouse.llm import jaccard
from dormouse.llm.components import components
from tests.llm.plain import near_copies, odd_rows, table


def made_rows(seed):
    choose = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [choose.choices(vocabulary, k=choose.choice([1, 2, 3, 4, 5, 6, 7, 9, 12, 30, 60, 120])) for _ in range(20)]
    hot = choose.choices(vocabulary, k=40)
    rows = []
    for base in bases:
        for _ in range(choose.randint(1, 10)):
            words = list(base)
            for _ in range(choose.randint(0, max(1, len(words) // 18))):
                at, act = choose.randrange(len(words) + 1), choose.random()
                if act < 0.4 and at < len(words):
                    words[at] = choose.choice(vocabulary)
                elif act < 0.7:
                    words.insert(at, choose.choice(vocabulary))
                else:
                    del words[at : at + 1]
            rows.append((len(rows), " ".join(words + hot * (choose.random() < 0.2))))
    for _ in range(60):
        rows.append((len(rows), " ".join(hot + choose.choices(vocabulary, k=choose.randint(0, 30)))))
    return rows + [(900, rows[9][1].upper()), (3, rows[3][1]), (None, rows[0][1])]


@pytest.mark.parametrize("deletions", [None, 0, 1])
def test_equals_the_plain_version(spark, tmp_path, monkeypatch, deletions):
    rows = made_rows(7) + odd_rows()
    if deletions is not None:
        every = jaccard.Bands.of(75, dict.fromkeys(range(64), deletions))
        monkeypatch.setattr(jaccard, "_choose_bands", lambda *_: every)
        monkeypatch.setattr(jaccard, "BLOCK", 5)
    docs = table(spark, tmp_path, rows, files=3, extra=True)
    found = [(r.key, r.n, r.component) for r in jaccard.similar(docs, "text", "doc_id").collect()]
    assert sorted(found, key=repr) == sorted(near_copies(rows), key=repr)


def test_every_similar_pair_shares_enough_entries():
    rng = np.random.default_rng(8)
    for deletions in (0, 1):
        bands = jaccard.Bands.of(75, dict.fromkeys(range(64), deletions))
        for _ in range(300):
            size = int(rng.choice([1, 2, 3, 5, 8, 20, 60, 150]))
            a = np.unique(rng.integers(1, 1 << 62, size).astype(np.uint64))
            b = np.unique(np.concatenate((a[rng.integers(0, 10, len(a)) > 0], rng.integers(1, 1 << 62, rng.integers(0, size // 7 + 1)).astype(np.uint64))))
            common = len(np.intersect1d(a, b))
            if 100 * common < 75 * (len(a) + len(b) - common):
                continue
            entry, of = jaccard.index_rows(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), bands)
            mine, yours = ({int(e) >> 10: int(e) & 1023 for e in entry[of == i]} for i in (0, 1))
            shared = set(mine) & set(yours)
            assert shared
            for own in (mine, yours):
                by_band: dict[int, list[int]] = {}
                for e in shared:
                    by_band.setdefault(e & 63, []).append(e)
                assert any(len(es) >= own[es[0]] for es in by_band.values())


def test_one_of_each_group_stays(spark, tmp_path):
    rows = made_rows(9) + odd_rows()
    docs = table(spark, tmp_path, rows, extra=True)
    out = jaccard.one_of_each(docs, "text", "doc_id")
    assert out.columns == docs.columns
    wanted = near_copies(rows)
    # A key may stand for several rows of one group, and for rows of different groups.
    heads = {key for key, n, least in wanted if n and key is not None and key == least}
    kept = out.collect()
    assert {r.doc_id for r in kept if r.text and r.text.split() and r.doc_id is not None} == heads
    assert sum(1 for r in kept if not (r.text or "").split()) == sum(1 for _, t in rows if not (t or "").split())


def test_empty_table_and_wordless_documents(spark, tmp_path):
    assert jaccard.similar(table(spark, tmp_path, []), "text", "doc_id").count() == 0
    docs = table(spark, tmp_path / "w", [(1, None), (2, ""), (2, "")])
    assert sorted((r.key, r.n, r.component) for r in jaccard.similar(docs, "text", "doc_id").collect()) == [
        (1, 0, 1), (2, 0, 2), (2, 0, 2)
    ]


def test_components(spark):
    choose = random.Random(10)
    edges = [(choose.randrange(80), choose.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    edges += [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    wanted = {n: root(n) for n in parent}
    assert found == {n: wanted[n] for n in found}
    assert set(found) == {n for n in wanted if sum(1 for m in wanted if wanted[m] == wanted[n]) > 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_group_of_any_size_is_joined_by_a_few_pairs_for_each_member(spark, tmp_path, monkeypatch):
    choose, sizes = random.Random(12), []
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in choose.sample(range(120), 2):
            words[at] = f"x{choose.randint(0, 5)}"
        rows.append((i, " ".join(words)))
    links = jaccard._links

    def counted(pairs, sets, percent):
        pairs = jaccard.kept(pairs)
        sizes.append(pairs.count())
        return links(pairs, sets, percent)

    monkeypatch.setattr(jaccard, "_links", counted)
    monkeypatch.setattr(jaccard, "FIRSTS", 3)
    found = jaccard.similar(table(spark, tmp_path, rows, files=3), "text", "doc_id").collect()
    assert sorted((r.key, r.n, r.component) for r in found) == sorted(near_copies(rows))
    assert len(sizes) == 2 and sizes[0] <= 3 * len(rows)
