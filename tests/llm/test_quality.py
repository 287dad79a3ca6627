from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dormouse.llm import quality
from tests.llm.plain import blank_words, odd_rows, table
from tests.llm.test_bytebpe import random_texts


def plain(text):
    words = blank_words(text)
    lines = (text or "").split("\n")
    seen, repeated = set(), 0
    for line in lines:
        if blank_words(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)} if len(words) < 500 else None
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, repeated, None if covered is None else len(covered)


def test_measures_equal_the_plain_version():
    rows = [t for _, t in odd_rows()] + random_texts(300) + [
        "a b c d e a b c d e", "a b c d e f a b c d e", "x x x x x x x", "#*$%&|<>", "l\nl\nl \n\n\nl", "l\r\nl\r\n",
        "a a a a", "é ü é ü é ü é ü é",
    ]
    found = quality.measures(pa.array(rows, pa.string()))
    for i, text in enumerate(rows):
        got = tuple(int(found[m][i]) for m in quality.MEASURES)
        wanted = plain(text)
        assert got[:4] == wanted[:4] and wanted[4] in (None, got[4]), repr(text[:60] if text else text)


def plain_rates(rows, rule):
    """Shrunk rates and their low estimates, by the moments of all hosts."""
    n, k = Counter(r[0] for r in rows), Counter(r[0] for r in rows if r[1 + rule])
    total = sum(n.values())
    mean = sum(k.values()) / total
    spread = sum(k[h] ** 2 / n[h] for h in n) - sum(k.values()) * mean - (len(n) - 1) * mean * (1 - mean)
    scale = total - sum(v * v for v in n.values()) / total - (len(n) - 1)
    strength = total
    if len(n) > 1 and scale > 0 and spread > 0:
        strength = max(mean * (1 - mean) / (spread / scale) - 1, quality.LEAST_STRENGTH)
    found = {}
    for h in n:
        rate = (k[h] + mean * strength) / (n[h] + strength)
        found[h] = rate, rate - 2 * (rate * (1 - rate) / (n[h] + strength + 1)) ** 0.5
    return found


def made_hosts():
    rows = [("good", False, False)] * 400 + [("good", True, False)] * 8 + [("bad", True, False)] * 300 + [("bad", False, False)] * 20
    rows += [("junk", False, True)] * 90 + [("new", True, True)] * 2 + [(None, True, False)] * 50
    return rows + [(f"h{i}", i % 20 == 0, i % 9 == 0) for i in range(200)]


def test_hosts_are_judged_by_shrunk_rates_of_every_rule(spark):
    rows = made_hosts()
    frame = spark.createDataFrame(rows, "host string, a boolean, b boolean")
    rates = {(r.host, r.rule): r for r in quality.host_rates(frame, "host", ["a", "b"]).collect()}
    for i, rule in enumerate("ab"):
        for host, (rate, low) in plain_rates(rows, i).items():
            assert rates[host, rule].rate == pytest.approx(rate) and rates[host, rule].rate_low == pytest.approx(low)
    assert rates["new", "a"].rate_low < 0.5  # two failures tell little
    found = quality.host_verdicts(frame, "host", ["a", "b"])
    assert found.count() == len(rows)
    rejected = {r.host for r in found.where("verdict.rejected").select("host").distinct().collect()}
    assert {"bad", "junk"} <= rejected and not rejected & {"good", "new"}
    one = quality.host_verdicts(frame, "host", ["a"])
    assert "junk" not in {r.host for r in one.where("verdict.rejected").collect()}
    failed = {r.host: (r.verdict.documents, r.verdict.failed) for r in found.collect()}
    assert failed["bad"] == (320, [300, 0]) and failed["junk"] == (90, [0, 90]) and failed[None] == (50, [50, 0])


def test_columns_of_any_name(spark):
    names = ["host", "_host", "host_documents", "rate", "rate_low", "own", "judged", "a.b", "verdict"]
    frame = spark.createDataFrame([tuple(f"{n}{i % 2}" for n in names) + (i % 3 == 0,) for i in range(30)], [*names, "f`x"])
    found = quality.host_verdicts(frame, "a.b", ["f`x"])
    assert found.columns == [*(n for n in names if n != "verdict"), "f`x", "verdict"] and found.count() == 30
    assert {(r["host"], r["a.b"], r["verdict"].documents) for r in found.collect()} == {("host0", "a.b0", 15), ("host1", "a.b1", 15)}


@pytest.mark.parametrize("hosts", [0, 1])
def test_few_hosts(spark, hosts):
    frame = spark.createDataFrame([("a", True)] * 3 * hosts, "host string, failed boolean")
    assert quality.host_verdicts(frame, "host", ["failed"]).count() == 3 * hosts


def test_table_with_odd_rows(spark, tmp_path):
    docs = table(spark, tmp_path, odd_rows(), files=2, extra=True)
    found = quality.document_measures(docs, "text", ["doc_id", "row"]).withColumn("f", quality.base_failed())
    assert found.count() == len(odd_rows())
    assert found.where(F.col("n_words") < 10).where("not f").count() == 0
    assert quality.document_measures(docs.where("false"), "text", ["doc_id"]).count() == 0
