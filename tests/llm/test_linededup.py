from __future__ import annotations

import random

import pytest

from dormouse.llm import linededup
from dormouse.llm.spread import free_name
from tests.llm.plain import LINE_END, odd_rows, table, without_later_copies


def made_rows(seed):
    choose = random.Random(seed)
    parts = [
        " ".join(choose.choices("ab cd ef gh ij kl mn é".split(), k=choose.randint(1, 22))) + choose.choice([". ", ".\n", "\n", "! "])
        for _ in range(14)
    ]
    rows = [(i, "".join(choose.choices(parts, k=choose.randint(0, 14)))) for i in range(70)]
    return rows + [(5, rows[5][1]), (None, rows[3][1]), (200, "\n" * 40), (201, "\n" * 40), (202, parts[0] * 30)]


@pytest.mark.parametrize(("seed", "min_words"), [(3, 20), (4, 9), (7, 30), (8, 1)])
def test_equals_the_plain_version(spark, tmp_path, seed, min_words):
    rows = made_rows(seed) + odd_rows()
    docs = table(spark, tmp_path, rows, extra=True)
    out = linededup.deduplicated(docs, "text", "doc_id", "runs", min_words)
    assert out.columns == [*docs.columns, "runs"]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    wanted = without_later_copies([rows[i][1] for i in order], min_words)
    got = [(r.doc_id, r.text if r.text is not None else "") for r in out.collect()]
    assert sorted(got, key=repr) == sorted(((rows[i][0], t) for i, t in zip(order, wanted)), key=repr)
    assert out.where("text is null").count() == sum(t is None for _, t in rows)


def test_runs_name_the_lines_taken_out(spark, tmp_path):
    rows = made_rows(5)
    docs = table(spark, tmp_path, rows)
    for r in linededup.deduplicated(docs, "text", "doc_id", "runs", 12).collect():
        before = next(t for k, t in rows if k == r.doc_id and (not r.runs or len(t) > len(r.text)))
        gone = {i for s in r.runs for i in range(s.begin, s.end)}
        assert "".join(x for i, x in enumerate(LINE_END.split(before)) if i not in gone) == r.text
        assert all(a.end < b.begin for a, b in zip(r.runs, r.runs[1:]))


def test_passage_in_the_middle_of_lines_is_taken_out_of_later_documents(spark, tmp_path):
    passage = "A passage of some forty words stands here as it is. " + "It goes on with one more sentence that is long enough. " * 1 + (
        "Then it ends with another long sentence, so that its size is beyond what counts as a run of lines here. "
        "And that is the very last of its sentences, which is not short either, as can be seen."
    )
    rows = [(i, f"Own words of document {i} stand at first, before it. {passage}\nThen own words {i}.") for i in range(30)]
    found = linededup.deduplicated(table(spark, tmp_path, rows), "text", "doc_id", "runs").collect()
    assert [r.doc_id for r in found if passage in r.text] == [0]
    assert all(f"document {r.doc_id} stand" in r.text and f"own words {r.doc_id}" in r.text for r in found)


def test_empty_table_and_table_without_copies(spark, tmp_path):
    docs = table(spark, tmp_path, [(1, "one text\n"), (2, "another text\n")])
    assert {r.text for r in linededup.deduplicated(docs, "text", "doc_id", "runs").collect()} == {"one text\n", "another text\n"}
    assert linededup.deduplicated(table(spark, tmp_path / "e", []), "text", "doc_id", "runs").count() == 0


def test_plan_is_free_of_python(spark, tmp_path):
    docs = table(spark, tmp_path, made_rows(6))
    out = linededup.deduplicated(docs, "text", "doc_id", "runs")
    assert not any(word in out._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Arrow", "Cartesian"))


def test_free_name(spark):
    assert free_name(spark.range(1).selectExpr("id", "1 AS _Row"), "_row") == "_row_"


def test_passages_beside_short_sentences_and_in_short_lines_go(spark, tmp_path):
    long = "This passage has more than fifty words, all of which stand in sentences that are not short at all. " * 2 + (
        "It stands between two short sentences, which are not the same in any two of the documents that hold it. "
    )
    short = "".join(f"a{i} b{i} c{i}\n" for i in range(23))
    rows = [(i, f"No {i}. {long}Yes {i}. So own {i}.\n{short}Own {i} end.\n") for i in range(6)]
    found = {r.doc_id: r.text for r in linededup.deduplicated(table(spark, tmp_path, rows), "text", "doc_id", "runs").collect()}
    assert found[0] == rows[0][1]
    assert all(found[i] == f"No {i}. Yes {i}. So own {i}.\nOwn {i} end.\n" for i in range(1, 6))


def test_lines_are_split_alike_with_and_without_the_mark(spark):
    texts = ["", "a", "a. b", "a.  b! \nc\n\n", ". . ", "x\x01y. z\n", "\x01", "é? ü.\n", "\n"]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    found = {r.t: r.own for r in rows.select("t", linededup.lines(rows.t).alias("own")).collect()}
    assert found.pop(None) == [""]
    assert found == {t: LINE_END.split(t) for t in texts}


def test_a_line_that_a_third_of_all_rows_share(spark, tmp_path):
    hot = "The same line of many words stands in a third of all documents, " * 4 + "and ends here.\n"
    rows = [(i, (hot if i % 3 == 0 else "") + f"Own line {i}.\n" + "go. " * (i % 50)) for i in range(300)]
    found = linededup.deduplicated(table(spark, tmp_path, rows, files=5), "text", "doc_id", "runs").collect()
    wanted = without_later_copies([t for _, t in rows])
    assert {r.doc_id: r.text for r in found} == dict(enumerate(wanted))


@pytest.mark.parametrize("min_words", [3, 4, 5, 13])
def test_runs_of_few_lines_and_of_many_equal_the_plain_version(spark, tmp_path, min_words):
    choose = random.Random(min_words)
    parts = ["go. ", "on! ", "a b. ", "a b c d\n", "one two three four five six seven. ", "x y z u v w. \t\r\n", "go. \n"]
    rows = [(i, "".join(choose.choices(parts, k=choose.randint(0, 12)))) for i in range(60)]
    rows += [(60 + i, "go. " * (14 + i) + f"own{i}. " + "on! a b. " * i) for i in range(8)]
    found = linededup.deduplicated(table(spark, tmp_path, rows, files=3), "text", "doc_id", "runs", min_words).collect()
    assert {r.doc_id: r.text for r in found} == dict(enumerate(without_later_copies([t for _, t in rows], min_words)))


def test_a_run_is_named_once(spark, tmp_path, monkeypatch):
    tables, keep = [], linededup.kept

    def recorded(df, *args, **kwargs):
        tables.append(keep(df, *args, **kwargs))
        return tables[-1]

    monkeypatch.setattr(linededup, "kept", recorded)
    rows = [(i, f"Own words {i}.\n" + "go. on! " * 30 + "Some more words. And these at the end of it.\n" * 9) for i in range(4)]
    assert linededup.deduplicated(table(spark, tmp_path, rows), "text", "doc_id", "runs").count() == 4
    (runs,) = (t for t in tables if t.columns == ["pos", "size", "head", "tail"])
    assert runs.count() == runs.select("pos", "size").distinct().count() > 0
