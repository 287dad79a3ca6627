from __future__ import annotations

import pytest

import corpus_pipeline
from dormouse.llm import bytebpe, queries, toxicity
from dormouse.llm.spread import kept
from tests.llm.plain import LINE_END, letter_words, near_copies, without_later_copies

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(kept(stage(spark, out[-1], SF_DIR)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(steps):
    for step in steps[:-1]:
        assert step.columns == COLUMNS
    for step in steps[2:-1]:
        assert step.where("n_chars <> length(text)").count() == 0


def test_toxic_documents_go_and_others_stay(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = queries.toxicity_model(steps[0], labels)
    scores = {r.doc_id: r.f.score for r in toxicity.scored(steps[0], "text", model, "f").collect()}
    assert set(texts(steps[1])) == {k for k, s in scores.items() if s < toxicity.THRESHOLD}


def test_line_dedup_equals_the_plain_version(steps):
    before = sorted(texts(steps[1]).items())
    wanted = without_later_copies([t for _, t in before])
    assert texts(steps[2]) == {k: w for (k, t), w in zip(before, wanted) if w.split() or w == t}
    assert LINE_END.split("a\nb") == ["a\n", "b"]


def test_one_of_each_group_of_near_copies_stays(steps):
    rows = sorted(texts(steps[2]).items())
    stay = {key for key, n, least in near_copies(rows) if not n or key == least}
    assert texts(steps[3]) == {k: t for k, t in rows if k in stay}


def test_no_benchmark_passage_is_left(spark, steps):
    items = [letter_words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    sought = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(s) for s in sought}

    def hits(text):
        words = letter_words(text)
        return any(tuple(words[i : i + n]) in sought for n in sizes for i in range(len(words) - n + 1))

    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    assert all(after[k] == before[k] for k in before if not hits(before[k]))
    assert not any(hits(t) for t in after.values())


def test_ids_decode_to_the_text(steps):
    assert texts(steps[5]) == texts(steps[4])
    encoder = bytebpe.encoder(bytebpe.rank_file(corpus_pipeline.public_tokenizers.path(queries.RANK_FILE)))
    for r in steps[5].collect():
        assert r.n_tokens == len(r.ids) and b"".join(
            encoder.ranks.bytes[encoder.ranks.starts[i] : encoder.ranks.starts[i + 1]].tobytes() for i in r.ids
        ) == r.text.encode()


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(map(repr, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(repr, steps[5].collect()))


def test_empty_documents_pass_through(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for _, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, SF_DIR))
        assert docs.count() == 0


def test_odd_documents_do_not_stop_a_stage(spark, tmp_path):
    rows = [(1, None, None, None, None, 7), (1, None, "en", "s", 3, 7), (None, "", "", "", 0, None), (3, " ", "x", None, 1, 0),
            (4, "one two three four five six", "en", "s", 27, 1), (4, "one two three four five six", "en", "s", 27, 1)]
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, `_row.a` int"
    ).coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for name, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, SF_DIR))
        assert docs.count() == (5 if name in ("near duplicates", "decontamination", "byte BPE") else 6), name
