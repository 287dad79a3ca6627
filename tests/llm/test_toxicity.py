from __future__ import annotations

import random

import pyarrow as pa
import pytest

from dormouse.llm import queries, toxicity
from dormouse.llm.bytetext import Texts
from tests.llm.plain import odd_rows, table


def made(count, seed=1):
    choose = random.Random(seed)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(count):
        sentences = [" ".join(choose.choices(words, k=8)) for _ in range(choose.randint(1, 12))]
        toxic = i % 4 == 0
        if toxic:
            at = choose.randrange(len(sentences))
            sentences[at] += " " + choose.choice(["vilething", "vileword", "nastybit"])
        rows.append((i, ". ".join(sentences) + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = made(600)
    return toxicity.fit(pa.chunked_array([[t for _, t, _ in rows]]), pa.array([y for *_, y in rows]).to_numpy())


def test_labels_of_documents_teach_sentences(model):
    rows = made(400, seed=2)
    texts = Texts.of(pa.array([t for _, t, _ in rows]))
    own = toxicity.bag(texts)
    score, sentence = model.score(own, len(texts))
    wrong = sum((s >= toxicity.THRESHOLD) != bool(y) for s, (*_, y) in zip(score, rows))
    assert wrong <= 4
    blamed = [texts.data[own.begins[i] : own.ends[i]].tobytes().decode() for i in (sentence >= 0.5).nonzero()[0]]
    assert blamed and all(any(w in s for w in ("vilething", "vileword", "nastybit")) for s in blamed)


def test_score_is_the_noisy_or_and_harmless_sentences_do_not_add_up(model):
    text = "a vilething here. " + "nothing of note. " * 5000
    texts = Texts.of(pa.array([text, "nothing of note. " * 5000, "", None]))
    own = toxicity.bag(texts)
    score, sentence = model.score(own, 4)
    alone = 1 - sentence[own.owner == 0]
    assert score[0] == pytest.approx(1 - alone.prod(), abs=1e-9) and score[0] > 0.5
    assert score[1:].max() < 0.05 and score[2] == score[3] == 0


def test_tables(spark, tmp_path, model):
    rows = odd_rows() + [(60, "ä fine one. You vilething!\nBye")]
    docs = table(spark, tmp_path, rows, files=2, extra=True)
    out = toxicity.scored(docs, "text", model, "found")
    assert out.columns == [*docs.columns, "found"] and out.count() == len(rows)
    span, = out.where("doc_id = 60").first().found.spans
    assert rows[-1][1][span.begin : span.end] == " You vilething"
    assert all(0 <= r.found.score < 0.3 for r in out.where("doc_id is null or doc_id <> 60").collect())
    assert toxicity.scored(docs.where("false"), "text", model, "found").count() == 0


def test_training_tables(spark):
    rows = made(300)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(0, rows[0][1]), (999, None)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, y) for k, _, y in rows] + [(999, 1), (None, 1), (5, None), (1, 1), (2, 0)], "doc_id long, toxic int"
    )
    trained = toxicity.train(docs, "doc_id", "text", labels, "doc_id", "toxic")
    assert len(trained.features) > 0
    bounded = toxicity.train(docs, "doc_id", "text", labels, "doc_id", "toxic", 20, 20)
    assert bounded.bias < 0
    none = toxicity.train(docs, "doc_id", "text", labels.where("false"), "doc_id", "toxic")
    assert len(none.features) == 0
    harmless, = none.score(toxicity.bag(Texts.of(pa.array(["a b c"]))), 1)[0]
    assert harmless < 0.01


def test_held_out_rows_are_judged_well(spark):
    path = "/root/testdata/sf0.1"
    found = queries.op4_toxicity(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    right = {
        (r.toxic, r.predicted): r["count"]
        for r in found.where("held_out").groupBy("toxic", "predicted").count().collect()
    }
    assert right[1, 1] >= 0.85 * (right[1, 1] + right.get((1, 0), 0))
    assert right[0, 0] >= 0.97 * (right[0, 0] + right.get((0, 1), 0))
