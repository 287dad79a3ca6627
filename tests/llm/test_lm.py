from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dormouse.llm import lm, queries
from dormouse.llm.bytetext import Texts
from tests.llm.plain import blank_words, lower, odd_rows, table

SMALL = "/root/testdata/sf0.001"


def vocabulary_of(count=2048):
    return lm.Vocabulary(
        np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 1000, 10,
        np.full(lm.BEGINNINGS, 5), np.full(lm.BEGINNINGS, 2), np.arange(count, 0, -1),
    )


def wide_model():
    model = {name: a.astype(np.float64) for name, a in lm.initial(vocabulary_of()).items()}
    for name in ("class_weights", "word_weights"):
        model[name] *= 10
    return model


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = wide_model()
    given, wanted = rng.integers(0, lm.START + 1, (6, 3)), rng.integers(0, lm.START, (6, 3))
    fresh = np.zeros((6, 3), bool)
    fresh[0, 0] = fresh[3, 1] = True
    given[4:, 2], wanted[4:, 2], fresh[4:, 2] = lm.START, -1, True  # the last lane ends before the others
    state = rng.standard_normal((3, lm.STATE))
    _, slopes, _ = lm.window_slopes(model, given, wanted, fresh, state)
    head = int(wanted[(wanted >= 0) & (wanted < lm.WORDS)][0]) // lm.CLASS_WORDS
    for name in lm.SHAPES:
        for _ in range(4):
            place = tuple(int(rng.integers(0, n)) for n in model[name].shape)
            if name == "inputs":
                place = (int(rng.choice(given.ravel())), place[1])
            elif name.startswith("word"):
                place = (head, *place[1:])
            kept, losses = model[name][place], []
            for moved in (1e-3, -1e-3):
                model[name][place] = kept + moved
                losses.append(lm.window_slopes(model, given, wanted, fresh, state)[0])
            model[name][place] = kept
            assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(float(slopes[name][place]), abs=2e-3)


def test_output_in_parts_equals_the_whole_and_survives_large_logits(monkeypatch):
    model = lm.initial(vocabulary_of())
    rng = np.random.default_rng(4)
    states, wanted = rng.standard_normal((500, lm.STATE)), rng.integers(0, lm.START, 500)
    whole = lm.output(model, states, wanted)[0]
    monkeypatch.setattr(lm, "OUTPUT_ROWS", 7)
    assert np.allclose(lm.output(model, states, wanted)[0], whole)
    slopes = {name: np.zeros(shape) for name, shape in lm.SHAPES.items()}
    assert np.allclose(lm.output(model, states, wanted, slopes)[0], whole)
    large = {**model, "class_bias": model["class_bias"] + np.float32(2000)}
    assert np.allclose(lm.output(large, states, wanted)[0], whole, atol=0.01)


def test_words_are_found_by_their_first_bits():
    rng = np.random.default_rng(5)
    crowded = np.arange(50, dtype=np.uint64)  # all of the same first bits
    spread = rng.integers(1 << 40, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    for words in (np.unique(np.concatenate((crowded, spread, [np.uint64(2**64 - 1)]))), spread[:1], spread[:0]):
        counts = np.arange(len(words)) + 1
        vocabulary = lm.Vocabulary(words, counts, np.arange(len(words)), 1, 1, *[np.zeros(1)] * 3)
        asked = np.concatenate((words, spread[:9] + np.uint64(1), np.array([51, 2**64 - 2], np.uint64)))
        number, times = vocabulary.find(asked, np.zeros(len(asked), np.int32))
        assert times.tolist() == [*counts, *[-1] * 11]
        assert number.tolist() == [*range(len(words)), *[lm.WORDS] * 11]


def test_blocks_of_parameters_are_added_up():
    parts = [lm._blocks({0: np.full(3, i, float), 1: np.full(2, 10.0 * i)}, i) for i in (1, 2, 4)]
    found = {r["block"]: r for b in lm._added(iter(parts)) for r in b.to_pylist()}
    assert found == {0: {"block": 0, "values": [7.0] * 3, "weight": 7.0}, 1: {"block": 1, "values": [70.0] * 2, "weight": 7.0}}


def test_probabilities_of_all_numbers_sum_to_one():
    model = wide_model()
    state = np.random.default_rng(1).standard_normal((1, lm.STATE))
    every = np.arange(lm.START)
    found, _ = lm.output(model, np.repeat(state, lm.START, axis=0), every)
    assert np.exp(found).sum() == pytest.approx(1.0, abs=1e-4)


def test_states_are_carried_to_the_end_of_every_text():
    model = lm.initial(vocabulary_of())
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, lm.START, n) for n in (1, 5, 31, 32, 33, 100, 64, 1)]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    found = lm.log_probabilities(model, np.concatenate(texts), bounds)
    for text, value in zip(texts, found):
        state, total = np.zeros((1, lm.STATE), np.float32), 0.0
        for given, wanted in zip([lm.START, *text[:-1]], text):
            state = lm.step(model, np.array([given]), state)[0]
            total += lm.output(model, state, np.array([wanted]))[0][0]
        assert value == pytest.approx(total, rel=1e-4)


@pytest.mark.parametrize("lanes", [1, 3, 7, 1000])
def test_lanes_hold_every_token_once(lanes):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, lm.START, n) for n in (5, 1, 17, 2, 30)]
    given, wanted, fresh = lm.lanes_of(texts, lanes)
    flat = wanted.T.ravel()
    assert (flat[flat >= 0] == np.concatenate(texts)).all() and (flat[: (flat >= 0).sum()] >= 0).all()
    before = np.concatenate([[lm.START, *t[:-1]] for t in texts])
    assert (given.T.ravel()[flat >= 0] == before).all()
    assert fresh.T.ravel()[flat >= 0].sum() == len(texts)


def test_training_learns_a_pattern():
    model = lm.initial(vocabulary_of())
    texts = [np.tile([3, 200, 1500], 40) for _ in range(60)]
    bounds = np.array([0, 120])
    before = lm.log_probabilities(model, texts[0], bounds)[0]
    after = lm.log_probabilities(lm.trained(model, texts, rate=0.3), texts[0], bounds)[0]
    assert after > before / 3 > before


def test_base_scores_and_counts_equal_the_plain_version(spark):
    found = {r.doc_id: r for r in queries.op1_lm_scoring(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("out", queries.held_out("doc_id", 7)).collect()
    counts = Counter()
    for r in rows:
        if not r.out:
            counts.update([*blank_words(lower(r.text)), None])
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        words = [*blank_words(lower(r.text)), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        got = found[r.doc_id]
        assert (got.held_out, got.n_tokens, got.train_tokens) == (r.out, len(words), total)
        assert got.n_known == sum(counts[w] > 0 for w in words)
        assert got.base_score == pytest.approx(base, rel=1e-9) and got.score < 0
    kept_out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in kept_out) > sum(r.base_score for r in kept_out)


def test_odd_rows_and_empty_table(spark, tmp_path):
    docs = table(spark, tmp_path, odd_rows(), files=2, extra=True)
    counts = lm.word_counts(docs, "text")
    vocabulary = lm.Vocabulary.of(counts)
    model = lm.fit(docs, "text", "doc_id", vocabulary, rounds=1)
    found = lm.scored(docs, "text", "doc_id", counts, vocabulary, model).collect()
    assert len(found) == len(odd_rows())
    assert {r.n_tokens for r in found if r.key in (1, 2, 3)} == {1}
    assert all(r.n_known == r.n_tokens and r.score < 0 for r in found)
    none = docs.where(F.lit(False))
    counts = lm.word_counts(none, "text")
    vocabulary = lm.Vocabulary.of(counts)
    model = lm.fit(none, "text", "doc_id", vocabulary, rounds=1)
    assert lm.scored(none, "text", "doc_id", counts, vocabulary, model).count() == 0
    unseen = lm.scored(docs, "text", "doc_id", counts, vocabulary, model).collect()
    assert len(unseen) == len(odd_rows()) and all(r.n_known == 0 for r in unseen)


@pytest.mark.parametrize("tokens", [1000, 200_000_000])
def test_every_document_is_learnt_from_in_one_round_at_every_size(spark, tmp_path, monkeypatch, tokens):
    # Each text is one word, so that a trainer that takes part is told by the words it was given.
    rows = [(i, f"w{i}") for i in range(40)]
    docs = table(spark, tmp_path, rows)
    vocabulary = lm.Vocabulary.of(lm.word_counts(docs, "text"))
    vocabulary.tokens = tokens
    seen = str(tmp_path / "seen")

    def noted(model, numbers, rate=0.0):
        with open(seen, "a") as file:
            file.write("".join(f"{int(n[0])}\n" for n in numbers))
        return model

    monkeypatch.setattr(lm, "TRAINER_TOKENS", 20_000_000)
    monkeypatch.setattr(lm, "trained", noted)
    source = lm.in_tasks
    monkeypatch.setattr(lm, "in_tasks", lambda df, work, schema: source(df, _with(work, noted), schema))
    lm.fit(docs, "text", "doc_id", vocabulary)
    with open(seen) as file:
        assert sorted(map(int, file)) == sorted(vocabulary.number[vocabulary.number >= 0].tolist())[1:]


def _with(work, noted):
    def run(batches):
        from dormouse.llm import lm as own

        before, own.trained = own.trained, noted  # tasks run in processes of their own, which go on
        try:
            yield from work(batches)
        finally:
            own.trained = before

    return run


def test_powers_of_two_are_near_exact_over_their_range():
    y = np.concatenate((np.linspace(-99, 99, 100_001), np.arange(-99, 100) / 2)).astype(np.float32)
    found = y + np.float32(np.log2(lm._SCALE))
    lm._powers_of_two(found, np.empty((2, len(y)), np.float32))
    assert np.abs(found / 2.0 ** y.astype(float) - 1).max() < 2e-5  # 32 bits hold a number near 100 to 4e-6
    near = np.abs(y) < 8
    assert np.abs(found[near] / 2.0 ** y[near].astype(float) - 1).max() < 5e-6


@pytest.mark.parametrize("bias", [0, 2000])
def test_quick_output_equals_that_in_64_bits(bias):
    rng = np.random.default_rng(6)
    model = {name: a.astype(np.float32) for name, a in wide_model().items()}
    model["class_bias"] = model["class_bias"] + np.float32(bias)  # out of the quick powers' range
    exact = {name: a.astype(float) for name, a in model.items()}
    given, wanted = rng.integers(0, lm.START + 1, (20, 90)), rng.integers(0, lm.START, (20, 90))
    state = (rng.standard_normal((90, lm.STATE)) * 0.3).astype(np.float32)
    for fresh in (np.zeros((20, 90), bool), rng.random((20, 90)) < 0.1):
        loss, slopes, after = lm.window_slopes(model, given, wanted, fresh, state)
        loss64, slopes64, after64 = lm.window_slopes(exact, given, wanted, fresh, state.astype(float))
        assert loss == pytest.approx(loss64, rel=1e-4) and np.allclose(after, after64, atol=1e-5)
        for name, slope in slopes64.items():
            assert np.allclose(slopes[name], slope, atol=2e-3 * np.abs(slope).max())


def test_a_token_asks_for_a_class_and_a_number_in_it_only():
    # Beginnings are a class like those of words, so that no token needs a logit for each of them beside all classes.
    assert lm.SHAPES["class_bias"] == (lm.CLASSES,) and lm.SHAPES["word_bias"] == (lm.CLASSES, lm.CLASS_WORDS)
    assert lm.CLASSES + lm.CLASS_WORDS < 100 and lm.CLASSES * lm.CLASS_WORDS == lm.START


def test_hashes_end_in_the_beginning_of_the_word():
    hashes, bounds, shapes = lm.tokens(Texts.of(pa.array(["A b abc abcd é ABx", "", None, "abd abc"])))
    words = hashes != lm.END
    assert ((hashes & np.uint64(lm.BEGINNINGS - 1)) == shapes).all() and bounds.tolist() == [0, 7, 8, 9, 12]
    assert (~words).sum() == 4 and hashes[2] == hashes[10] and shapes[2] == shapes[3] and len(set(hashes[words])) == 7
    for text, shape in zip("A b abc abcd é ABx".split(), shapes):
        own = 0
        for byte in lower(text).encode()[:3]:
            own = own * 31 + byte
        assert shape == (own * 0x9E3779B1) % (1 << 32) >> 26


def test_texts_are_taken_together_by_size_and_by_number():
    words = [f"w{i} w{i + 1} z" for i in range(50)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 10)), pa.array(words[i : i + 10])], names=["key", "text"]) for i in range(0, 50, 10)]
    vocabulary = vocabulary_of(0)
    for limit, most, sizes in ((1 << 20, 100, [50]), (1 << 20, 20, [20, 20, 10]), (150, 100, [20, 20, 10])):
        found = list(lm._tokenised(iter(batches), "text", vocabulary, limit, most))
        assert [rows.num_rows for rows, *_ in found] == sizes
        for rows, numbers, bounds, (known, within, seen, rare), hashes in found:
            assert rows.column_names == ["key"] and bounds[-1] == len(numbers) == len(hashes) == 4 * rows.num_rows
            assert (rare == 4).all() and not seen.any() and not known.any() and (within < 0).all()
