"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

Only documents have labels. A sentence's score is a logistic function of its words and of their
beginnings; a document's score is the noisy-or of its sentences', 1 - prod(1 - p). The gradient of
the document's likelihood hands the blame to the sentences that explain the label, and those are
what the model then points at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dormouse.llm.bytetext import LETTERS, Texts, byte_set, slices
from dormouse.llm.spread import in_tasks, named, quoted, undotted

SENTENCE = ~byte_set((0x0A, 0x0A), (0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
# A word counts as itself and by its first bytes, if it has more.
BEGINNINGS = (4, 6)
THRESHOLD = 0.3

# The model is fitted to at most so many labelled documents of each kind.
MAX_TOXIC, MAX_CLEAN = 2000, 4000
EPOCHS, RATE, PENALTY, FIRST_BIAS = 100, 0.5, 3e-4, -8.0
# A feature needs so many documents of the sample.
MIN_DOCUMENTS = 3
_COUNTED = 1 << 22


@dataclass
class Bag:
    """Sentences of texts: their byte ranges, their text, and features with the sentence of each."""

    begins: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    feature: np.ndarray
    sentence: np.ndarray


def bag(texts: Texts) -> Bag:
    begins, ends = texts.runs(SENTENCE)
    starts, stops = texts.runs(LETTERS)
    sentence = np.searchsorted(begins, starts, "right") - 1
    hashes, sentences = [texts.hashes(starts, stops, lower=True)], [sentence]
    for kind, size in enumerate(BEGINNINGS, 1):
        longer = stops - starts > size
        found = texts.hashes(starts[longer], starts[longer] + size, lower=True)
        hashes.append(found ^ np.uint64(kind))
        sentences.append(sentence[longer])
    # A feature counts once in a sentence, however often it stands there.
    feature, sentence = np.concatenate(hashes), np.concatenate(sentences)
    order = np.lexsort((feature, sentence))
    feature, sentence = feature[order], sentence[order]
    new = np.ones(len(feature), bool)
    new[1:] = (feature[1:] != feature[:-1]) | (sentence[1:] != sentence[:-1])
    return Bag(begins, ends, texts.of_positions(begins), feature[new], sentence[new])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Model:
    """Weights of the features that have one; ``features`` are their hashes in order."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def sentence_logits(self, own: Bag) -> np.ndarray:
        if not len(self.features):
            return np.full(len(own.begins), self.bias)
        at = np.minimum(np.searchsorted(self.features, own.feature), len(self.features) - 1)
        known = np.flatnonzero(self.features[at] == own.feature)
        added = np.bincount(own.sentence[known], self.weights[at[known]], len(own.begins))
        return self.bias + added

    def score(self, own: Bag, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each text the noisy-or, and of each sentence its own probability. No sentence: 0.

        What a sentence without any known feature would get is taken off, or else thousands of
        harmless sentences would add up.
        """
        z = self.sentence_logits(own)
        none = np.maximum(0, np.logaddexp(0, z) - np.logaddexp(0, self.bias))
        return -np.expm1(-np.bincount(own.owner, none, count)), -np.expm1(-none)


def _features(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts of sentences; then of each occurrence of a feature its sentence and number; the features.

    Only features of enough texts stay. A table of counts by hash leaves most others out early.
    """
    rows = pa.Table.from_arrays([texts], names=["t"])
    parts = [part for batch in rows.to_batches() for part in slices(batch, "t")]
    seen = np.zeros(_COUNTED, np.int32)
    for part in parts:
        own = bag(Texts.of(part.column(0)))
        document = own.owner[own.sentence].astype(np.uint64)
        pairs = np.unique(document << np.uint64(40) | own.feature % np.uint64(_COUNTED))
        np.add.at(seen, (pairs & np.uint64(_COUNTED - 1)).astype(np.int64), 1)
    owners, sentences, features = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    first_text, first_sentence = 0, 0
    for part in parts:
        own = bag(Texts.of(part.column(0)))
        often = seen[(own.feature % np.uint64(_COUNTED)).astype(np.int64)] >= MIN_DOCUMENTS
        owners.append(own.owner + first_text)
        sentences.append(own.sentence[often] + first_sentence)
        features.append(own.feature[often])
        first_text += part.num_rows
        first_sentence += len(own.begins)
    owner, sentence = np.concatenate(owners), np.concatenate(sentences)
    features, number = np.unique(np.concatenate(features), return_inverse=True)
    pairs = np.unique(owner[sentence] * len(features) + number) % max(1, len(features))
    used = np.bincount(pairs, minlength=len(features)) >= MIN_DOCUMENTS
    keep = used[number]
    return owner, sentence[keep], features[used], (np.cumsum(used) - 1)[number[keep]]


def fit(texts: pa.ChunkedArray, toxic: np.ndarray, clean_weight: float = 1.0) -> Model:
    """Full-batch steps on the noisy-or likelihood, each scaled by the gradients so far.

    ``clean_weight`` makes up for clean documents left out of the sample. A penalty on the sizes of
    the weights takes those of features that say little to 0.
    """
    owner, sentence, features, number = _features(texts)
    count = len(toxic)
    weight = np.where(toxic > 0, 1.0, clean_weight)
    total = max(1.0, weight.sum())
    weights, bias = np.zeros(len(features)), FIRST_BIAS
    seen, seen_bias = np.full(len(features), 1e-8), 1e-8
    for _ in range(EPOCHS):
        z = bias + np.bincount(sentence, weights[number], len(owner))
        p = _sigmoid(z)
        none = np.bincount(owner, np.logaddexp(0, z), count)
        some = np.maximum(-np.expm1(-none), 1e-9)
        # d(-log likelihood)/dz: p for clean documents, -p (1 - some) / some for toxic ones
        share = np.where(toxic > 0, -np.exp(-none) / some, 1.0) * weight
        by_sentence = p * share[owner]
        gradient = np.bincount(number, by_sentence[sentence], len(features)) / total
        slope = float(by_sentence.sum()) / total
        seen += gradient**2
        seen_bias += slope**2
        step = RATE / np.sqrt(seen)
        weights -= step * gradient
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - step * PENALTY)
        bias -= RATE * slope / seen_bias**0.5
    some = weights != 0
    return Model(features[some], weights[some], bias)


def train(
    documents: DataFrame,
    key: str,
    text: str,
    labels: DataFrame,
    label_key: str,
    label: str,
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
) -> Model:
    """A model of the labelled documents, or of a bounded sample of either kind where they are more.

    The sample is the documents whose keys hash lowest. Null keys and labels are left out, as are
    keys with contradicting labels; without any toxic document every score is close to 0.
    """
    own = labels.select(F.col(label_key).alias("k"), (F.col(label) > 0).cast("int").alias("y"))
    own = own.dropna().groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
    chosen = [
        own.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(most).select("k", "y")
        for y, most in ((1, max_toxic), (0, max_clean))
    ]
    ids = chosen[0].unionByName(chosen[1])
    texts = documents.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    # One text for each of the chosen keys, so the task that fits gets no more rows than the bounds say.
    sample = texts.join(F.broadcast(ids), "k").groupBy("k", "y").agg(F.min("t").alias("t"))
    there = {r.y: r.n for r in own.groupBy("y").agg(F.count("k").alias("n")).collect()}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, pa.schema([("y", pa.int32()), ("t", pa.string())]))
        toxic = rows["y"].to_numpy().astype(np.int64)
        taken = np.maximum(1, np.bincount(toxic, minlength=2))
        weight = (there.get(0, 0) / taken[0]) / max(1.0, there.get(1, 0) / taken[1])
        model = fit(rows["t"], toxic, weight or 1.0)
        features = np.append(model.features, np.uint64(0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(features.view(np.int64)),
                pa.array(np.append(model.weights, model.bias)),
                pa.array(np.arange(len(features)) == len(features) - 1),
            ],
            names=["feature", "weight", "bias"],
        )

    ordered = sample.repartition(1).sortWithinPartitions("k").select("y", "t")
    # The features of a bounded sample that have a weight, and the bias.
    rows = in_tasks(ordered, learn, "feature bigint, weight double, bias boolean").collect()
    features = np.array([r.feature for r in rows if not r.bias], np.int64).view(np.uint64)
    bias = next((r.weight for r in rows if r.bias), FIRST_BIAS)
    return Model(features, np.array([r.weight for r in rows if not r.bias]), bias)


def scored(documents: DataFrame, text: str, model: Model, result: str, threshold: float = THRESHOLD) -> DataFrame:
    """All columns, and a struct ``result``: ``score``, and the offending sentences as ``spans``.

    A span has its ``begin`` and ``end`` in code points and its ``probability``; its sentence alone
    reaches the threshold. A null or empty text scores 0. A column named like ``result`` is replaced.
    """
    rows, plain = undotted(documents.drop(result))
    text = plain[text]
    shared = documents.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(span))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = Texts.of(part.column(text))
                own = bag(texts)
                score, probability = shared.value.score(own, len(texts))
                found = [{"score": float(s), "spans": []} for s in score]
                for i in np.flatnonzero(probability >= threshold):
                    owner = int(own.owner[i])
                    lead = (texts.data[texts.offsets[owner] : own.ends[i]] & 0xC0) != 0x80
                    size = int(np.count_nonzero(lead[own.begins[i] - texts.offsets[owner] :]))
                    end = int(np.count_nonzero(lead))
                    found[owner]["spans"].append(
                        {"begin": end - size, "end": end, "probability": float(probability[i])}
                    )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, kind)], names=[*part.schema.names, result]
                )

    spans = "array<struct<begin:int,end:int,probability:double>>"
    schema = f"{named(rows)}, {quoted(result)} struct<score:double,spans:{spans}>"
    return in_tasks(rows, judge, schema).toDF(*plain, result)
