"""A gated recurrent language model: numpy inside tasks, trained in parallel, scoring whole documents.

Words of the whole corpus are counted. The most frequent are predicted one by one: first a class of
64 words of like frequency, then the word among these, both from the state. All other words are told
by how they begin: their class has 64 beginnings, and within one a word has its share of the corpus'
counts, with one count more for each and one for all unknown words. So the model is a distribution
over all words, whatever the corpus' size.

Training starts from the counts (the state says nothing) and goes in rounds: every trainer makes
steps of truncated backpropagation on its own part of the round's documents, and the trainers'
parameters are averaged. Rounds share out all documents, so that each is learnt from once. In scoring, documents of a task advance side by side, window by
window, and their states are carried from window to window to the end of the longest.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dormouse.llm.bytetext import NOT_BLANK, Texts, slices
from dormouse.llm.spread import in_tasks, kept

# Words that are predicted one by one, numbers in a class, and beginnings of all other words.
WORDS, CLASS_WORDS, BEGINNINGS = 2048, 64, 64
STATE = 16
# Counts of words with at least this share of all tokens go to every task: so at most as many words.
FREQUENT_SHARE = 1 / (1 << 21)
# Tokens of a trainer.
TRAINER_TOKENS = 750_000
# Parameters of a trainer that are handed on in one row.
BLOCK = 1 << 12
ROUNDS, LANES, WINDOW, RATE = 3, 160, 20, 0.16
# Text of documents that advance side by side, about so many of them at most, and steps between two carryings of their states.
SCORED_BYTES, SCORED_TEXTS, SCORED_WINDOW = 32 << 20, 8192, 32
# Rows of the output layer that are worked on at a time, so that their logits stay in the cache.
OUTPUT_ROWS = 1024

_LOWERED = np.arange(256, dtype=np.uint32)
_LOWERED[0x41:0x5B] += 0x20
END = np.uint64(0)  # the hash that stands for the end of a text


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, each text's words and then its end; where texts begin; beginnings.

    A word's beginning is a number below ``BEGINNINGS`` that its first three bytes decide; the last
    bits of its hash are that number.
    """
    starts, ends = texts.runs(NOT_BLANK)
    words = texts.hashes(starts, ends, lower=True)
    begin = _LOWERED.take(texts.data.take(starts))
    for place in (1, 2):
        next_byte = _LOWERED.take(texts.data.take(starts + place, mode="clip"))
        next_byte += begin * np.uint32(31)
        np.copyto(begin, next_byte, where=starts + place < ends)
    begin = (begin * np.uint32(0x9E3779B1)) >> np.uint32(32 - BEGINNINGS.bit_length() + 1)
    words &= ~np.uint64(BEGINNINGS - 1)
    words |= begin
    words[words == END] = np.uint64(BEGINNINGS)
    owner = texts.of_positions(starts)
    at = np.arange(len(words)) + owner
    size = len(words) + len(texts)
    hashes, shapes = np.full(size, END, np.uint64), np.zeros(size, np.int32)
    hashes[at], shapes[at] = words, begin.astype(np.int32)
    counts = np.bincount(owner, minlength=len(texts)) + 1
    return hashes, np.concatenate(([0], np.cumsum(counts))), shapes


def word_counts(documents: DataFrame, text: str) -> DataFrame:
    """``word`` (hash), ``shape`` (its beginning) and ``count`` of every token. Kept.

    Tasks add up before they hand on, a bounded number of words at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = [], []
        pending = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            found, number = np.unique(np.concatenate(words), return_inverse=True)
            return found, np.bincount(number, np.concatenate(counts)).astype(np.int64)

        def batch_of(found, total) -> pa.RecordBatch:
            shape = (found & np.uint64(BEGINNINGS - 1)).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(shape), pa.array(total)], names=["word", "shape", "count"]
            )

        for batch in batches:
            for part in slices(batch, text):
                found, times = np.unique(tokens(Texts.of(part.column(0)))[0], return_counts=True)
                words.append(found)
                counts.append(times)
                pending += len(found)
                if pending > 1 << 20:
                    merged = summed()
                    if len(merged[0]) > 1 << 19:
                        yield batch_of(*merged)
                        words, counts, pending = [], [], 0
                    else:
                        words, counts = ([a] for a in merged)
                        pending = len(merged[0])
        if words:
            yield batch_of(*summed())

    rows = in_tasks(documents.select(text), count, "word bigint, shape int, count bigint")
    return kept(rows.groupBy("word").agg(F.min("shape").alias("shape"), F.sum("count").alias("count")))


@dataclass
class Vocabulary:
    """Counts of frequent words (by hash, in order), numbers of those predicted, and class totals."""

    words: np.ndarray
    counts: np.ndarray
    number: np.ndarray  # of each frequent word; -1 if it is not predicted by itself
    tokens: int
    distinct: int
    class_tokens: np.ndarray  # of the words that are not predicted by themselves, by beginning
    class_distinct: np.ndarray
    predicted_counts: np.ndarray
    starts: np.ndarray | None = None  # where words of the same first bits begin, once asked for

    @classmethod
    def of(cls, counts: DataFrame) -> Vocabulary:
        total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("word").alias("v")).first()
        least = max(1, int(total.n * FREQUENT_SHARE))
        # At most 1 / FREQUENT_SHARE words can have that share of all tokens.
        rows = counts.where(F.col("count") >= least).select("word", "shape", "count").toArrow()
        words = rows["word"].to_numpy().view(np.uint64)
        order = np.argsort(words)
        words, times = words[order], rows["count"].to_numpy()[order]
        shapes = rows["shape"].to_numpy()[order]
        top = np.lexsort((words, -times))[:WORDS]
        number = np.full(len(words), -1, np.int64)
        number[top] = np.arange(len(top))
        by_shape = counts.groupBy("shape").agg(F.sum("count").alias("n"), F.count("word").alias("v")).collect()
        class_tokens, class_distinct = np.zeros(BEGINNINGS, np.int64), np.zeros(BEGINNINGS, np.int64)
        for r in by_shape:
            class_tokens[r.shape], class_distinct[r.shape] = r.n, r.v
        class_tokens -= np.bincount(shapes[top], times[top], BEGINNINGS).astype(np.int64)
        class_distinct -= np.bincount(shapes[top], minlength=BEGINNINGS)
        return cls(words, times, number, int(total.n), int(total.v), class_tokens, class_distinct, times[top])

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is among the words, or else some place; and whether it is one of them.

        Words of the same first bits lie together, a few at most, as hashes are spread evenly.
        """
        bits = max(1, len(self.words).bit_length())
        shift = np.uint64(64 - bits)
        if self.starts is None:
            self.starts = np.searchsorted(self.words >> shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        first = (hashes >> shift).view(np.int64)
        at = self.starts.take(first)
        last = len(self.words) - 1
        found = self.words.take(at, mode="clip")
        more = np.flatnonzero(found < hashes)
        ends = self.starts[first[more] + 1] - 1
        while len(more):
            more, ends = (a[at[more] < ends] for a in (more, ends))
            at[more] += 1
            found[more] = self.words[at[more]]
            later = found[more] < hashes[more]
            more, ends = more[later], ends[later]
        return np.minimum(at, last, out=at), found == hashes

    def find(self, hashes: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token its number, and its count; -1 where the count is not among the frequent.

        Numbers from ``WORDS`` on are those of the classes by beginning.
        """
        if not len(self.words):
            return WORDS + shapes.astype(np.int64), np.full(len(hashes), -1, np.int64)
        at, known = self._place(hashes)
        number = np.where(known, self.number.take(at), -1)
        return np.where(number >= 0, number, WORDS + shapes), np.where(known, self.counts.take(at), -1)


# What is predicted has a number: words, then beginnings. So many numbers in turn are a class.
START = WORDS + BEGINNINGS
CLASSES = START // CLASS_WORDS

SHAPES = {
    "inputs": (START + 1, 3 * STATE),
    "recurrent": (STATE, 3 * STATE),
    "class_weights": (STATE, CLASSES),
    "class_bias": (CLASSES,),
    "word_weights": (CLASSES, STATE, CLASS_WORDS),
    "word_bias": (CLASSES, CLASS_WORDS),
}
Parameters = dict[str, np.ndarray]


def initial(vocabulary: Vocabulary) -> Parameters:
    """Small random weights, and biases that make the model predict by the counts."""
    random = np.random.default_rng(1)

    def drawn(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) * 0.15).astype(np.float32)

    heads, others = WORDS // CLASS_WORDS, BEGINNINGS // CLASS_WORDS
    model = {"inputs": drawn(*SHAPES["inputs"]), "recurrent": drawn(*SHAPES["recurrent"])}
    classes, _, words = drawn(STATE, heads + BEGINNINGS), drawn(heads + BEGINNINGS), drawn(heads, STATE, CLASS_WORDS)
    beginnings = classes[:, heads:].reshape(STATE, others, CLASS_WORDS).transpose(1, 0, 2)
    none = np.zeros((STATE, others), np.float32)
    model["class_weights"] = np.concatenate((classes[:, :heads], none), axis=1) * np.float32(0.1)
    model["word_weights"] = np.concatenate((words, beginnings)) * np.float32(0.1)
    counts = np.full(START, 1e-9)
    counts[: len(vocabulary.predicted_counts)] = vocabulary.predicted_counts
    counts[WORDS:] = vocabulary.class_tokens + vocabulary.class_distinct + 1.0
    by_class = counts.reshape(CLASSES, CLASS_WORDS)
    model["class_bias"] = np.log(by_class.sum(axis=1) / counts.sum()).astype(np.float32)
    model["word_bias"] = np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32)
    return model


def _gates(model: Parameters) -> tuple[np.ndarray, np.ndarray]:
    """The inputs and the recurrent weights of each gate, one after the other."""
    inputs, recurrent = (model[name].reshape(-1, 3, STATE).transpose(1, 0, 2) for name in ("inputs", "recurrent"))
    return np.ascontiguousarray(inputs), np.ascontiguousarray(recurrent)


def _room(rows: tuple[int, ...], lanes: int, kind: np.dtype) -> tuple[np.ndarray, ...]:
    """What ``_advanced`` fills in."""
    return tuple(np.empty((*rows, *gates, lanes, STATE), kind) for gates in ((3,), (2,), (), ()))


def _advanced(
    weights: tuple[np.ndarray, np.ndarray], given: np.ndarray, state: np.ndarray,
    x: np.ndarray, u: np.ndarray, gates: np.ndarray, new: np.ndarray, after: np.ndarray,
) -> None:
    """Fills in the state after the tokens, and what backpropagation needs; ``x`` is what they are to the gates."""
    inputs, recurrent = weights
    for own, filled in zip(inputs, x):
        own.take(given, axis=0, out=filled, mode="clip")
    np.matmul(state, recurrent, out=u)
    np.add(x[:2], u[:2], out=gates)
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(gates[1], u[2], out=new)
    new += x[2]
    np.tanh(new, out=new)
    np.subtract(state, new, out=after)
    after *= gates[0]
    after += new


def step(model: Parameters, given: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """The state after one token, and what backpropagation needs."""
    kind = np.result_type(model["inputs"], state)
    x = np.empty((3, len(given), STATE), kind)
    u, gates, new, after = _room((), len(given), kind)
    _advanced(_gates(model), given, state, x, u, gates, new, after)
    return after, gates, u[2], new


# 2^y = _SCALE * ((w + _B) * (w + y + _C) + _D) with w = y * (y + _A), to 3e-6 of itself where y is between -1/2 and 1/2.
_SCALE = 0.009570099964462186
_A, _B, _C, _D = (np.float32(x) for x in (2.421487778307111, 31.699068627974903, -14.880195072302335, 576.1803640778185))
# A number that is added to this is rounded to a whole one, which is then in the last bits of the sum.
_ROUNDING = np.float32(3 << 22)
# Powers of two up to here, and sums of them, are far within the range of 32 bits.
_FAR = 100


def _powers_of_two(y: np.ndarray, spare: np.ndarray) -> None:
    """In place, 2^y / ``_SCALE`` of 32-bit numbers within ``_FAR``, in few passes that numpy does several numbers at a time in.

    Its own exponential takes one number at a time on some machines. ``spare`` is room for as many numbers, twice.
    """
    whole, w = spare[0][: len(y)], spare[1][: len(y)]
    np.add(y, _ROUNDING, out=whole)
    np.subtract(whole, _ROUNDING, out=w)
    y -= w
    np.add(y, _A, out=w)
    w *= y
    w += _B
    y += w
    y += _C - _B
    y *= w
    y += _D
    exponents = whole.view(np.int32)
    np.left_shift(exponents, 23, out=exponents)
    bits = y.view(np.int32)
    bits += exponents


def output(model: Parameters, states: np.ndarray, wanted: np.ndarray, slopes: Parameters | None = None):
    """Log probability of each wanted number after its state; with ``slopes``, also d(-log p)/d state.

    Parameters' gradients are added to ``slopes``. Rows are put in the order of the wanted numbers, so
    that a class' rows lie together; weights have their biases as a last row, and states a 1.
    """
    order = np.argsort(wanted.astype(np.uint16), kind="stable")
    wanted = wanted[order]
    inputs = np.empty((len(wanted), STATE + 1), np.result_type(states, model["class_weights"]))
    inputs[:, :STATE] = states.take(order, axis=0)
    inputs[:, STATE] = 1
    weights = [
        np.concatenate((model["class_weights"], model["class_bias"][None]))[None],
        np.concatenate((model["word_weights"], model["word_bias"][:, None]), axis=1),
    ]
    farthest = max(np.abs(w).sum(axis=1).max() for w in weights) * max(inputs.max(initial=0), -inputs.min(initial=0))
    quick = inputs.dtype == np.float32 and farthest < _FAR * np.log(2)
    scaled = [w / np.float32(np.log(2)) if quick else w for w in weights]
    if quick:
        for w in scaled:
            w[:, STATE] += np.float32(np.log2(_SCALE))
    classes = wanted // CLASS_WORDS
    within = wanted - classes * CLASS_WORDS
    bounds = np.searchsorted(wanted, np.arange(CLASS_WORDS, START + 1, CLASS_WORDS)).tolist()
    out, found = np.empty(len(wanted)), np.zeros(len(wanted))
    if slopes is None:
        of_number = weights[0].transpose(2, 0, 1) + weights[1].transpose(0, 2, 1)
        found += np.einsum("ij,ij->i", inputs, of_number.reshape(START, STATE + 1).take(wanted, axis=0))
    else:
        gradients = [np.zeros(w.shape, inputs.dtype) for w in weights]
        down = np.empty((len(wanted), STATE), inputs.dtype)
        shares = np.ones(len(wanted), inputs.dtype)
    room = np.empty((3, OUTPUT_ROWS * max(CLASSES, CLASS_WORDS)), inputs.dtype)
    # Rows for their classes, then for the numbers of their class, some rows at a time.
    for level, ends in enumerate(([len(wanted)], bounds)):
        size = scaled[level].shape[2]
        of_level = np.ones(size, inputs.dtype)
        for begin in range(0, ends[-1], OUTPUT_ROWS):
            end = min(begin + OUTPUT_ROWS, ends[-1])
            flat = room[0, : (end - begin) * size]
            spread = flat.reshape(-1, size)
            parts, at = [], begin
            for c in range(bisect.bisect_right(ends, begin), len(ends)):
                if at == end:
                    break
                if ends[c] > at:
                    parts.append((c, slice(at, min(ends[c], end)), slice(at - begin, min(ends[c], end) - begin)))
                    at = parts[-1][1].stop
            for c, rows, own in parts:
                np.dot(inputs[rows], scaled[level][c], out=spread[own])
            if quick:
                _powers_of_two(flat, room[1:])
            else:  # less the largest, as exp of others might be out of range
                top = spread.max(axis=1)
                spread -= top[:, None]
                np.exp(flat, out=flat)
            total = spread @ of_level
            if slopes is None:
                found[begin:end] -= np.log(total)
                if not quick:
                    found[begin:end] -= top
                continue
            np.reciprocal(total, out=total)
            spread *= total[:, None]
            places = np.arange(0, len(flat), size)
            places += within[begin:end] if level else classes[begin:end]
            share = flat.take(places)
            flat[places] = share - 1
            shares[begin:end] *= share
            for c, rows, own in parts:
                gradients[level][c] += np.dot(inputs[rows].T, spread[own])
                back = np.dot(spread[own], weights[level][c, :STATE].T)
                if level:
                    down[rows] += back
                else:
                    down[rows] = back
    if slopes is None:
        out[order] = found
        return out, None
    out[order] = np.log(shares)
    slopes["class_weights"] += gradients[0][0, :STATE]
    slopes["class_bias"] += gradients[0][0, STATE]
    slopes["word_weights"] += gradients[1][:, :STATE]
    slopes["word_bias"] += gradients[1][:, STATE]
    back = np.empty_like(down)
    back[order] = down
    return out, back


def window_slopes(
    model: Parameters, given: np.ndarray, wanted: np.ndarray, fresh: np.ndarray, state: np.ndarray
) -> tuple[float, Parameters, np.ndarray]:
    """Loss and gradients of one window (steps by lanes), and the state after it.

    Where ``fresh``, a text begins and the state is empty. Nothing flows back before the window.
    """
    steps, lanes = given.shape
    kind = np.result_type(model["inputs"], state)
    weights = _gates(model)
    some = fresh.any(axis=1).tolist()
    before, x = np.empty((steps, lanes, STATE), kind), np.empty((3, lanes, STATE), kind)
    u, gates, new, states = _room((steps,), lanes, kind)
    for t in range(steps):
        before[t] = state
        if some[t]:
            before[t][fresh[t]] = 0
        state = states[t]
        _advanced(weights, given[t], before[t], x, u[t], gates[t], new[t], state)
    z, r, q = gates[:, 0], gates[:, 1], u[:, 2]
    slopes = {name: np.zeros(shape, np.float32) for name, shape in SHAPES.items()}
    inside = wanted >= 0  # the last lane may end before the others
    if inside.all():
        found, down = output(model, states.reshape(-1, STATE), wanted.ravel(), slopes)
        down = down.reshape(states.shape)
    else:
        down = np.zeros((steps, lanes, STATE), kind)
        found, down[inside] = output(model, states[inside], wanted[inside], slopes)
    # What a slope of the state becomes at the inputs of each gate, but for the products along the way.
    rest = 1 - z
    by_new = rest * (1 - new * new)
    by_z = rest
    by_z *= z
    by_z *= before - new
    by_r = q * r * (1 - r)
    to_new = np.empty((steps, lanes, STATE), kind)
    to_gates = np.empty((3, steps, lanes, STATE), kind)
    later = np.zeros((lanes, STATE), kind)
    back = np.ascontiguousarray(weights[1].transpose(0, 2, 1))
    by_gate = np.empty((3, lanes, STATE), kind)
    for t in reversed(range(steps)):
        slope = down[t]
        slope += later
        own, to_u = to_new[t], to_gates[:, t]
        np.multiply(slope, by_new[t], out=own)
        np.multiply(slope, by_z[t], out=to_u[0])
        np.multiply(own, by_r[t], out=to_u[1])
        np.multiply(own, r[t], out=to_u[2])
        np.matmul(to_u, back, out=by_gate)
        np.multiply(slope, z[t], out=later)
        for own in by_gate:
            later += own
        if some[t]:
            later[fresh[t]] = 0
    order = np.argsort(given.astype(np.uint16), axis=None, kind="stable")
    words = given.ravel()[order]
    first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
    rows = np.empty((len(words), 3 * STATE), kind)
    for gate, (to_u, to_x) in enumerate(zip(to_gates, (to_gates[0], to_gates[1], to_new))):
        columns = slice(gate * STATE, (gate + 1) * STATE)
        slopes["recurrent"][:, columns] += before.reshape(-1, STATE).T @ to_u.reshape(-1, STATE)
        rows[:, columns] = to_x.reshape(-1, STATE).take(order, axis=0)
    # Two numbers are added up as a complex one, in half as many additions.
    pairs = np.add.reduceat(rows.view(np.result_type(kind, np.complex64)), first)
    slopes["inputs"][words[first]] = pairs.view(kind)
    return -float(found.sum()), slopes, state


def lanes_of(numbers: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts dealt into lanes, text after text: tokens given, tokens wanted, and where texts begin.

    All lanes have equally many steps; what is left of the last one wants -1, and teaches nothing.
    """
    wanted = np.concatenate(numbers).astype(np.int64)
    lengths = np.array([len(n) for n in numbers])
    first = np.cumsum(lengths) - lengths
    given = np.empty(len(wanted), np.int64)
    given[1:] = wanted[:-1]
    given[first] = START
    fresh = np.zeros(len(wanted), bool)
    fresh[first] = True
    lanes = min(lanes, len(wanted))
    steps = -(-len(wanted) // lanes)
    rest = steps * lanes - len(wanted)
    padded = ((given, START), (wanted, -1), (fresh, True))
    return tuple(
        np.ascontiguousarray(np.concatenate((a, np.full(rest, fill, a.dtype))).reshape(lanes, steps).T)
        for a, fill in padded
    )


def trained(model: Parameters, numbers: list[np.ndarray], rate: float = RATE) -> Parameters:
    """The model after one pass over the texts by windows, each parameter's steps scaled by its slopes."""
    model = {name: a.copy() for name, a in model.items()}
    if not numbers:
        return model
    given, wanted, fresh = lanes_of(numbers, LANES)
    seen = {name: np.full(shape, 1e-6, np.float32) for name, shape in SHAPES.items()}
    state = np.zeros((given.shape[1], STATE), np.float32)
    for at in range(0, len(given), WINDOW):
        part = slice(at, at + WINDOW)
        _, slopes, state = window_slopes(model, given[part], wanted[part], fresh[part], state)
        learnt = int((wanted[part] >= 0).sum())
        met = np.zeros(len(model["inputs"]), bool)
        met[given[part]] = True
        met = np.flatnonzero(met)  # the only ones whose inputs have slopes
        for name, slope in slopes.items():
            rows = met if name == "inputs" else slice(None)
            slope = slope[rows]
            slope /= learnt
            past = seen[name][rows]
            past += slope * slope
            seen[name][rows] = past
            slope *= rate
            slope /= np.sqrt(past)
            model[name][rows] -= slope
    return model


def _flat(model: Parameters) -> np.ndarray:
    return np.concatenate([model[name].ravel() for name in SHAPES])


def _unflat(values: np.ndarray) -> Parameters:
    model, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        model[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return model


_BLOCKS = "block int, values array<double>, weight double"


def _blocks(values: dict[int, np.ndarray], weight: float | list[float]) -> pa.RecordBatch:
    """Rows of parameters in blocks, and their weights."""
    bounds = np.concatenate(([0], np.cumsum([len(v) for v in values.values()])))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(list(values.values()))))
    weights = np.broadcast_to(np.asarray(weight, float), len(values))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), pa.int32()), lists, pa.array(weights)], names=["block", "values", "weight"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the same number added up, and their weights; a task holds one of each of its numbers."""
    sums: dict[int, np.ndarray] = {}
    weights: dict[int, float] = {}
    for batch in batches:
        for block, values, weight in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            own = values.values.to_numpy()
            sums[block] = sums[block] + own if block in sums else own.copy()
            weights[block] = weights.get(block, 0.0) + weight
    if sums:
        yield _blocks(sums, list(weights.values()))


def fit(documents: DataFrame, text: str, key: str, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Parameters:
    """Parameters after rounds of parallel training on whole documents.

    A round takes the documents whose key and text hash into its share: at every size one part of as
    many as there are rounds, so that all documents are learnt from, each in one round. The trainers
    grow in number with the corpus and get near equal parts, and the average of their parameters,
    weighted by tokens, is made by a shuffle before it reaches the driver.
    """
    spark = documents.sparkSession
    model = initial(vocabulary)
    if not vocabulary.tokens:
        return model
    trainers = max(1, round(vocabulary.tokens / rounds / TRAINER_TOKENS))
    shared = spark.sparkContext.broadcast(vocabulary)
    hashed = F.xxhash64(F.col(key).cast("string"), F.col(text))
    for number in range(rounds):
        sample = documents.where(F.pmod(hashed, F.lit(rounds)) == number)
        dealt = sample.select(text, F.pmod(F.xxhash64(hashed, F.lit(number)), F.lit(trainers)).cast("int").alias("trainer"))
        now = spark.sparkContext.broadcast(model)

        def train(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            texts: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                for part in slices(batch, text):
                    hashes, bounds, shapes = tokens(Texts.of(part.column(0)))
                    found = shared.value.find(hashes, shapes)[0].astype(np.int32)
                    for i, trainer in enumerate(part.column(1).to_pylist()):
                        texts.setdefault(trainer, []).append(found[bounds[i] : bounds[i + 1]])
            for own in texts.values():
                weight = float(sum(map(len, own)))
                values = _flat(trained(now.value, own)).astype(np.float64) * weight
                yield _blocks(dict(enumerate(np.split(values, range(BLOCK, len(values), BLOCK)))), weight)

        # A trainer's number is that of its task, as hashes of them would give some tasks several and some none.
        apart = dealt.repartitionById(trainers, F.col("trainer")).sortWithinPartitions(F.xxhash64(text), text)
        steps = in_tasks(apart, train, _BLOCKS)
        # As many blocks as the model has.
        sums = in_tasks(steps.repartition("block"), _added, _BLOCKS).toArrow().sort_by("block")
        if sums.num_rows:
            weights = np.repeat(sums["weight"].to_numpy(), pc.list_value_length(sums["values"]).to_numpy())
            model = _unflat(pc.list_flatten(sums["values"]).to_numpy() / weights)
    return model


def log_probabilities(model: Parameters, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each text's numbers; texts advance side by side."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths, first = lengths[order], bounds[:-1][order]
    total = np.zeros(len(order))
    state = np.zeros((len(order), STATE), np.float32)
    weights = _gates(model)
    for at in range(0, int(lengths.max(initial=0)), SCORED_WINDOW):
        live = int(np.searchsorted(-sorted_lengths, -at))  # texts longer than ``at``
        state = state[:live]
        steps = min(SCORED_WINDOW, int(sorted_lengths[0]) - at)
        places = first[:live] + at + np.arange(steps)[:, None]
        inside = at + np.arange(steps)[:, None] < sorted_lengths[:live]
        places = np.where(inside, places, 0)
        wanted = numbers[places].astype(np.intp)
        given = np.where(inside, numbers[np.maximum(places - 1, 0)], START).astype(np.intp)
        if at == 0:
            given[0] = START
        states = np.empty((steps, live, STATE), np.float32)
        x = np.empty((3, live, STATE), np.float32)
        u, gates, new, _ = _room((), live, np.dtype(np.float32))
        for t in range(steps):
            _advanced(weights, given[t], state, x, u, gates, new, states[t])
            state = states[t]
        found, _ = output(model, states[inside], wanted[inside])
        total[:live] += np.bincount(np.nonzero(inside)[1], found, live)
    out = np.zeros(len(order))
    out[order] = total
    return out


def _tokenised(
    batches: Iterator[pa.RecordBatch], text: str, vocabulary: Vocabulary, limit: int, most: int
) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of about so many bytes of text or so many texts, their tokens' numbers and bounds, what the counts give, and rare words.

    The counts give for each row the sum of log10(count + 1) over its tokens, that of the shares of words
    in their beginnings, how many words are known, and how many are rare: not among the frequent ones.
    Only numbers and rare words are held for tokens.
    """
    class_total = np.log10(vocabulary.class_tokens + vocabulary.class_distinct + 1)
    held: list[tuple] = []
    size = texts_held = 0

    def together() -> tuple:
        rows, numbers, lengths, sums, rare = zip(*held)
        bounds = np.concatenate(([0], np.cumsum(np.concatenate(lengths))))
        return pa.Table.from_batches(rows), np.concatenate(numbers), bounds, np.concatenate(sums, axis=1), np.concatenate(rare)

    for batch in batches:
        for part in slices(batch, text):
            texts = Texts.of(part.column(text))
            hashes, bounds, shapes = tokens(texts)
            numbers, times = vocabulary.find(hashes, shapes)
            lengths = np.diff(bounds)
            of = np.repeat(np.arange(len(lengths)), lengths)
            known = np.log10(np.maximum(times, 0) + 1.0)
            rest = numbers >= WORDS
            within = known[rest] - class_total[numbers[rest] - WORDS]
            sums = [
                np.bincount(of[rows], values, len(lengths))
                for rows, values in ((slice(None), known), (rest, within), (times > 0, None), (times < 0, None))
            ]
            held.append((part.drop_columns([text]), numbers.astype(np.int32), lengths, np.stack(sums), hashes[times < 0]))
            size += len(texts.data)
            texts_held += len(texts)
            if size >= limit or texts_held >= most:
                yield together()
                held.clear()
                size = texts_held = 0
    if held:
        yield together()


def scored(
    documents: DataFrame, text: str, key: str, counts: DataFrame, vocabulary: Vocabulary, model: Parameters
) -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every whole text.

    Words that are not frequent meet their counts in a join; they are rare, so that no key of it is
    hot. A null or empty text is its end alone. Repeated rows are scored each.
    """
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary, model))
    rows = documents.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), text)
    base_total = np.log10(vocabulary.tokens + vocabulary.distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parameters = shared.value
        for table, numbers, bounds, (base, within, seen, rare), words in _tokenised(batches, text, own, SCORED_BYTES, SCORED_TEXTS):
            lengths = np.diff(bounds)
            value = log_probabilities(parameters, numbers, bounds) / np.log(10) + within
            lists = np.concatenate(([0], np.cumsum(rare)))
            yield pa.RecordBatch.from_arrays(
                [
                    table.column(0).combine_chunks(),
                    table.column(1).combine_chunks(),
                    pa.array(lengths),
                    pa.array(seen.astype(np.int64)),
                    pa.array(base - lengths * base_total),
                    pa.array(value),
                    pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), pa.array(words.view(np.int64))),
                ],
                names=["key", "row", "n_tokens", "n_known", "base_score", "score", "rare"],
            )

    kind = documents.schema[key].dataType.simpleString()
    partly = kept(
        in_tasks(
            rows,
            score,
            f"key {kind}, row bigint, n_tokens bigint, n_known bigint, base_score double, score double, rare array<bigint>",
        )
    )
    rare = partly.select("row", F.explode("rare").alias("word"))
    found = rare.join(counts.select("word", "count"), "word")
    added = found.groupBy("row").agg(
        F.sum(F.log10(F.col("count") + 1.0)).alias("more"), F.count(F.lit(1)).alias("seen")
    )
    more = F.coalesce("more", F.lit(0.0))
    return partly.join(added, "row", "left").select(
        "key",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
