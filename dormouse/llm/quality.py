"""Quality rules by host: what share of a host's documents fail, shrunk by a prior fitted to all hosts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.llm.bytetext import NOT_BLANK, Texts, byte_set, mixed, per_text, replaced, slices, windows
from dormouse.llm.spread import all_columns, in_tasks, kept, quoted

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
LINE = ~byte_set((0x0A, 0x0A))
WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
# Rules that count against a document's host only: symbols and repeated lines for its words, and mean word length.
MAX_SYMBOLS_PERCENT, MAX_DUP_LINES_PERCENT = 10, 5
MIN_WORD_CHARS, MAX_WORD_CHARS = 3, 10
# Documents that the prior of a host's rate counts for at least, however much hosts differ.
LEAST_STRENGTH = 4.0

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _first_in_text(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each item: how often its text has an equal one, and whether it is the first of these."""
    keys = mixed(hashes + mixed(text.astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(head) - 1
    count, first = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    count[order] = np.bincount(group, minlength=1)[group] if len(keys) else 0
    first[order] = head
    return count, first


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """The rules' measures of each text: words, their characters, symbols, repeated lines and words."""
    texts = Texts.of(column)
    starts, ends = texts.runs(NOT_BLANK)
    owner = texts.of_positions(starts)
    n_words = per_text(owner, len(texts))

    characters = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80, dtype=np.int64)))
    word_chars = np.bincount(owner, characters[ends] - characters[starts], len(texts))

    line_starts, line_ends = texts.runs(LINE)
    words_before = np.searchsorted(starts, line_starts)
    with_word = np.searchsorted(starts, line_ends) > words_before
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_owner = texts.of_positions(line_starts)
    _, first = _first_in_text(texts.hashes(line_starts, line_ends), line_owner)
    n_dup_lines = per_text(line_owner[~first], len(texts))

    found = windows(texts.hashes(starts, ends), WINDOW_WORDS)
    whole = owner[: len(found)] == owner[WINDOW_WORDS - 1 :] if len(found) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    count, _ = _first_in_text(found[at], owner[at])
    covered = np.zeros(len(starts) + 1, np.int64)
    again = at[count > 1]
    np.add.at(covered, again, 1)
    np.add.at(covered, again + WINDOW_WORDS, -1)
    repeated = np.cumsum(covered)[:-1] > 0
    return {
        "n_words": n_words,
        "word_chars": word_chars.astype(np.int64),
        "n_symbols": texts.per_text(SYMBOLS[texts.data]),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": per_text(owner[repeated], len(texts)),
    }


def document_measures(documents: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` and the measures of every whole text. A null text has no words, lines or symbols.

    Rows are measured by themselves, so repeated ones are alike, and an empty table gives an empty one.
    Other columns are not looked at; keys named like a measure have to be renamed before.
    """
    chosen = documents.select(*map(quoted, [*keys, text]))
    fields = ", ".join([f"{quoted(f.name)} {f.dataType.simpleString()}" for f in chosen.schema[: len(keys)]])
    schema = fields + "".join(f", {name} bigint" for name in MEASURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text):
                found = measures(rows.column(len(keys)))
                arrays = [rows.column(i) for i in range(len(keys))] + [found[m] for m in MEASURES]
                yield replaced(rows, [*keys, *MEASURES], arrays)

    return in_tasks(chosen, measure, schema)


def base_failed():
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Every measure has its rule; a document that breaks one counts against its host in that rule."""
    words = F.col("n_words")
    return {
        "base": base_failed(),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS_PERCENT * words,
        "lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINES_PERCENT * words,
        "letters": (F.col("word_chars") < MIN_WORD_CHARS * words) | (F.col("word_chars") > MAX_WORD_CHARS * words),
    }


def host_rates(rows: DataFrame, host: str, failed: Sequence[str]) -> DataFrame:
    """For each host and rule: documents, failures, and the failure rate shrunk by the rule's beta prior.

    ``failed`` names a boolean column for each rule; a null is no failure. The prior is fitted by
    moments to the rates of all hosts, each weighted by its documents: with mean m and variance v
    between hosts beyond what chance gives, its strength is m (1 - m) / v - 1, but
    ``LEAST_STRENGTH`` at least. Hosts that differ by no more than chance get a prior as strong as
    all documents, so that every host gets the mean. ``rate_low`` is the rate less two deviations of
    its posterior. A null host is a host of its own; no rows give no hosts.
    """
    own = rows.select(F.col(quoted(host)).alias("host"), *(F.col(quoted(f)).alias(f"f{i}") for i, f in enumerate(failed)))
    counted = own.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(f"f{i}").alias(f"f{i}") for i in range(len(failed)))
    )
    each = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"f{i}").alias("k")) for i, name in enumerate(failed)))
    hosts = counted.select("host", "n", F.inline(each))
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    sums = hosts.groupBy("rule").agg(
        F.sum(n).alias("all_n"), F.sum(k).alias("all_k"), F.count(F.lit(1)).alias("hosts"),
        F.sum(k * k / n).alias("squares"), F.sum(n * n).alias("sizes"),
    )
    mean = F.col("all_k") / F.col("all_n")
    chance = mean * (1 - mean)
    # Moments of rates over groups of unequal size: the spread between hosts beyond chance.
    spread = F.col("squares") - F.col("all_k") * mean - (F.col("hosts") - 1) * chance
    scale = F.col("all_n") - F.col("sizes") / F.col("all_n") - (F.col("hosts") - 1)
    variance = F.when((F.col("hosts") > 1) & (scale > 0), F.greatest(spread / scale, F.lit(0.0)))
    strength = F.when(variance > 0, F.greatest(chance / variance - 1, F.lit(LEAST_STRENGTH)))
    priors = sums.select("rule", mean.alias("prior_mean"), F.coalesce(strength, F.col("all_n")).alias("prior_strength"))
    a = k + F.col("prior_mean") * F.col("prior_strength")
    b = n + F.col("prior_strength") - a
    rates = hosts.join(priors, "rule").withColumn("rate", a / (a + b))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (a + b + 1))
    return rates.withColumn("rate_low", F.col("rate") - 2 * deviation)


def host_verdicts(
    rows: DataFrame, host: str, failed: Sequence[str], reject_rate: float = 0.5, result: str = "verdict"
) -> DataFrame:
    """Rows with all columns, and ``result``: their host's ``documents``, ``failed`` and ``rejected``.

    ``failed`` lists the host's failures by rule, in the rules' order. A host is rejected if even
    its low estimate in some rule is over the rate. It is judged by its documents alone, so a clean
    document of a rejected host goes too; the two deviations keep small hosts, of which little is
    known. The rows are kept, as they are read twice. A hot host's rows meet its verdict in a join
    that splits it, or that broadcasts the verdicts where they are few. Columns may have any names;
    one named like ``result`` is replaced. Repeated rows count each time, and an empty table stays so.
    """
    rows = kept(rows.drop(result))
    by_rule = host_rates(rows, host, failed)
    order = F.array(*map(F.lit, failed))
    verdicts = by_rule.groupBy("host").agg(
        F.first("n").alias("documents"),
        F.array_sort(F.collect_list(F.struct(F.array_position(order, F.col("rule")).alias("at"), "k"))).alias("failed"),
        F.max(F.col("rate_low") > reject_rate).alias("rejected"),
    )
    verdicts = verdicts.select(
        F.col("host").alias("judged"),
        F.struct("documents", F.transform("failed", lambda f: f["k"]).alias("failed"), "rejected").alias("verdict"),
    )
    packed = rows.select(F.col(quoted(host)).alias("host"), F.struct(*all_columns(rows)).alias("own"))
    joined = packed.join(verdicts, F.col("host").eqNullSafe(F.col("judged")))
    return joined.select("own.*", F.col("verdict").alias(result))
