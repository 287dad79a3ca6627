"""Repeated runs of lines across documents: found in a suffix array over line numbers, later copies go.

A corpus is one long sequence of lines. Only lines that occur twice or more can be part of a
repeated run, so the suffix array covers stretches of those. It is built by prefix doubling: ranks
order suffixes by their first lines, at first by the hash of four, and the order of pairs of ranks ``n``
lines apart is that by 2 * n lines. Suffixes that share those lines with no other are dropped each time. A run
of lines is an interval of suffixes whose longest common prefix is at least that long; the ranks of
its first and of its last lines, as many as the largest power of two in it, name the interval; runs of
less than four lines are named by these. Runs
are of interest from a number of words on, and a line counts one at least: this bounds the lines of
a shortest run, and so the number of doublings, whatever the size of the corpus. Longer repeated
runs are unions of shortest ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dormouse.llm.spread import all_columns, free_name, kept, partitions, prefix_sums, quoted

# A repeated run is deleted from so many words on. A line counts its blanks and one.
MIN_WORDS = 30
# A line ends at a line feed, or at the blank after any sentence's end; both stay with the line.
LINE_END = r"(?<=\n)|(?<=[.!?] )"
_ENDS = ("\n", ". ", "! ", "? ")
_MARK = "\x01"
# Suffixes are first ranked by so many lines.
FIRST_STEP = 4
# Places of lines: the number of the document, then that of the line in so many bits.
LINE_BITS = 28


def lines(text: Column) -> Column:
    """The text in lines with their ends; joined, they are the text. A null is an empty line."""
    whole = F.coalesce(text, F.lit(""))
    marked = whole
    for end in _ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(end + _MARK))
    # Texts that hold the mark are split by the slower expression.
    return F.when(F.contains(whole, F.lit(_MARK)), F.split(whole, LINE_END, -1)).otherwise(F.split(marked, _MARK, -1))


def _every_line(documents: DataFrame, text: str, min_words: int) -> DataFrame:
    """Each line's hash and words (``min_words`` at most), with its document's ``row``. Kept.

    Lines are compared without the white space at their ends.
    """
    # In a select of its own, as the numbers would else be those of lines.
    rows = documents.select(F.monotonically_increasing_id().alias("row"), lines(F.col(quoted(text))).alias("lines"))
    split = rows.select("row", F.posexplode("lines").alias("line", "own"))
    # Trimming blanks alone is quicker; few lines end in more than that.
    blanks = F.rtrim("own")
    more = F.endswith(blanks, F.lit("\n")) | F.endswith(blanks, F.lit("\r")) | F.endswith(blanks, F.lit("\t"))
    bare = split.select("row", "line", F.when(more, F.rtrim("own", F.lit(" \n\r\t"))).otherwise(blanks).alias("bare"))
    words = "cast(least({}, 1 + octet_length(bare) - octet_length(replace(bare, ' ', ''))) as int)"
    return kept(
        bare.select(
            "row",
            F.col("line").cast("long").alias("line"),
            F.xxhash64("bare").alias("hash"),
            F.expr(words.format(min_words)).alias("own"),
        ),
        varied=["hash"],
    )


def _info(own: Column, last: Column, words: Column, forward: Column, backward: Column) -> Column:
    """A suffix's small numbers in one: words of its first, its last and all its lines, and lines of runs.

    ``forward`` is how many lines make the shortest run from its first line on, ``backward`` those of
    the one up to its last line; 0 if there is none, or if it is the shortest from its own first line on.
    """
    return own + 64 * last + 4096 * F.least(words, F.lit(4095)) + (1 << 24) * (forward + 64 * backward)


def _of_info(info: str) -> dict[str, Column]:
    """Its numbers again."""
    places = {"own": (0, 63), "last": (6, 63), "words": (12, 4095), "forward": (24, 63), "backward": (30, 63)}
    return {name: F.shiftright(info, place).bitwiseAND(F.lit(mask).cast("long")) for name, (place, mask) in places.items()}


def _stretches(documents: DataFrame, text: str, numbers: DataFrame, min_words: int) -> DataFrame:
    """Lines of stretches of neighbours that all occur elsewhere too, with enough words for a run. Kept.

    ``pos`` is the line's place in the corpus, ``rank`` and ``info`` are those of the suffix that begins
    there, by its first ``FIRST_STEP`` lines; null where the stretch has fewer left or they name no run.
    ``begun`` and ``ended`` are the shortest runs from this line on and up to it, as ``_runs`` has them,
    of fewer lines. All rows are about lines, so they are kept narrow.
    """
    every = _every_line(documents, text, min_words)
    again = every.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("hash")
    # Lines that occur twice are far fewer than all, and each is there once: a hash table for a part of them.
    shared = every.join(again.hint("shuffle_hash"), "hash", "left_semi").join(numbers.hint("shuffle_hash"), "row")
    pos = F.shiftleft("number", LINE_BITS) + F.col("line")
    shared = shared.select("row", pos.alias("pos"), "hash", "own")
    in_document = Window.partitionBy("row").orderBy("pos")
    so_far = in_document.rowsBetween(Window.unboundedPreceding, -1)
    shared = shared.select(
        "*",
        (F.col("pos") - F.row_number().over(in_document)).alias("stretch"),
        F.coalesce(F.sum("own").over(so_far), F.lit(0)).alias("start"),
    )
    # A line has a word at least, so starts rise, and tell lines apart. All is found in one order of the lines,
    # and frames that begin with the stretch only grow. ``upto`` lines begin less than a run's words after this
    # one's start, ``gone`` of them a run's words or more before it.
    stretch = Window.partitionBy("row", "stretch").orderBy("start")
    upto = stretch.rangeBetween(Window.unboundedPreceding, min_words - 1)
    gone = stretch.rangeBetween(Window.unboundedPreceding, -min_words)
    count, stop, last = F.count(F.lit(1)), F.col("start") + F.col("own"), FIRST_STEP - 1
    beside = shared.select(
        "*",
        count.over(upto).alias("upto"),
        F.max(stop).over(upto).alias("reach"),
        F.min("start").over(upto).alias("first"),
        count.over(gone).alias("gone"),
        F.max(stop).over(gone).alias("begin"),
        F.row_number().over(stretch).alias("nth"),
        *(F.lead("hash", n).over(stretch).alias(f"hash_{n}") for n in range(1, FIRST_STEP)),
        *(F.lag("hash", n).over(stretch).alias(f"before_{n}") for n in range(1, last)),
        *(F.lead(c, last).over(stretch).alias(f"{c}_last") for c in ("own", "start")),
    )
    none = F.lit(0).cast("long")
    forward = F.when(F.col("reach") - F.col("start") >= min_words, F.col("upto") - F.col("nth") + 1).otherwise(none)
    # The run from the last line gone to here is the shortest up to here if it is too short from ``begin`` on, one
    # line later; else the shortest up to here is the one from its own first line on.
    backward = F.when(stop - F.col("begin") < min_words, F.col("nth") - F.col("gone") + 1).otherwise(none)
    beside = beside.where((F.col("gone") > 0) | (F.col("reach") - F.col("first") >= min_words))
    beside = beside.select("*", forward.alias("forward"), backward.alias("backward"))
    beside = beside.drop("upto", "reach", "first", "gone", "begin", "nth")
    beside = beside.select("*", F.lead("backward", last).over(stretch).alias("backward_last"))

    def named(size: str, *runs: list[str]) -> Column:
        found = F.lit(None)
        for lines in runs:
            tail = F.xxhash64(*lines[1:]) if len(lines) > 2 else F.col(lines[-1])
            name = F.struct(F.col(size).alias("size"), F.col(lines[0]).alias("head"), tail.alias("tail"))
            found = F.when(F.col(size) == len(lines), name).otherwise(found)
        return found

    own, own_last = F.col("own").cast("long"), F.col("own_last").cast("long")
    words = F.col("start_last") + own_last - F.col("start")
    names_run = F.col("start_last").isNotNull() & (words - F.greatest(own, own_last) < min_words)
    first = ["hash", *(f"hash_{n}" for n in range(1, FIRST_STEP))]
    return kept(
        beside.select(
            "pos",
            F.when(names_run, F.xxhash64(*first)).alias("rank"),
            F.when(names_run, _info(own, own_last, words, F.col("forward"), F.col("backward_last"))).alias("info"),
            named("forward", ["hash"], ["hash", "hash_1"], ["hash", "hash_1", "hash_2"]).alias("begun"),
            named("backward", ["before_1", "hash"], ["before_2", "before_1", "hash"]).alias("ended"),
        ),
        varied=["pos", "rank"],
    )


def _short_runs(stretches: DataFrame) -> DataFrame:
    """The shortest runs of less than ``FIRST_STEP`` lines, as ``_runs`` has longer ones."""
    begin = stretches.where("begun IS NOT NULL").select("pos", "begun.*")
    end = stretches.where("ended IS NOT NULL").select((F.col("pos") - (F.col("ended.size") - 1)).alias("pos"), "ended.*")
    return begin.unionByName(end)


def _first_ranked(stretches: DataFrame) -> DataFrame:
    """The suffixes that share their first ``FIRST_STEP`` lines with another, ranked by the hash of these."""
    suffixes = stretches.where("rank IS NOT NULL").select("pos", "rank", "info")
    again = suffixes.groupBy("rank").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("rank")
    return suffixes.join(again.hint("shuffle_hash"), "rank", "left_semi").select("pos", "rank", "info")


def _looked_up(ranked: DataFrame, step: int, most: int) -> DataFrame:
    """Suffixes ranked by ``step`` lines, with what lies beside them. Kept.

    Runs of ``step`` to 2 * ``step`` - 1 lines, ``most`` at most, have two ranks, of their first and of
    their last ``step`` lines: ``tail`` is the other one of the run that begins here, ``head`` that of
    the run that ends with these lines. ``rank_next`` and ``info_next`` are those ``step`` lines on.
    Runs of more lines, and those with a rank that no other suffix has, have none.
    """
    small = _of_info("info")
    rows = ranked.select("pos", "rank", "info", F.shiftright("pos", LINE_BITS).alias("number"))
    in_document = Window.partitionBy("number").orderBy("pos")
    # Within lines that are all shared with others no row is missing, so a run that is repeated finds its own.
    rows = rows.withColumn("unbroken", F.col("pos") - F.row_number().over(in_document))
    unbroken = Window.partitionBy("number", "unbroken").orderBy("pos")

    def rank_of(size: Column, beside: Callable[[str, int], Column]) -> Column:
        found = F.lit(None).cast("long")
        for more in reversed(range(min(step, most - step + 1))):
            rank = beside("rank", more).over(unbroken) if more else F.col("rank")
            found = F.when(size == step + more, rank).otherwise(found)
        return found

    return kept(
        rows.select(
            "pos",
            "rank",
            "info",
            rank_of(small["forward"], F.lead).alias("tail"),
            rank_of(small["backward"], F.lag).alias("head"),
            F.lead("rank", step).over(unbroken).alias("rank_next"),
            F.lead("info", step).over(unbroken).alias("info_next"),
        ),
        varied=["pos"],
    )


def _runs(looked_up: DataFrame, step: int) -> DataFrame:
    """The shortest runs of ``step`` to 2 * ``step`` - 1 lines by the names of their intervals."""
    small = _of_info("info")
    begin = looked_up.where("tail IS NOT NULL").select(
        "pos", small["forward"].alias("size"), F.col("rank").alias("head"), "tail"
    )
    end = looked_up.where("head IS NOT NULL").select(
        (F.col("pos") - (small["backward"] - step)).alias("pos"),
        small["backward"].alias("size"),
        "head",
        F.col("rank").alias("tail"),
    )
    return begin.unionByName(end)


def _doubled(looked_up: DataFrame, min_words: int) -> DataFrame:
    """Of suffixes with two ranks, those that share the lines of both with another; ranked by these.

    A run's first or last lines are less than ``min_words`` words without the last or first of them.
    Suffixes whose lines are more than that either way name no run. The new ranks are the order of the
    pairs of ranks: numbers of rows dealt out and sorted by them, which rise from part to part.
    """
    small, after = _of_info("info"), _of_info("info_next")
    words = small["words"] + after["words"]
    info = _info(small["own"], after["last"], words, small["forward"], after["backward"])
    pairs = looked_up.where(
        F.col("rank_next").isNotNull() & (words - F.greatest(small["own"], after["last"]) < min_words)
    ).select("pos", "rank", "rank_next", info.alias("info"))
    order = ["rank", "rank_next"]
    again = pairs.groupBy(*order).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(*order)
    dealt = again.repartitionByRange(partitions(again.sparkSession), *order).sortWithinPartitions(*order)
    ordered = kept(dealt.select(*order, F.monotonically_increasing_id().alias("doubled")))
    return pairs.join(ordered.hint("shuffle_hash"), order).select("pos", F.col("doubled").alias("rank"), "info")


def _later_copies(runs: DataFrame) -> DataFrame:
    """Of runs of lines, those that an earlier equal run exists of."""
    interval = ["size", "head", "tail"]
    first = runs.groupBy(*interval).agg(F.min("pos").alias("first"), F.max("pos").alias("final"))
    # Kept, so that the join reads two plain shuffles, of which a hot interval's can be split. Intervals are
    # far fewer than runs, and each is there once: a hash table for a part of them.
    first = kept(first.where("first < final").drop("final"))
    later = runs.join(first.hint("shuffle_hash"), interval).where(F.col("pos") > F.col("first"))
    line = F.col("pos").bitwiseAND(F.lit((1 << LINE_BITS) - 1))
    return later.select(F.shiftright("pos", LINE_BITS).alias("number"), line.alias("line"), "size")


def repeated_runs(documents: DataFrame, text: str, order: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` and ``runs`` of each document with later copies: maximal spans of line numbers.

    ``row`` is what ``monotonically_increasing_id`` gives the document's row, so the documents have
    to be a table that reads the same every time: files or a kept table. They stand in the order of
    ``order``, then of where they were read. Places have room for 2^``LINE_BITS`` lines a text and
    2^35 texts. ``min_words`` is at most 60.

    A line is in a later copy if it is in one of the shortest runs of enough words that begin or
    end at some line, and an equal run stands earlier. Unions of these are the maximal runs.
    """
    numbers = documents.select(F.col(quoted(order)).alias("key"), F.monotonically_increasing_id().alias("row"))
    numbers = prefix_sums(numbers, ["key", "row"], {"number": F.lit(1).cast("long")}).select("row", "number")
    stretches = _stretches(documents, text, numbers, min_words)
    step, runs, ranked = FIRST_STEP, _short_runs(stretches), _first_ranked(stretches)
    while step <= min_words:
        looked_up = _looked_up(ranked, step, min_words)
        runs = runs.unionByName(_runs(looked_up, step))
        ranked = _doubled(looked_up, min_words) if 2 * step <= min_words else None
        step *= 2
    later = _later_copies(kept(runs, varied=["pos"]))
    in_document = Window.partitionBy("number").orderBy("line")
    end = F.col("line") + F.col("size")
    before = F.max(end).over(in_document.rowsBetween(Window.unboundedPreceding, -1))
    final = F.max(end).over(in_document.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # A span begins at a line beyond all earlier runs; what ended them before the next such line ends it.
    opened = later.select("number", "line", before.alias("before"), final.alias("final"))
    opened = opened.where("before IS NULL OR line > before")
    spans = opened.select(
        "number", F.col("line").alias("begin"), F.coalesce(F.lead("before").over(in_document), "final").alias("end")
    )
    found = spans.groupBy("number").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    return found.join(numbers, "number").select("row", F.array_sort("runs").alias("runs"))


def deduplicated(
    documents: DataFrame, text: str, order: str, runs: str, min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents without later copies of repeated runs of lines in their text.

    All columns stay; ``runs`` is added: the line numbers taken out, as spans ``begin`` to ``end``
    (exclusive), empty if none. The first copy, by ``order`` and then by place in the table, stays;
    nulls of ``order`` come first. Runs that overlap a copy of their own beginning lose all but that.
    A null text stays null, an empty one empty, and a document that is a copy throughout ends up
    empty. Of repeated rows all but the first are copies. A column named like ``runs`` is replaced.
    Runs count from ``min_words`` words on. An empty table gives an empty one.
    """
    rows = documents.drop(runs)
    row = free_name(rows, "_row")
    found = repeated_runs(documents, text, order, min_words).select(
        F.col("row").alias(row), F.col("runs").alias(runs)
    )
    own = rows.withColumn(row, F.monotonically_increasing_id()).join(found.hint("shuffle_hash"), row, "left")
    inside = f"exists(`{runs}`, s -> i >= s.begin and i < s.end)"
    split = free_name(own, "_lines")
    cut = own.withColumn(split, F.when(F.col(runs).isNotNull(), lines(F.col(text))))
    left = F.array_join(F.expr(f"filter(`{split}`, (x, i) -> not {inside})"), "")
    cut = cut.withColumn(text, F.when(F.col(runs).isNotNull() & F.col(text).isNotNull(), left).otherwise(F.col(text)))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    return cut.withColumn(runs, F.coalesce(F.col(runs).cast("array<struct<begin:bigint,end:bigint>>"), none)).select(
        *all_columns(rows), runs
    )
