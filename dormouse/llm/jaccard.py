"""Exact Jaccard join of documents as sets of word n-grams, by a partition of the universe of n-grams.

Sets are dealt into size bands. In a band, a hash deals all n-grams into m segments. Two sets whose
symmetric difference is at most H differ in at most H segments, so with m > H segments at least
m - H of their segment subsets are equal (and with one-deletion neighbourhoods, half as many
segments do). Subsets are indexed by hash; sets that meet often enough are verified exactly.

Equal sets are one class and take part once. Of an index entry with many sets, only pairs with its
first set are verified at first, a bounded number for each set, which joins true copies in linear time. What that leaves in
different components is gone through once more by their rarest n-grams, compared in blocks of
bounded size by counts that bound the difference, and verified. So no entry is cut off, and none is
expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dormouse.llm.bytetext import NOT_BLANK, Texts, mixed, slices, windows
from dormouse.llm.components import components
from dormouse.llm.spread import all_columns, free_name, in_tasks, kept, partitions

SHINGLE_WORDS = 5
PERCENT = 75
# Counts of n-grams by hash that bound the symmetric difference of two sets from below.
SKETCH = 128
# First classes of entries that a class is verified with before components are looked at.
FIRSTS = 16
# Members of an index entry that are compared with each other in one go.
BLOCK = 512
# Widths of size bands, in percent of the next band; the largest set that there is a band for.
BAND_PERCENT, LARGEST = 70, 1 << 30
# What a row of an entry that several classes have costs, in index rows.
SHARED_COST = 3
# N-grams whose index rows a task of the index gets at most, on average.
TASK_GRAMS = 2_500_000

_SALT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(column: pa.Array, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, in order, and where each text's begin (one more than texts).

    Words are lower-cased in A-Z. A text of fewer words has one n-gram, its whole sequence.
    """
    texts = Texts.of(column)
    starts, ends = texts.runs(NOT_BLANK)
    words = texts.hashes(starts, ends, lower=True)
    owner = texts.of_positions(starts)
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    grams = windows(words, size)
    at = np.flatnonzero(owner[: len(grams)] == owner[size - 1 :]) if len(grams) else np.zeros(0, np.int64)
    hashes, of = [grams[at]], [owner[at]]
    for few in range(1, size):
        short = np.flatnonzero(count == few)
        hashes.append(mixed(windows(words, few)[first[short]] + np.uint64(few)))
        of.append(short)
    hashes, of = np.concatenate(hashes), np.concatenate(of)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    return hashes, np.searchsorted(of, np.arange(len(texts) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between bounds, modulo 2^64."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def classes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number for each set, equal for equal sets."""
    sizes = np.diff(bounds).astype(np.uint64)
    return mixed(mixed(_sums(mixed(hashes ^ _SALT), bounds) + sizes) + sizes).view(np.int64)


def _slack(needed: int, size: int, deleted: int) -> int:
    """Segments beyond the needed ones, as many as are void in sets of that size but for rare ones.

    More segments hold less, so that more of them are void. Where no number of them is enough, as
    for sets of a few n-grams, sets with more void segments are not rare.
    """

    def enough(spare: int) -> bool:
        m = needed + spare
        empty = m * (1 - 1 / m) ** size
        single = size * (1 - 1 / m) ** (size - 1) if deleted else 0.0
        both = m * (m - 1) * (1 - 2 / m) ** size if m > 1 else 0.0
        spread = max(0.0, empty + both - empty * empty) ** 0.5 + single**0.5
        return empty + single + 2.5 * spread <= spare

    low, high = 0, 2 * needed + 8
    if enough(low) or not enough(high):
        return low if enough(low) else needed
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(middle) else (middle + 1, high)
    return low


@dataclass
class Bands:
    """Size bands, and for each the segments, the slack and the neighbourhoods that it uses.

    ``deletions`` is 1 where subsets are indexed with all that lack one of their n-grams.
    """

    percent: int
    first: np.ndarray
    segments: np.ndarray
    slack: np.ndarray
    deletions: np.ndarray

    @classmethod
    def of(cls, percent: int, deletions: dict[int, int] | None = None) -> Bands:
        """A band has the smaller sets of pairs; the larger ones take part in it as well.

        A void segment (empty, or with deletions of at most one n-gram) tells nothing, so there are
        ``slack`` segments more than the pigeonhole needs: as many as a set is likely to have void.
        """
        first = [1]
        while first[-1] <= LARGEST:
            first.append(max(first[-1] + 1, -(-first[-1] * 100 // BAND_PERCENT)))
        segments, slack = [], []
        deletions_of = [(deletions or {}).get(b, 0) for b in range(len(first) - 1)]
        for b, deleted in enumerate(deletions_of):
            smaller = first[b + 1] - 1
            larger = smaller * 100 // percent
            differ = (100 - percent) * (smaller + larger) // (100 + percent)
            needed = differ // (deleted + 1) + 1
            spare = _slack(needed, first[b], deleted)
            segments.append(needed + spare)
            slack.append(spare)
        numbers = (np.array(a, np.int64) for a in (first, segments, slack, deletions_of))
        return cls(percent, *numbers)

    def trial(self) -> np.ndarray:
        """How many segments of each band are tried to tell what the band will cost."""
        return np.minimum(self.segments, np.maximum(4, self.segments // 24))

    def of_sizes(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last band that sets of these sizes take part in: with a smaller set, and as one."""
        least = -(-sizes * self.percent // 100)
        low = np.searchsorted(self.first, least, "right") - 1
        return low, np.searchsorted(self.first, sizes, "right") - 1


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def index_rows(
    hashes: np.ndarray, bounds: np.ndarray, bands: Bands, trial: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of sets, and the set's place of each.

    An entry has 48 bits of hash, 6 of the band, and 10 that say how many entries of the band the
    set shares with each partner at least.

    A pair within the threshold shares slack + 1 segments that differ by no more than the allowed
    deletions. Those that are void in one set are so in the other, for what they differ by. So a
    set with no more void segments than the slack shares at least slack + 1 less those with each
    partner. A set with more needs nothing, and also indexes its void segments, as would its partner.
    """
    sizes = np.diff(bounds)
    filled = np.flatnonzero(sizes)
    low, high = bands.of_sizes(sizes[filled])
    of = np.repeat(filled, high - low + 1)
    band = _ranges(low, high - low + 1)
    size = sizes[of]
    token = _ranges(bounds[:-1][of], size)
    pair = np.repeat(np.arange(len(of)), size)
    m = bands.segments[band]
    offset = np.cumsum(m) - m
    dealt = mixed(hashes[token] + mixed((band + 1).astype(np.uint64) * _SALT)[pair]) >> np.uint64(32)
    segment = ((dealt * m[pair].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    if trial:
        chosen = segment < bands.trial()[band][pair]
        token, pair, segment = token[chosen], pair[chosen], segment[chosen]
    place = offset[pair] + segment
    value = mixed(hashes[token] ^ _SALT)
    total = int(m.sum())
    subset = np.zeros(total, np.uint64)
    np.add.at(subset, place, value)
    count = np.bincount(place, minlength=total)
    of_segment = np.repeat(np.arange(len(of)), m)
    number = np.arange(total) - offset[of_segment]
    salt = mixed(((band + 1) << 40)[of_segment].astype(np.uint64) + number.astype(np.uint64))
    void = count <= bands.deletions[band][of_segment]
    voids = np.bincount(of_segment[void], minlength=len(of))
    need = np.maximum(0, bands.slack[band] + 1 - voids)
    whole = np.flatnonzero(count > 0)
    entries, owners = [mixed(subset[whole] + salt[whole])], [of_segment[whole]]
    if bands.deletions.any():
        without = np.flatnonzero((bands.deletions[band][pair] > 0) & (count[place] > 1))
        entries.append(mixed(subset[place[without]] - value[without] + salt[place[without]]))
        owners.append(pair[without])
    if not trial:
        empty = np.flatnonzero(void & (need == 0)[of_segment])
        entries.append(mixed(salt[empty]))
        owners.append(of_segment[empty])
    entry, owner = np.concatenate(entries), np.concatenate(owners)
    # Six bytes tell entries apart well enough to find candidates, and move in less space.
    low = band[owner] << 10 | np.minimum(need[owner], 1023)
    return (entry & ~np.uint64(0xFFFF) | low.astype(np.uint64)).view(np.int64), of[owner]


def _classified(documents: DataFrame, text: str, key: str, ways: list[Bands]) -> DataFrame:
    """``key``, ``row``, number of n-grams ``n`` and class ``c`` of every document. Kept.

    With them, for each way of ``ways``, the entries of a few segments of every band (``trial0`` on).
    """
    rows = documents.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), text)
    names = [f"trial{way}" for way in range(len(ways))]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                hashes, bounds = shingle_sets(part.column(text))
                trials = []
                for own in ways:
                    entry, of = index_rows(hashes, bounds, own, trial=True)
                    order = np.argsort(of, kind="stable")
                    ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=part.num_rows))))
                    trials.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(entry[order])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(bounds)), pa.array(classes(hashes, bounds)), *trials],
                    names=["key", "row", "n", "c", *names],
                )

    kind = documents.schema[key].dataType.simpleString()
    lists = "".join(f", {name} array<bigint>" for name in names)
    return kept(in_tasks(rows, classify, f"key {kind}, row bigint, n bigint, c bigint{lists}"))


def _choose_bands(rows: DataFrame, percent: int) -> Bands:
    """Bands with deletions where these cost less: index rows, and rows that others have as well.

    Both ways have been tried on a few segments of every band, over all documents; this is scaled up.
    """
    cost: dict[int, list[float]] = {}
    for way in (0, 1):
        bands = Bands.of(percent, dict.fromkeys(range(64), way))
        scale = bands.segments / bands.trial()
        trial = rows.select("c", F.explode(f"trial{way}").alias("entry"))
        band = F.shiftright("entry", 10).bitwiseAND(63)
        groups = trial.groupBy(F.shiftright("entry", 10).alias("entry")).agg(
            F.count(F.lit(1)).alias("g"), (F.min("c") != F.max("c")).cast("int").alias("shared"),
            F.first(band).alias("band"),
        )
        # A row for each band.
        for r in groups.groupBy("band").agg(F.sum(F.col("g") * (1 + SHARED_COST * F.col("shared"))).alias("rows")).collect():
            cost.setdefault(r.band, [0.0, np.inf])[way] = scale[r.band] * r.rows
    return Bands.of(percent, {b: int(c[1] < c[0]) for b, c in cost.items()})


def _entries(documents: DataFrame, text: str, bands: Bands) -> DataFrame:
    """Index entries of every class that a task meets, once a task."""
    shared = documents.sparkSession.sparkContext.broadcast(bands)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for part in slices(batch, text):
                hashes, bounds = shingle_sets(part.column(0))
                numbers = classes(hashes, bounds)
                new = np.zeros(len(numbers), bool)
                for i, number in enumerate(numbers.tolist()):
                    if number not in met:
                        met.add(number)
                        new[i] = True
                sizes = np.where(new, np.diff(bounds), 0)
                hashes = hashes[np.repeat(new, np.diff(bounds))]
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                entry, of = index_rows(hashes, bounds, shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(entry), pa.array(numbers[of])], names=["entry", "c"])

    return in_tasks(documents.select(text), index, "entry bigint, c bigint")


def _shared(entries: DataFrame, tasks: int) -> DataFrame:
    """Rows of entries that several classes have, each class once: ``entry`` and band, ``need``, ``c``.

    A task gets whole entries, as many as its part of the index, and sorts them once.
    """

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy().copy(), b.column(1).to_numpy().copy()) for b in batches if b.num_rows]
        if not parts:
            return
        packed, c = (np.concatenate(a) for a in zip(*parts))
        parts.clear()
        order = np.argsort(packed)  # rows of an entry differ in their last 10 bits at most
        packed, c = packed[order], c[order]
        entry = packed >> 10
        heads = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
        several = np.minimum.reduceat(c, heads) != np.maximum.reduceat(c, heads)
        rows = np.repeat(several, np.diff(np.concatenate((heads, [len(entry)]))))
        packed, c, entry = packed[rows], c[rows], entry[rows]
        order = np.lexsort((c, entry))
        packed, c, entry = packed[order], c[order], entry[order]
        new = np.ones(len(entry), bool)
        new[1:] = (entry[1:] != entry[:-1]) | (c[1:] != c[:-1])
        packed, c, entry = packed[new], c[new], entry[new]
        for at in range(0, len(entry), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(entry[part]), pa.array(packed[part] & 0xFFFF), pa.array(c[part])], names=["entry", "need", "c"]
            )

    dealt = entries.repartition(tasks, F.shiftright("entry", 10))
    return in_tasks(dealt, share, "entry bigint, need bigint, c bigint")


def _sets(documents: DataFrame, text: str, chosen: DataFrame) -> DataFrame:
    """``c``, the n-grams and their sketch, of each chosen class, from the text of one of its rows."""
    rows = documents.select(F.monotonically_increasing_id().alias("row"), text).join(chosen.select("row"), "row")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                hashes, bounds = shingle_sets(part.column(1))
                of = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                bucket = (mixed(hashes) >> np.uint64(57)).astype(np.int64)
                counts = np.bincount(of * SKETCH + bucket, minlength=part.num_rows * SKETCH)
                flat = np.minimum(counts, 255).astype(np.uint8).reshape(-1, SKETCH)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(classes(hashes, bounds)),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64))),
                        pa.array([row.tobytes() for row in flat], pa.binary()),
                    ],
                    names=["c", "n", "grams", "sketch"],
                )

    return kept(in_tasks(rows.select("row", text), build, "c bigint, n bigint, grams array<bigint>, sketch binary"))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs of classes ``a`` and ``b``, those that are as similar as asked, by their whole sets."""
    left = sets.select(F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    sized = pairs.join(left.drop("grams_a"), "a").join(right.drop("grams_b"), "b")
    sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b")
    both = sized.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    union = F.col("n_a") + F.col("n_b") - common
    return both.where(100 * common >= percent * union).select("a", "b")


def _with_firsts(members: DataFrame) -> DataFrame:
    """Pairs of each class with first classes ``a`` of its entries: with up to ``FIRSTS``, those it meets most often.

    In a large group of near copies a class meets very many firsts, nearly all of which are like those it
    meets most. What it has in common with others is not lost: entries that then still hold several
    components are gone through by their rarest n-grams, whatever pairs were left out here.
    """
    met = members.where("a < c").groupBy("c", "a").agg(F.count(F.lit(1)).alias("entries"))
    most = Window.partitionBy("c").orderBy(F.desc("entries"), "a")
    chosen = met.withColumn("place", F.row_number().over(most)).where(F.col("place") <= FIRSTS)
    return chosen.select("a", F.col("c").alias("b"))


def _rarest(sets: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Of each chosen class its rarest n-grams, as many as a partner has to share one of.

    Two sets as similar as asked share at least percent / 100 of either, so one of the rarest of
    either, by any one order of n-grams; rare means in few of the chosen classes.
    """
    grams = sets.join(chosen, "c").select("c", "n", F.explode("grams").alias("entry"))
    often = grams.groupBy("entry").agg(F.count(F.lit(1)).alias("often"))
    ranked = grams.join(often.where("often > 1"), "entry", "left")
    by_rarity = Window.partitionBy("c").orderBy(F.coalesce("often", F.lit(1)), "entry")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return (
        ranked.withColumn("place", F.row_number().over(by_rarity))
        .where((F.col("place") <= first) & (F.col("often") > 1))
        .select("entry", "c", "place")
    )


def _compared(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of an entry in different components whose sketches allow them to be similar.

    The entries are n-grams at some ``place`` in the members' order by rarity. For a pair that is
    similar its first common n-gram leaves enough n-grams after it in both; other pairs are passed
    over there, and pairs with an earlier common one have been looked at with that.

    An entry's members are dealt into blocks of about ``BLOCK``; any two blocks of an entry meet in
    one task, so a task holds two blocks however many members there are.
    """
    sizes = members.groupBy("entry").agg(
        F.count(F.lit(1)).alias("g"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed_entries = sizes.where("low < high").select("entry", F.ceil(F.col("g") / BLOCK).alias("blocks"))
    rows = members.join(mixed_entries, "entry").withColumn("block", F.pmod(F.xxhash64("c"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "entry",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "c",
        "component",
        "place",
    )
    rows = rows.join(sets.select("c", "n", "sketch"), "c").select(
        "entry", "i", "j", "block", "c", "component", "n", F.col("place").cast("long"), "sketch"
    )

    def compare_run(i, j, block, c, component, n, place, sketch):
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        near = component[left][:, None] != component[right][None, :]
        small = np.minimum(n[left][:, None], n[right][None, :])
        large = np.maximum(n[left][:, None], n[right][None, :])
        near &= 100 * small >= percent * large
        needed = -(-percent * (small + large) // (100 + percent))
        rest = n - place + 1
        near &= np.minimum(rest[left][:, None], rest[right][None, :]) >= needed
        if i == j:
            near &= c[left][:, None] < c[right][None, :]
        x, y = np.nonzero(near)
        x, y = left[x], right[y]
        out = []
        for at in range(0, len(x), 1 << 15):
            p, q = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
            apart = np.abs(sketch[p].astype(np.int16) - sketch[q]).sum(axis=1, dtype=np.int64)
            close = (100 + percent) * apart <= (100 - percent) * (n[p] + n[q])
            out.append((c[p[close]], c[q[close]]))
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            entry, i, j, block, c, component, n, place = (table.column(k).to_numpy() for k in range(8))
            sketch = np.frombuffer(b"".join(table.column(8).to_pylist()), np.uint8).reshape(-1, SKETCH)
            head = np.ones(len(entry), bool)
            head[1:] = (entry[1:] != entry[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            starts = np.flatnonzero(head).tolist()
            found = []
            for b, e in zip(starts, [*starts[1:], len(entry)]):
                if e - b > 1:
                    s = slice(b, e)
                    found += compare_run(i[b], j[b], block[s], c[s], component[s], n[s], place[s], sketch[s])
            a = np.concatenate([np.minimum(p, q) for p, q in found] or [np.zeros(0, np.int64)])
            z = np.concatenate([np.maximum(p, q) for p, q in found] or [np.zeros(0, np.int64)])
            both = np.unique(np.stack((a, z), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last run may go on in the next batch.
            entry, i, j = (batch.column(k).to_numpy() for k in range(3))
            same = (entry == entry[-1]) & (i == i[-1]) & (j == j[-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                held.append(batch.slice(0, cut))
                yield done(pa.Table.from_batches(held))
                held = []
            elif held:
                last = held[-1]
                if any(last.column(k)[last.num_rows - 1].as_py() != batch.column(k)[0].as_py() for k in range(3)):
                    yield done(pa.Table.from_batches(held))
                    held = []
            held.append(batch.slice(cut))
        if held:
            yield done(pa.Table.from_batches(held))

    count = partitions(members.sparkSession)
    dealt = rows.repartition(count, "entry", "i", "j").sortWithinPartitions("entry", "i", "j")
    return in_tasks(dealt, compare, "a bigint, b bigint").distinct()


def similar(documents: DataFrame, text: str, key: str, percent: int = PERCENT) -> DataFrame:
    """For every row ``key``, ``row``, ``n`` (distinct n-grams), class ``c``, ``group`` and ``component``.

    Rows of linked documents have one ``group``. ``row`` is from ``monotonically_increasing_id``.
    ``component`` is the smallest key reachable over links between documents with a Jaccard
    similarity of ``percent`` / 100 or more, its own included. A document without words, or with a
    null text, has no n-grams and is linked with nothing, other such documents included. Null keys
    take part, but are never the smallest unless all keys are null. Repeated rows are equal sets.

    The documents have to be a table that reads the same every time: files or a kept table.
    """
    ways = [Bands.of(percent, dict.fromkeys(range(64), way)) for way in (0, 1)]
    rows = _classified(documents, text, key, ways)
    bands = _choose_bands(rows, percent)
    grams = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = max(partitions(documents.sparkSession), -(-grams // TASK_GRAMS))
    shared = kept(_shared(_entries(documents, text, bands), tasks))
    # Entries of a band that a class shares with any other, against what it would share with a partner.
    enough = shared.groupBy("c", "need").agg(F.count(F.lit(1)).alias("shares"))
    enough = enough.where(F.col("shares") >= F.col("need").bitwiseAND(1023)).select("c", "need")
    members = shared.join(enough, ["c", "need"]).select("entry", "c")
    pivots = members.groupBy("entry").agg(F.min("c").alias("a"), F.max("c").alias("z")).where("a < z")
    members = kept(members.join(pivots.select("entry", "a"), "entry"))
    pairs = _with_firsts(members)
    firsts = rows.groupBy("c").agg(F.min("row").alias("row"))
    sets = _sets(documents, text, firsts.join(members.select("c").distinct(), "c"))
    links = kept(_links(pairs, sets, percent))
    found = components(links)
    placed = members.join(found, F.col("c") == F.col("node"), "left")
    placed = placed.select("entry", "c", F.coalesce("component", "c").alias("component"))
    open_entries = placed.groupBy("entry").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    chosen = placed.join(open_entries.where("x < y").select("entry"), "entry").select("c").distinct()
    rare = _rarest(sets, chosen, percent).join(found, F.col("c") == F.col("node"), "left")
    rare = kept(rare.select("entry", "c", "place", F.coalesce("component", "c").alias("component")))
    more = _links(_compared(rare, sets, percent), sets, percent)
    joined = links.unionByName(more)
    found = components(joined)
    grouped = rows.join(found, F.col("c") == F.col("node"), "left")
    grouped = grouped.select("key", "row", "n", "c", F.coalesce("component", "c").alias("group"))
    # Kept, so that the join reads two plain shuffles, of which a large group's can be split.
    least = kept(grouped.where("n > 0").groupBy("group").agg(F.min("key").alias("least")))
    return grouped.join(least, "group", "left").select(
        "key",
        "row",
        "n",
        "c",
        "group",
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component"),
    )


def one_of_each(documents: DataFrame, text: str, key: str, percent: int = PERCENT) -> DataFrame:
    """The documents without those that are linked, directly or not, with one of a smaller key.

    Of each group the row with the smallest key stays, of repeated keys the one read first, and all
    documents without words. Columns and texts stay as they are.
    """
    found = kept(similar(documents, text, key, percent))
    heads = found.where((F.col("n") > 0) & F.col("key").eqNullSafe(F.col("component")))
    first = heads.groupBy("group").agg(F.min("row").alias("row")).select("row")
    stay = first.unionByName(found.where("n = 0").select("row"))
    row = free_name(documents, "_row")
    numbered = documents.withColumn(row, F.monotonically_increasing_id())
    return numbered.join(stay.withColumnRenamed("row", row), row, "left_semi").select(*all_columns(documents))
