"""Phrases whose words stand together more often than apart, counted in quotient filters.

Documents are read in shards of some megabytes. A shard's texts become word numbers of its own
vocabulary; all shards' vocabularies are counted by a shuffle, and frequent words get numbers that
hold everywhere, which each shard looks up for its own words. Phrases of such words are packed into
one key each and counted in a filter for each shard. Filters are cut by the first bits of their
permuted keys, which spread evenly whatever the words are, and the shards' filters for the same
bits are merged, in rounds if there are very many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dormouse.llm import countingfilter
from dormouse.llm.bytetext import Texts, slices
from dormouse.llm.spread import in_tasks, kept, prefix_sums, quoted

MAX_WORDS = 4
MIN_COUNT = 30
# A candidate goes if a longer one has this share of its occurrences.
COVERED_PERCENT = 80
LEADING = 2000
SALTS = 16
SCALE = 2_000_000
NO_LANG = "und"
SHARD_BYTES = 8 << 20
# Keys of a filter that is merged from all shards, on average.
FILTER_KEYS = 1 << 19
# A filter is cut into so many at a time, by this many bits of its keys.
CUT_BITS = 10
# Words of a shard whose phrases are packed at a time, and keys that are sorted at a time, on average.
PACKED_WORDS, SORTED_KEYS = 1 << 17, 1 << 18
# Two numbers of words have to fit a lane.
_MAX_ID_BITS = 31

_BREAK, _NONE = -1, -2
_TABLE = bytearray(range(256))
for _c in range(0x41, 0x5B):
    _TABLE[_c] = _c + 0x20
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = 0x0A
_TABLE[0x09] = 0x20


class _Vocabulary(dict):
    """Numbers words as they come up; an empty one is none, and a line feed ends a piece."""

    def __init__(self) -> None:
        super().__init__({b"": _NONE, b"\n": _BREAK})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 2
        return number

    def words(self) -> list[bytes]:
        return list(self)[2:]


def _numbers(data: bytes, vocabulary: _Vocabulary, limit: int = 1 << 20) -> Iterator[np.ndarray]:
    """Word numbers of a text, with breaks between pieces, some megabytes at a time."""
    data, at = data.translate(bytes(_TABLE)), 0
    while at < len(data):
        stop = data.find(b" ", at + limit)
        stop = len(data) if stop < 0 else stop
        words = data[at:stop].replace(b"\n", b" \n ").split(b" ")
        numbers = np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words))
        yield numbers[numbers != _NONE]
        at = stop + 1


def _planes(numbers: np.ndarray) -> bytes:
    """Word numbers, all first bytes first: the last bytes are nearly all 0, and are stored as nearly nothing."""
    return np.ascontiguousarray((numbers - _NONE).astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: pa.Buffer) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel() + np.int32(_NONE)


class _Shard:
    """Vocabularies and texts of a run of documents, by language."""

    def __init__(self) -> None:
        self.of: dict[str, tuple[_Vocabulary, list[np.ndarray]]] = {}
        self.bytes = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        vocabulary, found = self.of.setdefault(lang, (_Vocabulary(), []))
        found.extend(_numbers(b"\n".join(texts) + b"\n", vocabulary))
        self.bytes += sum(map(len, texts))

    def rows(self, shard: int) -> pa.RecordBatch:
        langs = list(self.of)
        tokens = [np.concatenate(found) for _, found in self.of.values()]
        words = [vocabulary.words() for vocabulary, _ in self.of.values()]
        counts = [np.bincount(t[t >= 0], minlength=len(w)).astype(np.int64) for t, w in zip(tokens, words)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(langs), pa.int64()),
                pa.array(langs, pa.string()),
                pa.array(words, pa.list_(pa.string())),
                pa.array(counts, pa.list_(pa.int64())),
                pa.array([_planes(t) for t in tokens], pa.binary()),
            ],
            names=["shard", "lang", "words", "counts", "tokens"],
        )


def _shards(rows: DataFrame, shard_bytes: int) -> DataFrame:
    """``shard``, ``lang``, ``words``, ``counts`` and ``tokens``, the texts as places in ``words``. Kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts.of(part.column("text"))
                data, ends = texts.data.tobytes(), texts.offsets.tolist()
                by_lang: dict[str, list[bytes]] = {}
                for i, lang in enumerate(part.column("lang").to_pylist()):
                    by_lang.setdefault(lang, []).append(data[ends[i] : ends[i + 1]])
                for lang, own in by_lang.items():
                    shard.add(lang, own)
                if shard.bytes >= shard_bytes:
                    yield shard.rows(number)
                    number, shard = number + 1, _Shard()
        if shard.of:
            yield shard.rows(number)

    return kept(in_tasks(rows, work, "shard long, lang string, words array<string>, counts array<long>, tokens binary"))


def _packed_phrases(ids: np.ndarray, id_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Two lanes for each phrase of 2 to ``MAX_WORDS`` neighbours that all have a number, some at a time; 0 is none."""
    bits = np.uint64(id_bits)
    for start in range(0, len(ids), PACKED_WORDS):
        # Phrases that begin here, and the words after these that they reach.
        own = ids[start : start + PACKED_WORDS + MAX_WORDS - 1].astype(np.uint64)
        for size in range(2, MAX_WORDS + 1):
            count = max(0, min(PACKED_WORDS, len(own) - size + 1))
            at = np.flatnonzero(np.logical_and.reduce([own[i : i + count] > 0 for i in range(size)]))
            lanes = [np.zeros(len(at), np.uint64)] * (MAX_WORDS - size) + [own[at + i] for i in range(size)]
            yield (lanes[0] << bits) | lanes[1], (lanes[2] << bits) | lanes[3]


def _counts_in_ranges(ids: np.ndarray, id_bits: int, prefix_bits: int) -> Iterator[countingfilter.Counts]:
    """All phrases' permuted keys counted, in ranges of their first bits, ``prefix_bits`` at most.

    Before they are counted only the keys are held, and what it takes to sort them for one range.
    """
    phrases = (MAX_WORDS - 1) * len(ids)
    bits = min(prefix_bits, (phrases // SORTED_KEYS).bit_length())
    ranges: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(1 << bits)]
    for high, low in _packed_phrases(ids, id_bits):
        high, low = countingfilter.permuted(high, low, 2 * id_bits)
        first = (high >> np.uint64(2 * id_bits - bits)).astype(np.uint16)
        order = np.argsort(first, kind="stable")
        ends = np.cumsum(np.bincount(first, minlength=len(ranges)))[:-1]
        for own, *keys in zip(ranges, np.split(high[order], ends), np.split(low[order], ends)):
            # Copies, as a part would hold the whole.
            own.append(tuple(k.copy() for k in keys))
    for i, own in enumerate(ranges):
        ranges[i] = []
        high, low = (np.concatenate(k) for k in zip(*own)) if own else (np.zeros(0, np.uint64),) * 2
        del own
        if len(high):
            yield countingfilter.counted(high, low, None, 2 * id_bits)


def _filter_rows(shard: int, counts: countingfilter.Counts, prefix_bits: int) -> pa.RecordBatch:
    parts = countingfilter.by_prefix(counts, prefix_bits)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([prefix for prefix, _ in parts], pa.int64()),
            pa.array([shard] * len(parts), pa.int64()),
            pa.array([countingfilter.packed(own, prefix, prefix_bits) for prefix, own in parts], pa.binary()),
        ],
        names=["prefix", "shard", "filter"],
    )


_FILTERS = "prefix long, shard long, filter binary"


def _counted(numbered: DataFrame, id_bits: int, prefix_bits: int) -> DataFrame:
    """Each shard's phrases as filters, cut by the first bits of their keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = _from_planes(batch.column("tokens")[i].as_buffer())
                known = batch.column("known")[i].values
                size = int(tokens.max(initial=-1)) + 2
                ids = np.zeros(size, np.int32)  # a break looks up the last, which stays 0
                ids[known.field("place").to_numpy()] = known.field("id").to_numpy()
                for counts in _counts_in_ranges(ids[tokens], id_bits, prefix_bits):
                    yield _filter_rows(batch.column("shard")[i].as_py(), counts, prefix_bits)

    return in_tasks(numbered, work, _FILTERS)


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[countingfilter.Counts]]]:
    """Runs of rows with equal values of the columns, and their filters."""
    last, found = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(name).to_pylist() for name in names)))
        for key, data in zip(keys, batch.column("filter")):
            if key != last and found:
                yield last, found
                found = []
            last = key
            found.append(countingfilter.unpacked(data.as_py()))
    if found:
        yield last, found


def _merged_in_groups(filters: DataFrame, prefix_bits: int) -> DataFrame:
    """Filters of up to 2^``CUT_BITS`` shards merged into one, cut into filters of longer prefixes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, group), found in _groups(batches, ["prefix", "shard"]):
            yield _filter_rows(group, countingfilter.merged(found), prefix_bits)

    grouped = filters.withColumn("shard", F.shiftright("shard", CUT_BITS)).repartition("prefix", "shard")
    return in_tasks(grouped.sortWithinPartitions("prefix", "shard"), work, _FILTERS)


def _frequent(filters: DataFrame, id_bits: int, min_count: int) -> DataFrame:
    """``gram``, word numbers, and ``f`` of the phrases that occur often enough in all shards together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _groups(batches, ["prefix"]):
            counts = countingfilter.merged(found)
            often = np.flatnonzero(counts.counts >= min_count)
            high, low = countingfilter.restored(counts.high[often], counts.low[often], counts.bits)
            mask, bits = np.uint64((1 << id_bits) - 1), np.uint64(id_bits)
            ids = np.stack([high >> bits, high & mask, low >> bits, low & mask], axis=1).astype(np.int64)
            ends = np.concatenate(([0], np.cumsum((ids > 0).sum(axis=1)))).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[ids > 0]))
            yield pa.RecordBatch.from_arrays([grams, pa.array(counts.counts[often])], names=["gram", "f"])

    dealt = filters.select("prefix", "filter").repartition("prefix").sortWithinPartitions("prefix")
    return in_tasks(dealt, work, "gram array<long>, f long")


def phrase_counts(
    documents: DataFrame, text: str, lang: str, min_count: int = MIN_COUNT, shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words, frequent phrases, and how many words each language has, exactly counted. Kept.

    Words: ``lang``, ``word``, ``id``, ``f``; phrases: ``gram`` (ids of 2 to ``MAX_WORDS`` words) and
    ``f``; languages: ``lang`` and ``n``. A phrase is frequent only if its words are, so others are
    not counted. A null text is empty, and a null language ``NO_LANG``. Repeated rows count each
    time. A long text is cut between words where it needs to be. An empty table gives empty ones.
    Other columns are not looked at.
    """
    rows = documents.select(
        F.col(quoted(text)).alias("text"), F.coalesce(F.col(quoted(lang)).cast("string"), F.lit(NO_LANG)).alias("lang")
    )
    shards = _shards(rows, shard_bytes)
    totals = shards.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).alias("n"))
    totals = kept(totals.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"))
    words = shards.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = words.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    words = prefix_sums(words.where(F.col("f") >= min_count), ["lang", "word"], {"id": F.lit(1).cast("long")})
    words = kept(words.withColumn("id", F.col("id") + 1))
    found = words.agg(F.max("id").alias("id"), F.sum("f").alias("f")).first()
    id_bits = max(1, (found["id"] or 0).bit_length())
    if id_bits > _MAX_ID_BITS:
        raise ValueError(f"{found['id']} frequent words have numbers of more than {_MAX_ID_BITS} bits")
    local = shards.select("shard", "lang", F.posexplode("words").alias("place", "word"))
    known = local.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("shard", "lang")
    known = known.agg(F.collect_list(F.struct("place", "id")).alias("known"))
    numbered = shards.select("shard", "lang", "tokens").join(known, ["shard", "lang"])
    # There are no more keys than phrases; the first bits of permuted keys deal them out evenly.
    keys = (MAX_WORDS - 1) * (found["f"] or 0)
    bits = min(2 * id_bits, (keys // FILTER_KEYS).bit_length())
    first = min(bits, CUT_BITS)
    filters = _counted(numbered.select("shard", "tokens", "known"), id_bits, first)
    while first < bits:
        first = min(bits, first + CUT_BITS)
        filters = _merged_in_groups(filters, first)
    return words, kept(_frequent(filters, id_bits, min_count)), totals


def _cuts(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """Each phrase's lowest-scoring cut: ``k`` words before it, ``l`` and ``r``, and its score."""
    cut = phrases.select("gram", "f", F.explode(F.expr("sequence(1, size(gram) - 1)")).alias("k"))
    cut = cut.withColumn("left", F.expr("slice(gram, 1, k)")).withColumn("right", F.expr("slice(gram, k + 1, 8)"))
    both = cut.join(parts.select(F.col("gram").alias("left"), F.col("f").alias("l")), "left")
    both = both.join(parts.select(F.col("gram").alias("right"), F.col("f").alias("r")), "right")
    # Products of counts may pass 64 bits.
    score = f"(cast(f as decimal(19,0)) * {SCALE}) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    both = both.select("gram", "f", F.struct(F.expr(score).alias("score"), "k", "l", "r").alias("cut"))
    least = both.groupBy("gram").agg(F.first("f").alias("a"), F.min("cut").alias("cut"))
    return least.select("gram", "a", "cut.*")


def _uncovered(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one holds with nearly as many occurrences."""
    longer = phrases.where("size(gram) > 2").select(
        "f",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(gram) - 1),"
                " n -> transform(sequence(1, size(gram) - n + 1), i -> slice(gram, i, n))))"
            )
        ).alias("gram"),
    )
    most = longer.groupBy("gram").agg(F.max("f").alias("most"))
    share = F.lit(100).cast("decimal(3,0)") * F.col("most").cast("decimal(19,0)")
    least = F.lit(COVERED_PERCENT).cast("decimal(3,0)") * F.col("f").cast("decimal(19,0)")
    both = phrases.join(most, "gram", "left")
    return both.where(F.col("most").isNull() | (share < least)).drop("most")


def collocations(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``k``, ``l``, ``r`` and ``score`` of all candidates that no longer one covers.

    The tables are those of ``phrase_counts``. A part of a frequent phrase is as frequent, so it is
    among them. Of cuts with equal scores the first counts.
    """
    parts = words.select(F.array("id").alias("gram"), "f").unionByName(phrases)
    scored = kept(_cuts(_uncovered(phrases), parts))
    spelled = scored.select("gram", F.posexplode("gram").alias("i", "id")).join(words.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("gram").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("i", "word"))).alias("words")
    )
    phrase = F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase")
    return scored.join(spelled.select("gram", "lang", phrase), "gram").drop("gram")


def leading(found: DataFrame, totals: DataFrame, count: int = LEADING) -> DataFrame:
    """Each language's first candidates by score, occurrences and text, with their rank and the language's words.

    The first are taken in ``SALTS`` parts of a language before, so that one task ranks no more than those.
    """
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    dealt = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(*best)
        dealt = dealt.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= count)
    return dealt.drop("salt").join(totals, "lang")
