"""A mix of sources at target weights: sources packed into blocks, drawn for the slots of output shards, joined by index.

Each source's words stand end to end and are cut into blocks of one length, the last one shorter.
Every slot of an output shard draws a source, so that the counts of a shard are multinomial; slots
drawn beyond a source's share go to those that are short of theirs. The k-th slot of a source takes
the block that a pseudorandom permutation of the source's indices gives for k, another one for each
time the source is gone through. Which block a slot takes is arithmetic on its index, so documents
and slots meet in one join on source and block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dormouse.llm.spread import kept, partitions, prefix_sums, quoted

WORD = r"[^\x20\x09-\x0D]+"
# Words of a block, and blocks of an output shard.
BLOCK_WORDS = 512
SHARD_SLOTS = 1024
WEIGHTS = (5, 2, 1)
# What the mix takes of all words, and at most of one source's.
SHARE_PERCENT = 150
MOST_TIMES = 2
SEED = 11
# Rounds of the permutation of a source's blocks.
ROUNDS = 24
# Drawn numbers look their source up among those whose ranges reach into their stretch of this size.
STRETCH = 1024


@dataclass(frozen=True)
class Mix:
    """``documents``: row, key, size, source_no, at (its first word's place in its source).
    ``sources``: one row each, with sizes, target and quota. ``slots``: one row for each block taken:
    slot, shard, source_no, pass (how often the source was gone through before), block, words."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int


def word_count(text: Column) -> Column:
    """Runs of characters that are no white space; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _number(*parts: Column | str) -> Column:
    """A pseudorandom whole number of 60 bits that depends on nothing but the parts."""
    text = F.concat_ws(":", F.lit(str(SEED)), *(F.col(p).cast("string") if isinstance(p, str) else p for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """Adds ``source_no``, ``weight``, ``target`` to ``last``, ``name``, ``source_size``: one row for each source.

    Sources get ``percent`` of all words in proportion to their weights, but none more than ``most``
    times its own; what is above goes to the others by weight, until none is above. Those that are
    cut off come first in the order of size by weight, so sums over that order tell which they are.
    A source without words gets none.
    """
    placed = prefix_sums(sizes, ["last", "name"], {"source_no": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = placed.select("*", weight.cast("long").alias("weight"), (most * F.col("source_size")).alias("most"))
    rows = rows.withColumn("ratio", F.col("most") / F.col("weight"))
    order = ["ratio", "source_no"]
    rows = kept(prefix_sums(rows, order, {"most_before": F.col("most"), "weight_before": F.col("weight")}))
    sums = rows.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weight_sum = sums.words or 0, sums.weight or 0

    def whole(value: Column) -> Column:
        return value.cast("decimal(19,0)").cast("decimal(30,0)")

    left = whole(F.lit(words)) * percent - whole(F.col("most_before")) * 100
    cut_off = left * F.col("weight") >= whole(F.col("most")) * 100 * (F.lit(weight_sum) - F.col("weight_before"))
    rows = rows.withColumn("cut_off", cut_off)
    sums = rows.where("not cut_off").agg(F.sum("weight").alias("weight")).first()
    used = rows.where("cut_off").agg(F.sum("most").alias("most")).first()
    left_over = percent * words / 100 - (used.most or 0)
    by_weight = F.col("weight") * F.lit(float(left_over)) / F.lit(float(sums.weight or 1))
    target = F.when(F.col("cut_off"), F.col("most").cast("double")).otherwise(by_weight)
    return rows.select("last", "name", "source_no", "weight", "source_size", target.alias("target"))


def _found(numbers: DataFrame, number: str, ranges: DataFrame, start: str, length: str) -> DataFrame:
    """Joins each number to the range that holds it; ranges do not overlap."""
    first, last = F.col(start), F.col(start) + F.col(length) - 1
    reached = F.sequence(F.expr(f"{start} div {STRETCH}"), F.floor(last / STRETCH).cast("long"))
    spread = ranges.where(F.col(length) > 0).withColumn("stretch", F.explode(reached))
    drawn = numbers.withColumn("stretch", F.expr(f"{number} div {STRETCH}"))
    return drawn.join(spread, "stretch").where(F.col(number).between(first, last)).drop("stretch")


def _drawn(sources: DataFrame, slots: int, shard_slots: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A source for every slot; how often each shard draws each; and each source's draws against its quota.

    ``over`` slots are drawn beyond the quota and ``short`` ones are missing; both are the same in sum.
    """
    spark = sources.sparkSession
    rows = spark.range(0, slots, 1, partitions(spark)).withColumnRenamed("id", "slot")
    rows = rows.withColumn("shard", F.expr(f"slot div {shard_slots}"))
    rows = rows.withColumn("drawn", _number("slot") % max(1, slots))
    quotas = kept(prefix_sums(sources.select("source_no", "quota"), ["source_no"], {"start": F.col("quota")}))
    rows = kept(_found(rows, "drawn", quotas, "start", "quota").select("slot", "shard", "source_no"))
    # How often each shard draws each source, and how often all shards before it do.
    counts = rows.groupBy("source_no", "shard").agg(F.count(F.lit(1)).alias("n"))
    counts = kept(prefix_sums(counts, ["source_no", "shard"], {"before": F.col("n")}))
    each = counts.groupBy("source_no").agg(F.min("before").alias("first"), F.sum("n").alias("draws"))
    none = F.lit(0).cast("long")
    each = quotas.join(each, "source_no", "left").select(
        "source_no",
        "quota",
        F.coalesce("first", none).alias("first"),
        F.coalesce("draws", none).alias("draws"),
        F.greatest(F.coalesce("draws", none) - F.col("quota"), none).alias("over"),
        F.greatest(F.col("quota") - F.coalesce("draws", none), none).alias("short"),
    )
    each = kept(prefix_sums(each, ["source_no"], {"over_start": F.col("over"), "short_start": F.col("short")}))
    return rows, counts, each


def _numbered(rows: DataFrame, counts: DataFrame, each: DataFrame) -> DataFrame:
    """Numbers each source's slots through all shards; those beyond its quota go to sources short of theirs."""
    shard_begin = counts.join(each, "source_no").select(
        "source_no", "shard", "quota", (F.col("before") - F.col("first")).alias("begin"), "over_start"
    )
    in_shard = rows.groupBy("source_no", "shard").agg(F.array_sort(F.collect_list("slot")).alias("slots"))
    placed = in_shard.join(shard_begin, ["source_no", "shard"]).select(
        "source_no", "shard", "quota", "begin", "over_start", F.posexplode("slots").alias("i", "slot")
    )
    placed = placed.withColumn("k", F.col("begin") + F.col("i"))
    own = placed.where("k < quota").select("slot", "shard", "source_no", "k")
    beyond = placed.where("k >= quota").select(
        "slot", "shard", (F.col("over_start") + F.col("k") - F.col("quota")).alias("free")
    )
    given = _found(beyond, "free", each.select("source_no", "draws", "short", "short_start"), "short_start", "short")
    k = F.col("draws") + F.col("free") - F.col("short_start")
    return own.unionByName(given.select("slot", "shard", "source_no", k.alias("k")))


def permuted(index: str, count: str, keys: str, salt: str) -> str:
    """SQL for a pseudorandom permutation of 0 to ``count`` - 1, by rounds that each swap pairs or do not.

    In a round, ``x`` and ``keys[round] - x`` (modulo the count) are partners. Both see one bit, drawn from the
    round and the greater of them, so both or none change places. A permutation for any count.
    """
    partner = f"pmod({keys}[r] - x, {count})"
    bit = f"substr(md5(cast(concat_ws(':', '{SEED}', {salt}, r, greatest(x, {partner})) as binary)), 1, 1) >= '8'"
    return f"aggregate(sequence(0, {ROUNDS - 1}), {index}, (x, r) -> if({bit}, {partner}, x))"


def _blocks(numbered: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """The block that each slot takes, and how many of its words: all, but in the last slot of a source."""
    each = sources.select("source_no", "source_size", "quota", "rest")
    rows = numbered.join(each, "source_no")
    in_pass = f"cast(ceil(source_size / {block_words}) as bigint)"
    rows = rows.withColumn("pass", F.expr(f"k div {in_pass}")).withColumn("i", F.expr(f"k % {in_pass}"))
    rows = rows.withColumn("whole", F.expr(f"source_size div {block_words}"))
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        lambda r: _number(F.lit("key"), "source_no", "pass", r.cast("string")) % F.greatest("whole", F.lit(1)),
    )
    # A source and pass have the same keys in all their slots, so they are made once for each.
    whole = F.expr(f"source_size div {block_words}").alias("whole")
    last_pass = F.greatest(F.expr(f"(quota - 1) div ({in_pass})"), F.lit(0))
    passes = sources.where("quota > 0").select("source_no", whole, F.explode(F.sequence(F.lit(0), last_pass)).alias("pass"))
    rows = rows.join(kept(passes.select("source_no", "pass", keys.alias("keys"))), ["source_no", "pass"])
    moved = permuted("i", "whole", "keys", "source_no, pass")
    rows = rows.withColumn("block", F.expr(f"if(i < whole, {moved}, i)"))
    length = F.least(F.lit(block_words).cast("long"), F.col("source_size") - F.col("block") * block_words)
    last_words = (F.col("rest") - 1) % block_words + 1
    words = F.when((F.col("k") == F.col("quota") - 1) & (F.col("rest") > 0), last_words).otherwise(length)
    return rows.select("slot", "shard", "source_no", "pass", "block", words.cast("long").alias("words"))


def mixed(
    documents: DataFrame,
    text: str,
    key: str,
    source: str,
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = SHARE_PERCENT,
    most: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
) -> Mix:
    """Plans a mix of the documents' sources: which block of which source every slot of every shard takes.

    Weights belong to sources in code point order, a null source last, and repeat. A source's words
    taken are its target, rounded. Within a source documents stand in the order of ``key``, then
    size, then of where they were read, nulls first. A null or empty text has no words and is in no
    block; a long one is in many. Repeated rows are documents of their own. An empty table, or one
    without words, gives no slots. Other columns are not looked at, whatever their names.

    Documents have to be a table that reads the same every time: files or a kept table.
    """
    rows = kept(
        documents.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(quoted(key)).alias("key"),
            F.col(quoted(source)).isNull().alias("last"),
            F.coalesce(F.col(quoted(source)).cast("string"), F.lit("")).alias("name"),
            word_count(F.col(quoted(text))).alias("size"),
        )
    )
    sizes = rows.groupBy("last", "name").agg(F.sum("size").alias("source_size"))
    sources = targets(sizes, weights, percent, most)
    goal = F.floor(F.col("target") + 0.5).cast("long")
    rest = F.when(F.col("source_size") > 0, goal % F.col("source_size")).otherwise(F.lit(0).cast("long"))
    sources = sources.withColumn("rest", rest)
    passes = F.when(F.col("source_size") > 0, F.floor((goal - rest) / F.col("source_size"))).otherwise(0)
    quota = passes * F.ceil(F.col("source_size") / block_words) + F.ceil(F.col("rest") / block_words)
    sources = kept(sources.withColumn("quota", quota.cast("long")))
    slots = sources.agg(F.sum("quota").alias("n")).first().n or 0
    taken = kept(_blocks(_numbered(*_drawn(sources, slots, shard_slots)), sources, block_words))
    placed = kept(prefix_sums(rows, ["last", "name", "key", "size", "row"], {"before": F.col("size")}))
    begin = placed.groupBy("last", "name").agg(F.min("before").alias("begin"))
    # Kept, so that its size is known before the documents are dealt out by source.
    begin = kept(begin.join(sources.select("last", "name", "source_no"), ["last", "name"]))
    at = (F.col("before") - F.col("begin")).alias("at")
    found = placed.join(begin, ["last", "name"]).select("row", "key", "size", "source_no", at)
    return Mix(found, sources, taken, block_words)


def _pieces(mix: Mix) -> DataFrame:
    """Each document once for every block that it reaches into; one without words has a block of its own."""
    size = mix.block_words
    reached = F.sequence(F.expr(f"at div {size}"), F.expr(f"(at + size - 1) div {size}"))
    blocks = F.when(F.col("size") > 0, reached).otherwise(F.array(-1 - F.col("row")))
    return mix.documents.withColumn("block", F.explode(blocks))


def words_taken(mix: Mix) -> DataFrame:
    """``row``, ``key``, ``size``, ``source_no`` and ``taken`` of every document: its words in the mix, repeats counted."""
    begin = F.col("block") * mix.block_words
    common = F.least(F.col("at") + F.col("size"), begin + F.col("words")) - F.greatest("at", begin)
    both = _pieces(mix).join(mix.slots.select("source_no", "block", "words"), ["source_no", "block"], "left")
    # Blocks that no slot takes have no words to share; least would pass over their null.
    common = F.when(F.col("words").isNotNull() & (common > 0), common).otherwise(0)
    taken = F.sum(common).cast("long").alias("taken")
    return both.groupBy("row", "key", "size", "source_no").agg(taken)


def mixed_texts(mix: Mix, documents: DataFrame, text: str) -> DataFrame:
    """``shard``, ``slot``, ``source_no`` and ``words``: the mix itself, one row of words for every slot.

    The documents are those that the mix was planned for. A block is put together from its
    documents' slices, at most one for each of its words.
    """
    words = F.regexp_extract_all(F.col(quoted(text)), F.lit(WORD), 0)
    texts = documents.select(F.monotonically_increasing_id().alias("row"), words.alias("own"))
    begin = F.col("block") * mix.block_words
    first = F.greatest("at", begin)
    length = F.least(F.col("at") + F.col("size"), begin + mix.block_words) - first
    piece = F.slice("own", (first - F.col("at") + 1).cast("int"), length.cast("int"))
    pieces = _pieces(mix).where("size > 0").join(texts, "row")
    blocks = pieces.groupBy("source_no", "block").agg(
        F.array_sort(F.collect_list(F.struct("at", piece.alias("piece")))).alias("pieces")
    )
    joined = mix.slots.join(blocks, ["source_no", "block"])
    whole = F.flatten(F.transform("pieces", lambda p: p["piece"]))
    return joined.select("shard", "slot", "source_no", F.slice(whole, F.lit(1), F.col("words").cast("int")).alias("words"))
