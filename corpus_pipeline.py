"""A corpus made ready for training: toxic documents go, then repeated passages, near copies and benchmark text.

Each stage takes the documents that the one before kept, as a stored table, and returns them with
the same columns; the last one returns them encoded.

All stages take null and empty texts, texts of any length, nulls in any column, repeated rows, and
columns beside those of documents, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dormouse.llm import bytebpe, decontamination, jaccard, linededup, queries, toxicity
from dormouse.llm.spread import all_columns, free_name, kept


def _measured(docs: DataFrame) -> DataFrame:
    """Documents with ``n_chars`` as their text now is."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    Rows are scored by themselves, so repeated ones stay or go together; a null or empty text has the
    score of a text without sentences, and stays. Labels are looked up by doc_id; a null matches none.
    """
    queries.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = queries.toxicity_model(docs, labels)
    found = free_name(docs, "_found")
    rows = toxicity.scored(docs, "text", model, found)
    return rows.where(F.col(f"{found}.score") < toxicity.THRESHOLD).select(*all_columns(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; those with no word left go.

    The first copy by doc_id stays, of equal ids the one read first; a null id comes before all. Documents
    that nothing is taken out of stay as they are, null and empty ones too. Of repeated rows with enough
    words all but the first go.
    """
    queries.ship(spark)
    runs = free_name(docs, "_runs")
    rows = linededup.deduplicated(docs, "text", "doc_id", runs)
    emptied = (F.size(runs) > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _measured(rows.where(~F.coalesce(emptied, F.lit(False))).select(*all_columns(docs)))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    That with the smallest doc_id stays, of equal ids the one read first; a null id only where all
    are null. Documents without words, null texts too, are in no group and all stay.
    """
    queries.ship(spark)
    return jaccard.one_of_each(docs, "text", "doc_id")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.

    Every document stays, a null text as a null; one that was all passage has an empty text or blanks.
    Repeated rows lose the same passages. Items without id or text have none.
    """
    queries.ship(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _measured(decontamination.decontaminated(docs, "text", benchmark, "item_id", "text"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as ids, with the text that the ids decode to.

    A null or empty text has no ids and decodes to an empty one. Repeated rows are encoded alike.
    """
    queries.ship(spark)
    ranks = public_tokenizers.path(queries.RANK_FILE)
    back = free_name(docs, "_back")
    rows = bytebpe.encoded(docs, "text", ranks, "ids", "id_bytes", back).drop("id_bytes", "text")
    return rows.withColumnRenamed(back, "text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("byte BPE", as_tokens),
]

# Fitted scores, suffix arrays and merges are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = kept(docs)
    return docs
