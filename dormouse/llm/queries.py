"""The registered query of each operator, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dormouse.llm import (
    bytebpe,
    collocations,
    decontamination,
    jaccard,
    licenses,
    linededup,
    lm,
    mixing,
    quality,
    secrets,
    sharding,
    toxicity,
    whitening,
)
from dormouse.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def ship(spark: SparkSession) -> None:
    """Lets tasks import this library where it lies beside the caller; on a cluster it comes with the job."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def held_out(key: str, parts: int) -> Column:
    """Rows that nothing is learnt from; a null key counts as an empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == 2


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = documents.where(~held_out("doc_id", 7))
    counts = lm.word_counts(learnt, "text")
    vocabulary = lm.Vocabulary.of(counts)
    model = lm.fit(learnt, "text", "doc_id", vocabulary)
    rows = lm.scored(documents, "text", "doc_id", counts, vocabulary, model)
    return rows.select(
        F.col("key").alias("doc_id"),
        held_out("key", 7).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    rows = quality.document_measures(documents, "text", ["doc_id", "source"])
    rules = quality.rules()
    rows = rows.select("*", *(broken.alias(f"{name}_failed") for name, broken in rules.items()))
    judged = quality.host_verdicts(rows, "source", [f"{name}_failed" for name in rules])
    return judged.select(
        "doc_id",
        *quality.MEASURES,
        "base_failed",
        (~F.col("base_failed") & ~F.col("verdict.rejected")).alias("kept"),
        F.col("verdict.documents").alias("host_documents"),
        F.array_join("verdict.failed", ",").alias("host_failed"),
        F.col("verdict.rejected").alias("host_rejected"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        sharding.byte_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    cut = sharding.balanced_shards(rows, "size", ["doc_id", "text_crc32", "size"], SHARDS)
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = _table(spark, sf_dir, "benchmark")
    rows = decontamination.marked(documents, "text", benchmark, "item_id", "text", "found")
    hits = decontamination.hit_count("found")
    return rows.select(
        "doc_id",
        "found.n_words",
        hits.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return bytebpe.digests(documents, "doc_id", "text", public_tokenizers.path(RANK_FILE))


def _spans(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"]))
    return F.array_join(text, ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = secrets.scanned(documents, "text", "found")
    base = F.filter("found", lambda s: s["kind"] != "guess")
    return rows.select(
        "doc_id",
        *(
            F.expr(f"size(filter(found, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}")
            for kind in secrets.KINDS
        ),
        F.sha2(_spans(base), 256).alias("base_sha256"),
        _spans(F.col("found")).alias("spans"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = licenses.scanned(documents, "text", "found")
    names = F.array_sort(F.array_distinct(F.transform("found", lambda s: s["license"])))
    spans = F.transform(
        "found", lambda s: F.concat_ws(":", s["license"], s["begin"], s["end"], s["matched"], s["words"])
    )
    return rows.select(
        "doc_id",
        F.size("found").cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = linededup.deduplicated(documents, "text", "doc_id", "runs")
    size = F.aggregate("runs", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    spans = F.transform("runs", lambda s: F.concat_ws(":", s["begin"], s["end"]))
    return rows.select(
        "doc_id",
        size.alias("n_removed_lines"),
        F.array_join(spans, ",").alias("removed_runs"),
        "text",
    )


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    learnt = labels.where(~held_out("doc_id", 4))
    return toxicity.train(documents, "doc_id", "text", learnt, "doc_id", "toxic")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(documents, _table(spark, sf_dir, "labels"))
    rows = toxicity.scored(documents, "text", model, "found")
    return rows.select(
        "doc_id",
        held_out("doc_id", 4).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("found.spans").cast("long").alias("n_toxic_sentences"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    rows = jaccard.similar(documents, "text", "doc_id")
    return rows.select(
        F.col("key").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
    )


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, sf_dir, "documents"), "text", "doc_id", "source")
    sources = mix.sources.select("source_no", "source_size", "target")
    rows = mixing.words_taken(mix).join(sources, "source_no")
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, phrases, totals = collocations.phrase_counts(_table(spark, sf_dir, "documents"), "text", "lang")
    rows = collocations.leading(collocations.collocations(words, phrases), totals)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, "embedding")
    rows = whitening.whitened(vectors, "embedding", model, "found")
    each = rows.select("vec_id", "found.deviation", F.posexplode("found.whitened").alias("i", "whitened"))
    shares = F.array(*map(F.lit, model.explained)) if model.explained else F.array().cast("array<double>")
    return each.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("i")).alias("explained"),
        F.lit(whitening.identity_error(vectors, "embedding", model)).alias("identity_error"),
    )


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_quality_rules": op2_quality_rules,
    "op3_secrets": op3_secrets,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_licenses": op6_licenses,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_mixing": op11_mixing,
    "op12_collocations": op12_collocations,
    "op13_whitening": op13_whitening,
}
