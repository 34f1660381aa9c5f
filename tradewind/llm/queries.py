"""One query per operator, each over the whole given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    conversation_repair,
    decontamination,
    fingerprint,
    langid,
    licenses,
    ngram_join,
    packing,
    pii,
    simhash,
    spelling,
    substring_dedup,
    token_store,
    toxicity,
)
from tradewind.llm.common import documents, ship


def remainder(column: str, parts: int) -> Column:
    """crc32 of the number as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose sets of four-word shingles are 85 % alike."""
    found = ngram_join.near_duplicates(documents(spark, sf_dir), size=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint.fingerprints(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    packed = packing.pack(documents(spark, sf_dir), keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    found = pii.find_pii(documents(spark, sf_dir))
    counts = [
        F.size(F.filter("base_spans", lambda s: s["kind"] == i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base_spans")), 256).alias("base_sha256"), pii.listed(F.col("pii_spans")).alias("spans"),
        F.size("pii_spans").cast("long").alias("n_spans"), (F.size("pii_spans") > 0).cast("int").alias("found"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of all documents."""
    return licenses.scan_licenses(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.toxicity(documents(spark, sf_dir), labels.filter(remainder("doc_id", 5) != 0))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to indexed shard files and read back."""
    kept = token_store.token_store(spark, documents(spark, sf_dir))
    return kept.select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from the named ones outside the held-out fold."""
    docs = documents(spark, sf_dir)
    found = langid.detect(docs, docs.filter(remainder("doc_id", 4) != 2))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(documents(spark, sf_dir), items)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of fifty words that stand in an earlier one."""
    kept = substring_dedup.deduplicate(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints of four-word shingles differ in at most four bits."""
    found = simhash.simhash_duplicates(documents(spark, sf_dir), size=4, bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fault in every fourth row, chosen by crc32 of ``conv_id:turn``; rows dropped are not ``present``."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    marked = rows.withColumn("fault", F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20)
    text, fault = F.coalesce("text", F.lit(" ")), F.col("fault")
    copies = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return marked.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (fault != 0).alias("present"), copies,
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations, some of their rows damaged."""
    ship(spark)
    return conversation_repair.repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def misspelt(doc_id: Column, word: Column) -> Column:
    """The word without one code point where 199 divides the crc32 of id and word."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    place = (h % F.char_length(word)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.left(word, place), F.substr(word, place + 2))).otherwise(word)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, some of them misspelt."""
    return spelling.variants(spelling.word_counts(documents(spark, sf_dir), shortest=6, fewest=5, change=misspelt))


QUERIES = (
    op1_ngram_join, op2_fingerprint, op3_packing, op4_pii, op5_licenses, op6_toxicity, op7_token_store, op8_language,
    op9_decontamination, op10_substring_dedup, op11_simhash, op12_conversation_repair, op13_spelling,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
