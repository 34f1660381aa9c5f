"""From raw documents to packed sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import decontamination, langid, ngram_join, packing, pii
from tradewind.llm.common import documents, ship, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected texts go: without a letter, or less like its language than any text it was learnt from.

    The models are learnt from the documents with a language; one without gets the language found.
    """
    ship(spark)
    found = langid.detect(docs, docs, COLUMNS).filter(~F.col("rejected"))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; 80 % alike in five-word shingles."""
    ship(spark)
    return ngram_join.one_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or all of a shorter one, go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    tag = F.xxhash64("doc_id", "text")
    found = decontamination.contamination(docs.select(tag.alias("doc_id"), "text"), items)
    hit = stored(found.filter("contaminated").select(F.col("doc_id").alias("__tag")).distinct(), "contaminated")
    return docs.withColumn("__own", tag).join(hit, F.col("__own") == F.col("__tag"), "left_anti").select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data gives way to its kind in brackets; ``n_chars`` follows the text."""
    clean = pii.redact(pii.find_pii(docs.select(*COLUMNS)))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 2048 ids."""
    ship(spark)
    packed = packing.pack(docs, keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_personal_data", redact_personal_data),
    ("pack", pack),
]

#: SQL can express neither the language models nor the boosted trees nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
