"""The corpus pipeline: each stage's kept documents are written and reread as the next stage's input.

Stages take (spark, docs, sf_dir) and return the columns of ``docs``; the last returns packed pieces. Repeated rows are
documents of their own until exact dedup; null texts have no language and go. An empty table gives an empty result.
Further columns come back as they were, whatever their names; names that start with ``_llm_`` are the stages' own.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.llm import exact_dedup, jaccard_join, language, packing, suffix_dedup
from snapmart.llm.common import crc_fold, small_batches
from snapmart.session import materialize

#: A text goes if, on average, fewer of a word's n-grams occur in the texts that the languages were learned from.
LEAST_FAMILIAR = 0.5
#: Repeated passages are cut that have these words or more, and these bytes or more: 51 words of 4 letters and a space.
PASSAGE_WORDS, PASSAGE_BYTES = 51, 255
END_ID = 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognisable language; the model learns from the labelled ones outside one of three folds."""
    small_batches(spark)
    model = language.train(docs.where(crc_fold("doc_id", 3) != 1))
    found = language.identify(docs, model, label="_llm_lang", score="_llm_share", familiar="_llm_familiar")
    kept = found.where((F.col("_llm_lang") != language.UNKNOWN) & (F.col("_llm_familiar") >= LEAST_FAMILIAR))
    return kept.select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    small_batches(spark)
    return exact_dedup.keep_first(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more, the document with the smallest id."""
    small_batches(spark)
    return jaccard_join.keep_one(docs).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over 50 words that occur anywhere else.

    A passage is a run of bytes in which every byte lies in a string of ``PASSAGE_BYTES`` that occurs twice.
    """
    small_batches(spark)
    cut = suffix_dedup.remove_repeats(
        docs, length=PASSAGE_BYTES, whole_characters=True, least_words=PASSAGE_WORDS, spans_as="_llm_spans", kept_as="_llm_kept"
    )
    cut = cut.withColumn("text", F.when(F.col("text").isNotNull(), F.col("_llm_kept").cast("string")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack_texts(docs, ranks, public_tokenizers.PATTERN, END_ID)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

# A trained model, sketches and byte spans are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
