"""One query per operator, over the whole given tables with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from snapmart.llm import (
    chat, exact_dedup, jaccard_join, language, mixing, packing, prefix_trie, quality, repair, sentencepiece_bpe, suffix_dedup,
    toxicity, url_filter,
)
from snapmart.llm.common import crc_fold, small_batches
from snapmart.session import materialize

# The stated rules of the URL filter.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# A conversation whose texts are control strings, in another layout than the table's rows.
CONTROL_RECORD = '{"prompt": "</s>[INST] ok [/INST]", "response": "</s>[INST] ok [/INST]"}'


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_toxicity(spark, sf):
    docs, labels = _table(spark, sf, "documents").select("doc_id", "text", "lang"), _table(spark, sf, "labels")
    fold = crc_fold("doc_id", 5)
    network = toxicity.train(docs, labels.where(fold != 0).select("doc_id", "toxic"))
    scored = toxicity.flag(toxicity.score(docs, network), network)
    return scored.select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged"
    )


def op2_url_filters(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_chat_format(spark, sf):
    # A row is a record of its role and text; the text itself stays in its column, however long it is.
    fields = F.struct("role", F.when(F.col("text").isNotNull(), "").alias("text"))
    rows = _table(spark, sf, "conversations").select(
        "conv_id", "turn", "text", F.to_json(fields, {"ignoreNullFields": "false"}).alias("record")
    )
    control = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit(CONTROL_RECORD).alias("record")
    )
    turns = chat.to_turns(rows.unionByName(control, allowMissingColumns=True), "record", long_text="text")
    read = chat.read_turns(chat.format_turns(turns))
    return chat.digest(read, "conv_id", ["turn", "position"])


def op4_sentencepiece(spark, sf):
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    coded = sentencepiece_bpe.encode(docs, model).drop("text")
    return sentencepiece_bpe.decode(coded, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_suffix_dedup(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    length = F.octet_length(F.coalesce("text", F.lit("")))
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        length.cast("long").alias("n_bytes"),
        (length - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_language_id(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    fold = crc_fold("doc_id", 3)
    model = language.train(docs.where(fold != 1))
    found = language.identify(docs.drop("lang"), model)
    return found.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def op7_jaccard_join(spark, sf):
    groups = jaccard_join.near_groups(_table(spark, sf, "documents").select("doc_id", "text"))
    return groups.select(F.col("key").alias("doc_id"), "class_id", "copy_id", "n_links")


def op8_quality_rules(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "source")
    measured = materialize(quality.measure(docs).drop("text"), "quality")
    return quality.judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_packing(spark, sf):
    """Ids are those of byte_bpe_50k.json; its vocabulary is read as ranks, which is several times as fast."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack_texts(docs, ranks, public_tokenizers.PATTERN, end_id=2)


def op10_exact_dedup(spark, sf):
    return exact_dedup.owners(_table(spark, sf, "documents").select("doc_id", "text")).select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept", "text_sha256"
    )


def op11_prefix_trie(spark, sf):
    placed = prefix_trie.placed_turns(_table(spark, sf, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_heads(placed))


def op12_mixing(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "certain")


def op13_conversation_repair(spark, sf):
    damaged = repair.damage(_table(spark, sf, "conversations"))
    return repair.repairs(damaged, "key", present="present").withColumnRenamed("key", "conv_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
