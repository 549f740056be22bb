"""One query per operator over the whole given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import (
    chat_format, cotraining, digest, importance, jaccard, line_rules, packing, pieces, prefix_trie, repeats, sharding, token_files,
    url_rules,
)
from .oracle import SQL

#: The rules of the URL query.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
    ("block", "net/fr/"),
]


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.classify_keys(docs, table(spark, sf_dir, "labels"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_probability")


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shard_rows(docs)


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_file(), keep=["doc_id"], special_as_text=False)


def similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents").select("doc_id", "text"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = work_dir(spark, "token-files")
    token_files.write_token_files(docs, folder, tokenizer_file(), special_as_text=False)
    return token_files.read_documents(spark, folder)


def piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_texts(docs, tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"])


def repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).drop("text").withColumnRenamed("kept_text", "text")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_rules.clean_lines(docs, keep=["doc_id"]).drop("clean_text")


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"  # a conversation made of control strings
    more = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], given.schema)
    model = tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return chat_format.read_back(chat_format.format_turns(given.unionByName(more), *model), *model)


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_cotraining_quality": quality_classifier,
    "op2_url_filter": url_filter,
    "op3_hypergeometric_shards": sharding_query,
    "op4_best_fit_packing": packing_query,
    "op5_bayes_jaccard": similarity_join,
    "op6_token_files": token_output,
    "op7_nbest_pieces": piece_encoding,
    "op8_repeated_windows": repeat_removal,
    "op9_line_rules": quality_rules,
    "op10_quartile_digest": fingerprints,
    "op11_importance_resampling": resampling,
    "op12_chat_format": chat_formatting,
    "op13_prefix_trie": conversation_trie,
}
