"""The named queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import alignment, conversation_trie, decontamination, language_id, line_quality, packing, pii, quality_rules, repeats, secrets, simhash, toxicity, url_filter
from clickloom.sources.tables import read_table


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "pattern", "quality")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"), path_col="source")
    return found.select("doc_id", "n_candidates", "n_secrets", "spans")


URL_RULES = (
    url_filter.Rule(True, "com", "/"),
    url_filter.Rule(False, "example.com", "/en/"),
    url_filter.Rule(True, "www.example.com", "/en/"),
    url_filter.Rule(False, "net", "/es/"),
    url_filter.Rule(False, "net", "/fr/"),
)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")  # `labels` is about documents, no page of the tables has a reviewed outcome
    return url_filter.judge(pages, url_filter.content_outcomes(pages), URL_RULES)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_quality.predict(docs, line_quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = conversation_trie.rebuilt(conversation_trie.turns_of(read_table(spark, sf_dir, "conversations")))
    trie = conversation_trie.build(turns, members)
    nodes = trie.nodes.join(conversation_trie.ends_digest(trie.ends), conversation_trie.KEY, "left")
    digest = F.coalesce("ends_sha256", F.lit(conversation_trie.EMPTY_SHA256)).alias("ends_sha256")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.alignment(read_table(spark, sf_dir, "documents"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


QUERIES = {
    "op12_alignment": op12_alignment,
    "op13_language_id": op13_language_id,
    "op11_conversation_trie": op11_conversation_trie,
    "op2_repeats": op2_repeats,
    "op8_line_quality": op8_line_quality,
    "op4_toxicity": op4_toxicity,
    "op3_pii": op3_pii,
    "op7_url_filter": op7_url_filter,
    "op1_secrets": op1_secrets,
    "op5_decontamination": op5_decontamination,
    "op10_packing": op10_packing,
    "op6_simhash": op6_simhash,
    "op9_quality_rules": op9_quality_rules,
}

ORACLE_SQL: dict[str, str] = {}
