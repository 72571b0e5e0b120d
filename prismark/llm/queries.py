"""The registered queries of the operators, one ``opN_<name>`` each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from prismark.llm import bpe, chat_format, exact_dedup as dedup, filter_interaction, html_extraction, language_id, pii, source_divergence
from prismark.llm.jaccard_join import jaccard_components
from prismark.llm.packing import pack
from prismark.llm.quality_classifier import classify
from prismark.llm.quality_rules import quality_rules
from prismark.llm.runtime import read_table
from prismark.llm.token_files import read_token_files, write_token_files

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_pack_documents")
def op1_pack_documents(spark, sf_dir):
    pieces = pack(read_table(spark, sf_dir, "documents"), byte_bpe(), window=1024, end_id=0)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@register("op2_token_files")
def op2_token_files(spark, sf_dir):
    manifest = write_token_files(read_table(spark, sf_dir, "documents"), byte_bpe(), end_id=0)
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op3_bpe_round_trip")
def op3_bpe_round_trip(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@register("op4_html_text")
def op4_html_text(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return html_extraction.extract(pages, html_extraction.train_labeller(pages))


@register("op5_jaccard_join")
def op5_jaccard_join(spark, sf_dir):
    return jaccard_components(
        read_table(spark, sf_dir, "documents"), n=3, p=90, q=100, subs=2, skip=1, spare=0.05, weak=2
    )


@register("op6_exact_dedup", dedup.ORACLE_SQL)
def op6_exact_dedup(spark, sf_dir):
    return dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


@register("op7_quality_rules")
def op7_quality_rules(spark, sf_dir):
    return quality_rules(read_table(spark, sf_dir, "documents"))


@register("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), threshold=0.3)


@register("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


@register("op10_pii")
def op10_pii(spark, sf_dir):
    return pii.report(read_table(spark, sf_dir, "documents"))


@register("op11_source_divergence", source_divergence.ORACLE_SQL)
def op11_source_divergence(spark, sf_dir):
    return source_divergence.source_divergence(read_table(spark, sf_dir, "documents"))


@register("op12_chat_format", chat_format.ORACLE_SQL)
def op12_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.summary(chat_format.format_chats(rows.unionByName(control), byte_bpe()), byte_bpe())


@register("op13_filter_interaction", filter_interaction.ORACLE_SQL)
def op13_filter_interaction(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return filter_interaction.interaction_audit(filter_interaction.failure_counts(docs, labels))
