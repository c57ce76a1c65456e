"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hypnolith.llm import chat_format, class_lm, decontamination, license_scan, line_dedup, mixing, periodic_runs, quality_rules, signature_trees, substring_dedup, token_alignment, token_files, url_filters
from hypnolith.llm.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file (unless named, of the token output); the same path on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op1_url_filters")
def _(spark, folder):
    pages = read_table(spark, folder, "pages")
    found = url_filters.filter_urls(url_filters.captures_of(pages), url_filters.entries_of(pages))
    return found.withColumn("fetched", found.fetched.cast("string"))


ORACLES["op1_url_filters"] = url_filters.ORACLE


@_query("op2_quality_rules")
def _(spark, folder):
    return quality_rules.judged(read_table(spark, folder, "documents")).select(*quality_rules.RESULT)


ORACLES["op2_quality_rules"] = quality_rules.ORACLE


@_query("op3_substring_dedup")
def _(spark, folder):
    return substring_dedup.remove_repeats(read_table(spark, folder, "documents")).drop("kept_text")


@_query("op4_decontamination")
def _(spark, folder):
    return decontamination.find_leaks(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )


@_query("op5_license_scan")
def _(spark, folder):
    return license_scan.scan(read_table(spark, folder, "documents"))


ORACLES["op5_license_scan"] = license_scan.ORACLE


@_query("op6_mixing")
def _(spark, folder):
    return mixing.mix(read_table(spark, folder, "documents"))


ORACLES["op6_mixing"] = mixing.ORACLE


@_query("op7_line_dedup")
def _(spark, folder):
    return line_dedup.repeated_lines(read_table(spark, folder, "documents"))


@_query("op8_class_lm")
def _(spark, folder):
    return class_lm.score_documents(read_table(spark, folder, "documents"))


@_query("op9_token_files")
def _(spark, folder):
    blocks = token_files.write_token_files(read_table(spark, folder, "documents"), vocabulary())
    return token_files.read_token_files(blocks)


@_query("op10_jaccard_trees")
def _(spark, folder):
    return signature_trees.jaccard_components(read_table(spark, folder, "documents"))


@_query("op11_periodic_runs")
def _(spark, folder):
    docs = periodic_runs.with_planted_runs(read_table(spark, folder, "documents"))
    return periodic_runs.report(periodic_runs.collapse_runs(docs, texts=False))


@_query("op12_token_alignment")
def _(spark, folder):
    docs = read_table(spark, folder, "documents")
    return token_alignment.align(docs, vocabulary(), vocabulary("piece_bpe_32k.model"))


@_query("op13_chat_format")
def _(spark, folder):
    conversations = chat_format.with_control_conversation(read_table(spark, folder, "conversations"))
    return chat_format.report(chat_format.format_conversations(conversations))


ORACLES["op13_chat_format"] = chat_format.ORACLE
