"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from poolbook.llm import bpe, chat, conversations, decontaminate, html_text, licenses, line_rules, neardup, packing, periodic, pii, quality, url_filter
from poolbook.llm.common import table


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(spark, table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_chats(rows))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digests(found)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_rules.judge(docs, line_rules.train(docs, table(spark, sf_dir, "labels")))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.detect(table(spark, sf_dir, "documents")))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.documents_as_files(table(spark, sf_dir, "documents")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic.digests(periodic.find_runs(docs))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.decode(bpe.encode(docs).drop("text")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    summary = conversations.digests(conversations.repair(conversations.damaged(rows)))
    return conversations.with_empty(rows, summary)


QUERIES = {"op11_periodic_runs": op11_periodic_runs, "op12_bpe": op12_bpe, "op13_conversation_repair": op13_conversation_repair, "op3_licenses": op3_licenses, "op5_html_text": op5_html_text, "op1_quality": op1_quality, "op7_pii": op7_pii, "op9_neardup": op9_neardup, "op6_line_rules": op6_line_rules, "op10_packing": op10_packing, "op4_decontamination": op4_decontamination, "op2_url_filter": op2_url_filter, "op8_chat": op8_chat}
ORACLE = {"op3_licenses": licenses.oracle(), "op4_decontamination": decontaminate.oracle(), "op2_url_filter": url_filter.oracle(), "op8_chat": chat.oracle()}
