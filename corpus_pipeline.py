"""The corpus pipeline: five stages over ``documents``, each one of the operators.

STAGES holds (name, function); a function takes (spark, docs, sf_dir), works on
all rows of ``docs`` and returns a DataFrame.  The first four return the columns
of ``documents``:

1. quality rules: rows that the line-labelling rules reject go;
2. near-dedup: one document of each group stays;
3. decontamination: documents with a benchmark window go;
4. PII: spans are replaced by their kind, n_chars follows;
5. packing: the pieces of what is left, with their sequences.

Between stages the rows are written as Parquet to the shared checkpoint folder.
SQL cannot express the stages (trained models, sampled signatures, a tokenizer),
so ORACLE_SQL is None; a test runs the stages on a small table whose rows to keep
are known.

Defined results: a stage judges rows by their text, so repeated ids do not matter;
of repeated rows near-dedup keeps one; rows without an id pass near-dedup as they are
and are packed with a null id; null and empty texts fail the quality rules; an empty
table gives no rows.  Columns beyond those of ``documents`` pass the first four
stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolbook.llm import decontaminate, line_rules, neardup, packing, pii
from poolbook.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_rules.keep(docs, line_rules.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("PII", personal_data),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
