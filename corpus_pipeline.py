"""The training-text pipeline: each stage takes the documents its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.llm.decontaminate import leaks
from logweir.llm.line_dedup import dedup_lines
from logweir.llm.mixing import WORD, mix
from logweir.llm.near_dedup import near_duplicates
from logweir.llm.tables import aside, cut, put_back, table
from logweir.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel model doesn't call toxic.

    A null, empty or wordless text scores as one without any suspect word. Repeated rows have one fate, all columns are
    kept whatever their names, an empty table stays empty; without usable labels the toxic share decides for all.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; a document that loses its last word goes.

    Null, empty and wordless texts stay as they are, rows with a null id go. Of equal lines that of the least doc_id and
    place stays; repeated rows are one document. All columns are kept whatever their names; an empty table stays empty.
    """
    columns = docs.columns
    docs, moved = aside(docs, "n_lines", "n_removed")
    left = dedup_lines(docs)
    left = left.where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return put_back(left.withColumn("n_chars", n_chars.cast("long")), moved, columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id.

    Null, empty and wordless texts are linked with nothing and stay, rows with a null id go. Repeated rows of the one
    that stays all stay; all columns are kept whatever their names; an empty table stays empty.
    """
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null, empty and wordless texts hold none; a document goes with all its repeated rows; all columns are kept whatever
    their names; an empty table stays empty.
    """
    found = leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each slot with its block of words and the documents they come from.

    Null, empty and wordless texts give no words, a null source is a source like others and comes last; other
    columns aren't read; an empty table gives no rows.
    """
    return mix(docs, with_text=True).texts()


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The stages hash words and train a model, which SQL can't express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
