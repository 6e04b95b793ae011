"""Word and page-view rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.functions.text import WHITESPACE, split_java
from logweir.operators import count_by, ranked, word_count
from logweir.sinks import write_text
from logweir.sources import read_lines


def sorted_word_count(lines: DataFrame, col: str = "value", sep: str = WHITESPACE) -> DataFrame:
    """Words by falling count, by name among equals."""
    return ranked(word_count(lines, col, sep), [F.desc("count"), F.asc("word")])


def page_view_rank(lines: DataFrame, position: int = 1, col: str = "value") -> DataFrame:
    """Pages named in one comma field of each line by falling view count; a short line fails the job."""
    pages = lines.select(split_java(F.col(col), ",")[position].alias("page"))
    return ranked(count_by(pages, "page", out="views"), [F.desc("views"), F.asc("page")])


def run(spark: SparkSession, source: str, out: str) -> None:
    write_text(sorted_word_count(read_lines(spark, source)), out, sep="\t")


def run_page_views(spark: SparkSession, source: str, out: str) -> None:
    write_text(page_view_rank(read_lines(spark, source)), out, sep="\t")
