"""CDN click jobs: rows with ``domain``, ``url``, ``time`` and ``traffic``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.functions import hour_bucket, resource_path, safe_long
from logweir.operators import count_by, hits_and_sum, top_n
from logweir.sinks import write_text
from logweir.sources import read_delimited
from logweir.operators.layout import persisted


def read_clicks(spark: SparkSession, path: str) -> DataFrame:
    """Click lines of eight comma fields; a traffic that is no whole number counts as 0."""
    return with_traffic(read_delimited(spark, path))


def with_traffic(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("traffic", safe_long(F.col("traffic")))


def resource_totals(clicks: DataFrame, mode: str = "spec") -> DataFrame:
    """Hits and traffic of each resource of each domain."""
    resources = clicks.select("domain", resource_path(F.col("url"), F.col("domain"), mode).alias("resource"), "traffic")
    return hits_and_sum(resources, ["domain", "resource"], "traffic")


def top_resources(totals: DataFrame, measure: str, n: int = 10) -> DataFrame:
    """The ``n`` resources of each domain with most ``hits`` or ``traffic``, by name among equals."""
    ranked = top_n(totals, ["domain"], [F.desc(measure), F.asc("resource")], n, falling=measure)
    return ranked.select("domain", "resource", "hits", "traffic", "rank")


def hourly_traffic(clicks: DataFrame) -> DataFrame:
    """Traffic of each domain and hour."""
    hours = clicks.select("domain", hour_bucket(F.col("time")).alias("hour"), "traffic")
    return hours.groupBy("domain", "hour").agg(F.sum("traffic").alias("traffic"))


def top_urls(clicks: DataFrame, day: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent URLs of each domain, by URL among equals, marked with the day."""
    visits = count_by(clicks, "domain", "url", out="num")
    best = top_n(visits, ["domain"], [F.desc("num"), F.asc("url")], n, falling="num")
    return best.withColumn("day", F.lit(day))


def run(spark: SparkSession, source: str, out: str, n: int = 10) -> None:
    """All three reports as text, the resource totals computed once for the two rankings."""
    clicks = read_clicks(spark, source)
    with persisted(resource_totals(clicks)) as totals:
        write_text(top_resources(totals, "hits", n), f"{out}/top_hits")
        write_text(top_resources(totals, "traffic", n), f"{out}/top_traffic")
    write_text(hourly_traffic(clicks), f"{out}/hourly")
