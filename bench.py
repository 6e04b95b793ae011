"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of local threads. With
``--shapes`` each job also runs as a plan that gathers whole groups and ends in one task.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, functions as F

from logweir.plans import cdn
from logweir.queries import QUERIES
from logweir.queries.derived import cents
from logweir.queries.registry import Tables
from logweir.session import build_session, release

HEADLINE = [
    "job_area_product_top3",
    "job_domain_top_hits",
    "job_domain_top_traffic",
    "job_domain_hourly",
    "job_domain_top_sql",
    "job_access_log_paid",
    "job_emp_etl",
    "page_view_rank",
    "sorted_word_count",
    "word_count",
    "group_count_sum",
    "topn_per_group",
    "topn_by_traffic",
    "first_value",
    "collect_by_key",
    "join_inner",
    "join_shuffled",
    "join_broadcast",
    "upsert_orders",
    "json_status",
    "epoch_millis",
    "udf_df",
    "stream_running_count",
    "stream_sliding_count",
]
RUNS = 3
# One run each: these write hundreds of folders or start a stream.
ONCE = {"job_emp_etl", "stream_running_count", "stream_sliding_count"}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(build, runs: int) -> float:
    """Median of ``runs`` warm runs."""
    if runs > 1:
        run(build())
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run(build())
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def repeated_clicks(t: Tables, copies: int = 10) -> DataFrame:
    """Clicks made of the line items, several of each; one domain has a third of them."""
    domain = F.when(F.col("l_quantity") <= 17, "hot.example").otherwise(
        F.concat(F.lower("l_returnflag"), F.lower("l_linestatus"), F.lit(".example"))
    )
    return t.lineitem.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select(
        domain.alias("domain"),
        F.concat(F.lit("http://"), domain, F.lit("/p"), "l_partkey", F.lit("-"), "copy").alias("url"),
        F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("time"),
        cents("l_extendedprice").alias("traffic"),
    )


def gathered_top(totals: DataFrame, measure: str, n: int = 10) -> DataFrame:
    """Top resources by gathering, sorting and cutting every domain whole, in one task."""
    entry = F.struct((-F.col(measure)).alias("by"), "resource", "hits", "traffic")
    groups = totals.groupBy("domain").agg(F.collect_list(entry).alias("all")).coalesce(1)
    return groups.select("domain", F.explode(F.slice(F.array_sort("all"), 1, n)).alias("e")).select("domain", "e.*")


def gathered_area_top3(t: Tables) -> DataFrame:
    placed = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    named = placed.groupBy("r_name", "l_partkey").count().join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    entry = F.struct((-F.col("count")).alias("by"), "p_partkey", "p_name", "p_size")
    groups = named.groupBy("r_name").agg(F.collect_list(entry).alias("all")).coalesce(1)
    return groups.select("r_name", F.explode(F.slice(F.array_sort("all"), 1, 3)).alias("e"))


def shapes(t: Tables) -> dict:
    """Each job as (gathered plan, our plan) over the same rows."""
    clicks = repeated_clicks(t)
    totals = cdn.resource_totals(clicks)
    return {
        "job_domain_top_hits": (lambda: gathered_top(totals, "hits"), lambda: cdn.top_resources(totals, "hits")),
        "job_domain_top_traffic": (
            lambda: gathered_top(totals, "traffic"),
            lambda: cdn.top_resources(totals, "traffic"),
        ),
        "job_domain_hourly": (lambda: cdn.hourly_traffic(clicks).coalesce(1), lambda: cdn.hourly_traffic(clicks)),
        "job_area_product_top3": (
            lambda: gathered_area_top3(t),
            lambda: QUERIES["job_area_product_top3"](t.spark, t.folder),
        ),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        times[name] = seconds(lambda: QUERIES[name](spark, folder), 1 if name in ONCE else RUNS)
        print(name, times[name], file=sys.stderr, flush=True)
        release(spark)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    if "--shapes" in sys.argv:
        t = Tables(spark, folder)
        line["shapes"] = {
            name: {"gathered": seconds(gathered, RUNS), "ours": seconds(ours, RUNS)}
            for name, (gathered, ours) in shapes(t).items()
        }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
