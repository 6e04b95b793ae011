"""Most clicked products of each area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.functions import json_status
from logweir.operators import is_small, join_on, local_copy, top_n
from logweir.sinks import write_jdbc
from logweir.sources.jdbc import jdbc_bounds, read_jdbc, read_jdbc_query

COLUMNS = ["product_id", "product_name", "product_status", "area", "click_count", "day", "rank"]


def area_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks of each product in each area, from clicks (``c_city_id``, ``c_product_id``).

    The size of ``cities`` is checked. Few enough to broadcast, they are joined to the clicks where
    these lie and only counts are shuffled. Otherwise clicks are first counted per city and
    product, so that a hot city joins as one row per product.
    """
    cities = cities.select("city_id", "area")
    copy = local_copy(cities)  # worked out once
    if copy is not None or is_small(cities):
        cities = copy if copy is not None else cities
        placed = join_on(clicks, F.broadcast(cities), [("c_city_id", "city_id")])
        return placed.groupBy("area", "c_product_id").agg(F.count("*").alias("click_count"))
    per_city = clicks.groupBy("c_city_id", "c_product_id").agg(F.count("*").alias("clicks"))
    placed = join_on(per_city, cities, [("c_city_id", "city_id")])
    return placed.groupBy("area", "c_product_id").agg(F.sum("clicks").alias("click_count"))


def top_products(
    clicks: DataFrame, cities: DataFrame, products: DataFrame, day: str, n: int = 3, status: str = "extend_info"
) -> DataFrame:
    """The ``n`` most clicked products of each area with their status.

    ``products`` has ``product_id``, ``product_name`` and either JSON text in ``extend_info`` or a
    ready ``product_status`` column, named by ``status``.
    """
    # Only products of the best n of an area can be in its ranking, so names and JSON are looked up for these alone.
    # The product rows of an area are at most as many as its products, unless a product has several rows: rank again.
    known = products.select(F.col("product_id").alias("c_product_id"))
    counted = area_clicks(clicks, cities).join(known, "c_product_id", "left_semi")
    best = top_n(counted, ["area"], [F.desc("click_count"), F.asc("c_product_id")], n).drop("rank")
    found = join_on(best, products.select("product_id", "product_name", status), [("c_product_id", "product_id")])
    state = json_status(F.col(status)) if status == "extend_info" else F.col(status)
    described = found.withColumn("product_status", state).withColumn("day", F.lit(day))
    described = described.select(*COLUMNS[:-1])
    return top_n(described, ["area"], [F.desc("click_count"), F.asc("product_id")], n).select(*COLUMNS)


# The outside tables of the job.
CITY_TABLE, PRODUCT_TABLE = "city_info", "product_info"


def run(
    spark: SparkSession,
    url: str,
    props: Mapping[str, str],
    clicks: str,
    target: str,
    day: str,
    city_table: str = CITY_TABLE,
    product_table: str = PRODUCT_TABLE,
    parallel: int = 8,
) -> None:
    """Add the ranking of ``day`` to a database table.

    Cities and products come from the database at ``url``, products over ``parallel`` connections by id, clicks from
    a catalog table. Rows are appended: a day that is run again needs its old rows deleted in the database first.
    """
    cities = read_jdbc_query(spark, url, f"SELECT city_id, area FROM {city_table}", props)
    low, high = jdbc_bounds(spark, url, product_table, "product_id", props)
    split = {} if low is None else {"partition_column": "product_id", "bounds": (low, high + 1), "num_partitions": parallel}
    products = read_jdbc(spark, url, product_table, props, **split).select("product_id", "product_name", "extend_info")
    rows = spark.table(clicks).selectExpr("city_id AS c_city_id", "product_id AS c_product_id")
    write_jdbc(top_products(rows, cities, products, day), url, target, "append", props=props, connections=1)
