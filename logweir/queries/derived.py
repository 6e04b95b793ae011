"""Log lines and clicks that Spark derives from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logweir.functions import url_host
from logweir.sources.files import ACCESS_LOG_ARITY


def cents(col: str) -> Column:
    """Amount with two decimals as a whole number."""
    return F.round(F.col(col) * 100).cast("bigint")


def page_clicks(pages: DataFrame) -> DataFrame:
    """Every page as one click whose traffic is the length of its text."""
    return pages.select(
        url_host(F.col("url")).alias("domain"), "url", F.length("html").cast("bigint").alias("traffic")
    )


def click_lines(lineitem: DataFrame) -> DataFrame:
    """Every line item as a raw click line of few URLs; some have a field too few, some a traffic that is no number."""
    domain = F.concat(F.lower("l_returnflag"), F.lower("l_linestatus"), F.lit(".example"))
    url = F.concat(F.lit("http://"), domain, F.lit("/p"), F.col("l_partkey") % 50)
    number = F.col("l_linenumber")
    traffic = F.when(number == 7, "n/a").otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    time = F.date_format("l_shipdate", "yyyyMMddHHmmss")
    head = F.when(number == 6, "edge,CN").otherwise("edge,CN,3")
    return lineitem.select(F.concat_ws(",", head, time, F.lit("10.0.0.1"), domain, url, traffic).alias("value"))


def access_lines(pages: DataFrame) -> DataFrame:
    """Every page as a raw access-log line; ``http`` pages give a line cut after 21 fields."""
    known = {
        0: F.lit("edge"),
        1: F.lit("CN"),
        3: F.lit("E"),
        4: F.lit("[20190101010101 +0800]"),
        6: F.concat(F.lit("10.0.0."), F.col("page_id") % 256),
        10: url_host(F.col("url")),
        12: F.col("url"),
        20: F.length("html").cast("string"),
    }
    fields = [known.get(i, F.lit("-")) for i in range(ACCESS_LOG_ARITY)]
    whole, cut = F.concat_ws("\t", *fields), F.concat_ws("\t", *fields[:21])
    return pages.select(F.when(F.col("url").startswith("http://"), cut).otherwise(whole).alias("value"))


def employee_lines(events: DataFrame) -> DataFrame:
    """Every event as an employee line; some types give a bad id, salary or time."""
    kind = F.col("event_type")
    worker = F.when(kind == "error", F.concat(F.lit("x"), F.col("event_id"))).otherwise(
        F.col("event_id").cast("string")
    )
    at = F.when(kind == "signup", F.lit("no time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    pay = F.when(kind == "view", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return events.select(F.concat_ws("\t", worker, kind, at, pay).alias("value"))
