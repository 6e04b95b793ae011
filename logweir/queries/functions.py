"""Scalar functions and the UDF surface over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logweir.functions import (
    bracket_time,
    compact_time,
    day_of,
    decode,
    epoch_millis,
    hour_bucket,
    hour_of,
    item_count,
    json_status,
    like_count,
    register_udfs,
    resource_path,
    safe_double,
    safe_long,
    split_java,
    strict,
    url_host,
)
from logweir.operators import sql_over
from logweir.queries.registry import Tables, query


@query(
    """
    SELECT doc_id, CAST(len(f) AS INTEGER) AS fields, f[1] AS head, f[len(f)] AS tail
    FROM (SELECT doc_id, string_split(rtrim(text || ',,', ','), ',') AS f FROM documents)
    """
)
def fn_split_java(t: Tables) -> DataFrame:
    fields = t.documents.select("doc_id", split_java(F.concat("text", F.lit(",,")), ",").alias("f"))
    return fields.select(
        "doc_id", F.size("f").alias("fields"), F.col("f")[0].alias("head"), F.element_at("f", -1).alias("tail")
    )


@query("SELECT p_partkey, trim('  ' || p_name || ' ') AS name FROM part")
def fn_trim(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"))


@query(
    """
    SELECT page_id,
           CASE WHEN contains(url, m) THEN '/' || regexp_extract(split_part(url, m, 2), '^[^?#]*') END AS resource,
           CASE WHEN contains(url, m) THEN nullif(split_part(url, m, 2), '') END AS remainder
    FROM (SELECT *, '//' || regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) || '/' AS m FROM pages)
    """
)
def url_resource(t: Tables) -> DataFrame:
    url, host = F.col("url"), url_host(F.col("url"))
    return t.pages.select(
        "page_id",
        resource_path(url, host, "spec").alias("resource"),
        resource_path(url, host, "code").alias("remainder"),
    )


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN '1901010101' ELSE strftime(ts, '%Y%m%d%H') END AS hour
    FROM events
    """,
    name="hour_bucket",
)
def hour_bucket_events(t: Tables) -> DataFrame:
    stamp = F.when(F.col("event_type") == "error", F.lit("short")).otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    return t.events.select("event_id", hour_bucket(stamp).alias("hour"))


@query("SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS time FROM events", name="bracket_time")
def bracket_time_events(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("["), F.date_format("ts", "yyyyMMddHHmmss"), F.lit(" +0800]"))
    return t.events.select("event_id", bracket_time(raw).alias("time"))


def _mixed_number(lang: Column) -> Column:
    """Digits for English and German, digits with a blank or a line end for French and Spanish, else the text."""
    digits = F.col("n_chars").cast("string")
    return (
        F.when(lang.isin("en", "de"), digits)
        .when(lang == "fr", F.concat(F.lit(" "), digits))
        .when(lang == "es", F.concat(digits, F.lit("\n")))
        .otherwise(F.col("text"))
    )


@query("SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN n_chars ELSE 0 END AS number FROM documents", name="safe_long")
def safe_long_docs(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", safe_long(_mixed_number(F.col("lang"))).alias("number"))


@query(
    """
    SELECT event_id, CASE event_type WHEN 'view' THEN 0.0 WHEN 'error' THEN 0.0 ELSE value END::DOUBLE AS number
    FROM events
    """,
    name="safe_double",
)
def safe_double_events(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_type") == "view", F.lit("n/a")).when(
        F.col("event_type") != "error", F.col("value").cast("string")
    )
    return t.events.select("event_id", safe_double(raw).alias("number"))


@query("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem")
def strict_cast(t: Tables) -> DataFrame:
    text = F.col("l_quantity").cast("bigint").cast("string")
    return t.lineitem.select("l_orderkey", "l_linenumber", strict(text, "bigint").alias("quantity"))


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE epoch_ms(o_orderdate) END AS millis FROM orders
    """,
    name="epoch_millis",
)
def epoch_millis_orders(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    return t.orders.select("o_orderkey", epoch_millis(text).alias("millis"))


@query(
    """
    SELECT event_id,
           CASE WHEN event_type = 'signup' THEN '19700101' ELSE strftime(ts, '%Y%m%d') END AS day,
           CASE WHEN event_type = 'signup' THEN '00' ELSE strftime(ts, '%H') END AS hour
    FROM events
    """
)
def day_hour(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    compact = t.events.select("event_id", compact_time(text).alias("c"))
    return compact.select("event_id", day_of(F.col("c")).alias("day"), hour_of(F.col("c")).alias("hour"))


@query(
    """
    SELECT event_id, CAST(CASE event_type
      WHEN 'view' THEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER)
      WHEN 'purchase' THEN 0
      ELSE -1 END AS INTEGER) AS status
    FROM events
    """,
    name="json_status",
)
def json_status_events(t: Tables) -> DataFrame:
    number = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.col("props"))
        .when(kind == "purchase", F.lit('{"k": null}'))
        .when(kind == "click", F.concat(F.lit('{"k": "'), number, F.lit('"}')))
        .when(kind == "error", F.concat(F.lit('{"k": '), number))
    )
    return t.events.select("event_id", json_status(text, "k").alias("status"))


@query(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'unknown' END AS label
    FROM orders
    """
)
def decode_case(t: Tables) -> DataFrame:
    label = decode(F.col("o_orderstatus"), {"O": "open", "F": "filled"}, "unknown")
    return t.orders.select("o_orderkey", label.alias("label"))


_ITEMS = """
    SELECT {key}, CAST(CASE WHEN text = '' THEN 1 WHEN rtrim(text, ',') = '' THEN 0
                       ELSE len(string_split(rtrim(text, ','), ',')) END AS INTEGER) AS num FROM {table}
    """


@query(_ITEMS.format(key="conv_id, turn", table="conversations"), name="like_count")
def like_count_native(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", item_count(F.col("text")).alias("num"))


@query(_ITEMS.format(key="doc_id", table="documents"))
def udf_sql(t: Tables) -> DataFrame:
    register_udfs(t.spark)
    return sql_over(t.documents, "document_rows", "SELECT doc_id, like_count(text) AS num FROM document_rows")


@query(_ITEMS.format(key="doc_id", table="documents"))
def udf_df(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", like_count()("text").alias("num"))
