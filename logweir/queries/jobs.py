"""The complete jobs over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logweir.plans import access_log, cdn, employees, product_clicks, words
from logweir.queries.derived import access_lines, click_lines, employee_lines, page_clicks
from logweir.queries.registry import Tables, query
from logweir.sinks import write_text

_CLICKS = """
    (SELECT lower(l_returnflag || l_linestatus) || '.example' AS domain, '/p' || (l_partkey % 50) AS resource,
            'http://' || lower(l_returnflag || l_linestatus) || '.example/p' || (l_partkey % 50) AS url,
            strftime(l_shipdate, '%Y%m%d%H') AS hour,
            CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS traffic
     FROM lineitem WHERE l_linenumber <> 6)
    """
_TOP_RESOURCES = """
    SELECT * FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY domain ORDER BY {measure} DESC, resource) AS INTEGER) AS rank
      FROM (SELECT domain, resource, count(*) AS hits, CAST(sum(traffic) AS BIGINT) AS traffic
            FROM """ + _CLICKS + """ GROUP BY ALL)) WHERE rank <= 10
    """


def _clicks(t: Tables) -> DataFrame:
    """Clicks read from text lines, bad ones among them."""
    out = t.scratch("click-lines")
    click_lines(t.lineitem).write.text(out)
    return cdn.read_clicks(t.spark, out)


@query(_TOP_RESOURCES.format(measure="hits"))
def job_domain_top_hits(t: Tables) -> DataFrame:
    return cdn.top_resources(cdn.resource_totals(_clicks(t)), "hits")


@query(_TOP_RESOURCES.format(measure="traffic"))
def job_domain_top_traffic(t: Tables) -> DataFrame:
    return cdn.top_resources(cdn.resource_totals(_clicks(t)), "traffic")


@query(f"SELECT domain, hour, CAST(sum(traffic) AS BIGINT) AS traffic FROM {_CLICKS} GROUP BY ALL")
def job_domain_hourly(t: Tables) -> DataFrame:
    return cdn.hourly_traffic(_clicks(t))


@query(
    f"""
    SELECT domain, url, num, CAST(rk AS INTEGER) AS rank, '2019-05-21' AS day FROM (
      SELECT *, row_number() OVER (PARTITION BY domain ORDER BY num DESC, url) AS rk
      FROM (SELECT domain, url, count(*) AS num FROM {_CLICKS} GROUP BY ALL)) WHERE rk <= 10
    """
)
def job_domain_top_sql(t: Tables) -> DataFrame:
    return cdn.top_urls(_clicks(t), "2019-05-21")


@query(
    r"""
    SELECT 'edge,CN,E,20190101010101,10.0.0.' || page_id % 256 || ',' ||
           regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) || ',' || url || ',' || length(html) AS value
    FROM pages
    """
)
def job_access_log_clean(t: Tables) -> DataFrame:
    out = t.scratch("access-log")
    write_text(access_log.clean_lines(access_lines(t.pages)), out)
    return t.spark.read.text(out)


@query(
    """
    SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS domain, url, '20190101010101' AS time,
           length(html)::BIGINT AS traffic
    FROM pages WHERE NOT starts_with(url, 'http://') AND length(html) > 0
    """
)
def job_access_log_paid(t: Tables) -> DataFrame:
    return access_log.paid_traffic(access_lines(t.pages)).select("domain", "url", "time", "traffic")


@query(
    """
    WITH c AS (SELECT r_name AS area, l_partkey AS product_id, count(*) AS click_count
               FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
         j AS (SELECT p_partkey AS product_id, p_name AS product_name, p_size AS product_status, area, click_count,
                      '2016-05-05' AS day,
                      CAST(row_number() OVER (PARTITION BY area ORDER BY click_count DESC, p_partkey) AS INTEGER)
                        AS rank
               FROM c JOIN part ON c.product_id = p_partkey)
    SELECT * FROM j WHERE rank <= 3
    """
)
def job_area_product_top3(t: Tables) -> DataFrame:
    clicks = t.lineitem.select(F.col("l_suppkey").alias("c_city_id"), F.col("l_partkey").alias("c_product_id"))
    cities = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("city_id"), F.col("r_name").alias("area"))
    )
    products = t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), "p_size", F.lit("}")).alias("extend_info"),
    )
    return product_clicks.top_products(clicks, cities, products, "2016-05-05")


@query(
    """
    SELECT CAST(event_id AS INTEGER) AS id, event_type AS name,
           CASE WHEN event_type = 'signup' THEN 0 ELSE epoch_ms(date_trunc('second', ts)) END AS time,
           CASE WHEN event_type = 'view' THEN 0.0 ELSE value END::DOUBLE AS salary,
           CASE WHEN event_type = 'signup' THEN '19700101' ELSE strftime(ts, '%Y%m%d') END AS day,
           CASE WHEN event_type = 'signup' THEN '00' ELSE strftime(ts, '%H') END AS hour
    FROM events WHERE event_type <> 'error'
    """
)
def job_emp_etl(t: Tables) -> DataFrame:
    raw, out = t.scratch("employee-lines"), t.scratch("employees")
    employee_lines(t.events).write.text(raw)
    employees.run(t.spark, raw, out)
    return employees.read_employees(t.spark, out).drop("batch")


@query(
    """
    SELECT count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events
    """
)
def job_emp_etl_metrics(t: Tables) -> DataFrame:
    raw, out = t.scratch("employee-lines"), t.scratch("employees")
    employee_lines(t.events).write.text(raw)
    counts = employees.run(t.spark, raw, out)
    return t.spark.createDataFrame([(counts["total"], counts["errors"])], "total long, errors long")


@query(
    """
    SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS page, count(*) AS views
    FROM pages GROUP BY 1 ORDER BY 2 DESC, 1
    """
)
def page_view_rank(t: Tables) -> DataFrame:
    clicks = page_clicks(t.pages)
    return words.page_view_rank(clicks.select(F.concat_ws(",", "traffic", "domain").alias("value")))


@query(
    r"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest(string_split_regex(rtrim(text, E' \t\n\r\f\x0B'), '\s+')) AS word FROM documents)
    GROUP BY word ORDER BY 2 DESC, 1
    """
)
def sorted_word_count(t: Tables) -> DataFrame:
    return words.sorted_word_count(t.documents, "text")
