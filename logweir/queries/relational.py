"""Projection, filter, join, aggregate, window and sort operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logweir.functions import MeanAggregator, average, int_mean, register_average, split_java
from logweir.functions.text import WHITESPACE
from logweir.operators import (
    allowlist,
    blocklist,
    collect_by,
    conform,
    count_by,
    custom_aggregate,
    explode_tokens,
    first_value,
    flag_join,
    format_row,
    global_sql,
    hits_and_sum,
    join_on,
    last_value,
    lookup_join,
    map_batches,
    min_max_by,
    observed,
    persisted,
    project,
    pv_by_domain,
    ranked,
    relayout,
    rename,
    row_map,
    sql_over,
    top_n,
    totals,
    where,
    where_arity,
    with_expr,
    word_count,
)
from logweir.operators.projection import split_fields
from logweir.queries.derived import access_lines, cents
from logweir.queries.registry import Tables, query
from logweir.session import materialise

# ---- projections ----


@query("SELECT c_name, c_mktsegment FROM customer")
def project_cols(t: Tables) -> DataFrame:
    return project(t.customer, "c_name", "c_mktsegment")


@query("SELECT l_orderkey, l_linenumber, l_quantity + 1 AS quantity_plus FROM lineitem")
def project_arith(t: Tables) -> DataFrame:
    return project(t.lineitem, "l_orderkey", "l_linenumber", (F.col("l_quantity") + 1).alias("quantity_plus"))


@query("SELECT n_name AS names, 1 AS ages, '2019-05-21' AS day FROM nation")
def project_literal(t: Tables) -> DataFrame:
    named = rename(t.nation.select("n_name"), {"n_name": "names"})
    return with_expr(with_expr(named, "ages", F.lit(1)), "day", F.lit("2019-05-21"))


@query("SELECT 'Key: ' || n_nationkey || ', Value: ' || n_name AS value FROM nation", name="format_row")
def format_row_text(t: Tables) -> DataFrame:
    return t.nation.select(format_row("Key: {}, Value: {}", "n_nationkey", "n_name").alias("value"))


@query(
    """
    SELECT c_custkey, c_name AS name_entry, CAST(c_nationkey AS VARCHAR) AS nation_entry FROM customer
    """
)
def row_to_map(t: Tables) -> DataFrame:
    mapped = t.customer.select("c_custkey", row_map("c_name", "c_nationkey").alias("m"))
    return mapped.select(
        "c_custkey", F.col("m")["c_name"].alias("name_entry"), F.col("m")["c_nationkey"].alias("nation_entry")
    )


@query("SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS name_length, p_size + 1 AS size_plus FROM part")
def map_length(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.length("p_name").alias("name_length"), (F.col("p_size") + 1).alias("size_plus")
    )


@query(
    r"""
    SELECT doc_id, unnest(string_split_regex(rtrim(text, E' \t\n\r\f\x0B'), '\s+')) AS word FROM documents
    """
)
def explode_words(t: Tables) -> DataFrame:
    return explode_tokens(t.documents.select("doc_id", "text"), "text", WHITESPACE)


@query("SELECT n_name AS item FROM nation UNION ALL SELECT n_name || '1' FROM nation")
def flat_map_pair(t: Tables) -> DataFrame:
    return t.nation.select(F.explode(F.array("n_name", F.concat("n_name", F.lit("1")))).alias("item"))


@query("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier")
def conform_schema(t: Tables) -> DataFrame:
    from pyspark.sql.types import StructType

    wanted = StructType().add("s_suppkey", "long").add("s_name", "string").add("s_nationkey", "long")
    return conform(t.supplier, wanted)


@query("SELECT c_name FROM customer WHERE c_acctbal BETWEEN 13 AND 1900")
def temp_view_sql(t: Tables) -> DataFrame:
    return sql_over(t.customer, "customer_view", "SELECT c_name FROM customer_view WHERE c_acctbal BETWEEN 13 AND 1900")


@query("SELECT * FROM region")
def global_view_sql(t: Tables) -> DataFrame:
    return global_sql(t.region, "region_everywhere", "SELECT * FROM global_temp.region_everywhere")


# ---- filters ----


@query("SELECT event_id, value FROM events WHERE value > 21")
def filter_gt(t: Tables) -> DataFrame:
    return where(t.events.select("event_id", "value"), F.col("value") > 21)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 13 AND 19")
def filter_between(t: Tables) -> DataFrame:
    return where(t.lineitem, F.col("l_quantity").between(13, 19)).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    r"""
    SELECT doc_id, string_split(rtrim(text, E'\n'), E'\n')[2] AS second_line FROM documents
    WHERE len(string_split(rtrim(text, E'\n'), E'\n')) = 3
    """
)
def filter_arity(t: Tables) -> DataFrame:
    lines = where_arity(split_fields(t.documents.select("doc_id", "text"), "\n", "text"), "fields", 3)
    return lines.select("doc_id", F.col("fields")[1].alias("second_line"))


_BUSY_USERS = "SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 70"


def _busy_users(t: Tables) -> DataFrame:
    return count_by(t.events, "user_id", out="n").filter("n > 70").select("user_id")


@query(f"SELECT event_id, user_id FROM events WHERE user_id NOT IN ({_BUSY_USERS})")
def blocklist_filter(t: Tables) -> DataFrame:
    return blocklist(t.events.select("event_id", "user_id"), _busy_users(t), "user_id").select("event_id", "user_id")


@query(f"SELECT event_id, user_id FROM events WHERE user_id IN ({_BUSY_USERS})")
def allowlist_filter(t: Tables) -> DataFrame:
    return allowlist(t.events.select("event_id", "user_id"), _busy_users(t), "user_id").select("event_id", "user_id")


# ---- joins ----


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t: Tables) -> DataFrame:
    joined = join_on(t.orders, t.customer, [("o_custkey", "c_custkey")])
    return joined.select("o_orderkey", "c_name", "o_totalprice")


@query(
    """
    SELECT o_orderstatus, l_returnflag, count(*) AS lines
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    """
)
def join_shuffled(t: Tables) -> DataFrame:
    joined = join_on(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], strategy="shuffle_hash")
    return count_by(joined, "o_orderstatus", "l_returnflag", out="lines")


@query(
    """
    SELECT c_mktsegment, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """
)
def join_salted(t: Tables) -> DataFrame:
    joined = join_on(t.orders, t.customer, [("o_custkey", "c_custkey")], strategy="merge", salt=4)
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("orders"), F.sum(cents("o_totalprice")).alias("cents"))


@query(
    """
    SELECT c_custkey, s_name FROM customer JOIN (
      SELECT s_nationkey, max_by(s_name, s_suppkey) AS s_name FROM supplier GROUP BY s_nationkey
    ) ON c_nationkey = s_nationkey
    """
)
def join_broadcast(t: Tables) -> DataFrame:
    lookup = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), "s_suppkey", "s_name")
    joined = lookup_join(t.customer, lookup, "c_nationkey", dedupe_small_by=F.col("s_suppkey"))
    return joined.select("c_custkey", "s_name")


@query(
    """
    SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS flag
    FROM customer
    """
)
def join_left_flag(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return flag_join(t.customer.select("c_custkey"), urgent.withColumn("flag", F.lit(True)), "c_custkey")


@query("SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def join_diff_keys(t: Tables) -> DataFrame:
    joined = join_on(t.lineitem, t.part, [("l_partkey", "p_partkey")])
    return joined.select("l_orderkey", "l_linenumber", "p_name")


@query(
    """
    SELECT n_nationkey, n_name, s_suppkey, s_name FROM nation JOIN supplier ON n_nationkey = s_nationkey
    """
)
def join_sql_view(t: Tables) -> DataFrame:
    t.supplier.createOrReplaceTempView("supplier_rows")
    return sql_over(
        t.nation,
        "nation_rows",
        """
        SELECT n.n_nationkey, n.n_name, s.s_suppkey, s.s_name
        FROM nation_rows n JOIN supplier_rows s ON n.n_nationkey = s.s_nationkey
        """,
    )


@query("SELECT a.n_name AS left_name, b.n_name AS right_name FROM nation a JOIN nation b USING (n_nationkey)")
def join_self(t: Tables) -> DataFrame:
    a, b = t.nation.alias("a"), t.nation.alias("b")
    joined = a.join(b, F.col("a.n_nationkey") == F.col("b.n_nationkey"))
    return joined.select(F.col("a.n_name").alias("left_name"), F.col("b.n_name").alias("right_name"))


# ---- aggregates ----

_WORDS = r"unnest(string_split_regex(rtrim(text, E' \t\n\r\f\x0B'), '\s+'))"


@query(f"SELECT word, count(*) AS count FROM (SELECT {_WORDS} AS word FROM documents) GROUP BY word", name="word_count")
def word_count_docs(t: Tables) -> DataFrame:
    return word_count(t.documents, "text", WHITESPACE)


@query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def group_count(t: Tables) -> DataFrame:
    return count_by(t.events, "event_type")


@query("SELECT l_returnflag, l_linestatus, count(*) AS click_count FROM lineitem GROUP BY ALL")
def group_count_2(t: Tables) -> DataFrame:
    return rename(count_by(t.lineitem, "l_returnflag", "l_linestatus"), {"count": "click_count"})


@query(
    """
    SELECT o_custkey, o_orderpriority, count(*) AS hits,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS traffic
    FROM orders GROUP BY ALL
    """
)
def group_count_sum(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderpriority", cents("o_totalprice").alias("traffic"))
    return hits_and_sum(orders, ["o_custkey", "o_orderpriority"], "traffic")


@query(
    """
    SELECT user_id, strftime(ts, '%Y%m%d%H') AS hour,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
    FROM events GROUP BY ALL
    """
)
def hourly_sum(t: Tables) -> DataFrame:
    hours = t.events.select("user_id", F.date_format("ts", "yyyyMMddHH").alias("hour"), cents("value").alias("c"))
    return hours.groupBy("user_id", "hour").agg(F.sum("c").alias("total"))


@query("SELECT count(*) AS rows FROM lineitem")
def global_count(t: Tables) -> DataFrame:
    return totals(t.lineitem, rows=F.count("*"))


@query("SELECT CAST(sum(length(p_name)) AS BIGINT) AS name_chars, CAST(sum(p_size) AS BIGINT) AS sizes FROM part")
def global_sum_len(t: Tables) -> DataFrame:
    return totals(t.part, name_chars=F.sum(F.length("p_name")), sizes=F.sum("p_size"))


@query("SELECT CAST(sum(p_size) // count(*) AS BIGINT) AS mean_size FROM part", name="int_mean")
def int_mean_size(t: Tables) -> DataFrame:
    return totals(t.part, mean_size=int_mean("p_size"))


@query(
    """
    SELECT c_mktsegment, count(*) AS rows, min(c_acctbal) AS min, max(c_acctbal) AS max
    FROM customer GROUP BY c_mktsegment
    """
)
def min_max_by_group(t: Tables) -> DataFrame:
    return min_max_by(t.customer, "c_mktsegment", "c_acctbal")


_MEAN_CENTS = """
    SELECT c_nationkey, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / count(*) AS mean_cents
    FROM customer GROUP BY c_nationkey
    """


@query(_MEAN_CENTS)
def udaf_average(t: Tables) -> DataFrame:
    customers = t.customer.select("c_nationkey", cents("c_acctbal").alias("cents"))
    return customers.groupBy("c_nationkey").agg(average("cents").alias("mean_cents"))


@query(_MEAN_CENTS)
def udaf_sql(t: Tables) -> DataFrame:
    register_average(t.spark)
    customers = t.customer.select("c_nationkey", cents("c_acctbal").alias("cents"))
    sql = """
        SELECT c_nationkey, my_average_of(sum(cents), count(cents)) AS mean_cents
        FROM customer_cents GROUP BY c_nationkey
        """
    return sql_over(customers, "customer_cents", sql)


@query(_MEAN_CENTS)
def udaf_registered(t: Tables) -> DataFrame:
    """The registered aggregate itself, which Spark hands each group whole."""
    register_average(t.spark)
    customers = t.customer.select("c_nationkey", cents("c_acctbal").alias("cents"))
    return sql_over(customers, "customer_cents", "SELECT c_nationkey, my_average(cents) AS mean_cents FROM customer_cents GROUP BY c_nationkey")


_LARGE = 2**53


@query(
    f"""
    SELECT CASE WHEN o_orderstatus <> 'P' THEN {_LARGE} + o_custkey END AS k,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) AS mean_cents
    FROM orders GROUP BY 1
    """
)
def udaf_large_keys(t: Tables) -> DataFrame:
    """Keys beyond the whole numbers a DOUBLE holds, with NULL among them."""
    key = F.when(F.col("o_orderstatus") != "P", F.lit(_LARGE) + F.col("o_custkey")).alias("k")
    orders = t.orders.select(key, cents("o_totalprice").alias("cents"))
    return custom_aggregate(orders, ["k"], "cents", MeanAggregator(), "mean_cents")


@query(_MEAN_CENTS)
def udaf_custom(t: Tables) -> DataFrame:
    customers = t.customer.select("c_nationkey", cents("c_acctbal").alias("cents"))
    return custom_aggregate(customers, ["c_nationkey"], "cents", MeanAggregator(), "mean_cents")


@query(
    """
    SELECT o_orderpriority, chunk, string_agg(o_custkey || ':' || copies, ',' ORDER BY o_custkey) AS customers
    FROM (SELECT *, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) - 1) // 100 AS chunk
          FROM (SELECT o_orderpriority, o_custkey, count(*) AS copies FROM orders GROUP BY ALL))
    GROUP BY ALL
    """
)
def collect_by_key(t: Tables) -> DataFrame:
    collected = collect_by(t.orders, "o_orderpriority", "o_custkey", max_values=100)
    entries = F.transform("values", lambda v: F.concat(v["o_custkey"], F.lit(":"), v["copies"]))
    return collected.select("o_orderpriority", "chunk", F.array_join(entries, ",").alias("customers"))


@query(
    """
    SELECT count(*) AS total, count(*) FILTER (WHERE NOT regexp_matches(text, '\\.$')) AS errors FROM documents
    """
)
def etl_metrics(t: Tables) -> DataFrame:
    checked, metrics = observed(
        t.documents.select("text"), "document_pass", total=F.lit(True), errors=~F.col("text").rlike(r"\.$")
    )
    checked.write.format("noop").mode("overwrite").save()
    counts = metrics.get
    return t.spark.createDataFrame([(counts["total"], counts["errors"])], "total long, errors long")


@query(
    """
    SELECT CASE WHEN starts_with(url, 'http://') THEN '-'
                ELSE regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) END AS domain, count(*) AS pv
    FROM pages GROUP BY 1
    """,
    name="pv_by_domain",
)
def pv_by_domain_pages(t: Tables) -> DataFrame:
    return pv_by_domain(access_lines(t.pages).select(split_java(F.col("value"), "\t").alias("fields")))


# ---- windows, sorts, layout ----


@query(
    """
    SELECT o_custkey, o_orderkey, CAST(rk AS INTEGER) AS rank FROM (
      SELECT o_custkey, o_orderkey,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
      FROM orders) WHERE rk <= 10
    """
)
def rownum_sql(t: Tables) -> DataFrame:
    return sql_over(
        t.orders,
        "order_rows",
        """
        SELECT * FROM (
          SELECT o_custkey, o_orderkey,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
          FROM order_rows) WHERE rank <= 10
        """,
    )


@query(
    """
    SELECT * FROM (
      SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, CAST(row_number() OVER (
        PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey)
        AS INTEGER) AS rank
      FROM lineitem) WHERE rank <= 3
    """
)
def topn_per_group(t: Tables) -> DataFrame:
    order = [F.desc("l_extendedprice"), *map(F.asc, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])]
    lines = t.lineitem.select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    return top_n(lines, ["l_returnflag"], order, 3).drop("l_partkey", "l_suppkey")


@query(
    """
    SELECT * FROM (
      SELECT o_orderstatus, o_orderkey, CAST(row_number() OVER (
        PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
      FROM orders) WHERE rank <= 2000
    """
)
def topn_beyond_limit(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderstatus", "o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return top_n(orders, ["o_orderstatus"], order, 2000, falling="o_totalprice").drop("o_totalprice")


_PRIORITY_CUSTOMERS = """
    SELECT * FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY {measure} DESC, o_custkey)
                     AS INTEGER) AS rank
      FROM (SELECT o_orderpriority, o_custkey, count(*) AS hits,
                   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS traffic
            FROM orders GROUP BY ALL)) WHERE rank <= 10
    """


def _priority_customers(t: Tables, measure: str) -> DataFrame:
    orders = t.orders.select("o_orderpriority", "o_custkey", cents("o_totalprice").alias("traffic"))
    counted = hits_and_sum(orders, ["o_orderpriority", "o_custkey"], "traffic")
    return top_n(counted, ["o_orderpriority"], [F.desc(measure), F.asc("o_custkey")], 10)


@query(_PRIORITY_CUSTOMERS.format(measure="hits"))
def topn_by_hits(t: Tables) -> DataFrame:
    return _priority_customers(t, "hits")


@query(_PRIORITY_CUSTOMERS.format(measure="traffic"))
def topn_by_traffic(t: Tables) -> DataFrame:
    return _priority_customers(t, "traffic")


@query(
    """
    SELECT o_custkey, o_orderkey, first_value(o_orderstatus) OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS first_value FROM orders
    """,
    name="first_value",
)
def first_value_order(t: Tables) -> DataFrame:
    orders = first_value(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus")
    return orders.select("o_custkey", "o_orderkey", "first_value")


@query(
    """
    SELECT o_custkey, o_orderkey, last_value(o_orderstatus) OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value FROM orders
    """,
    name="last_value",
)
def last_value_order(t: Tables) -> DataFrame:
    orders = last_value(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus")
    return orders.select("o_custkey", "o_orderkey", "last_value")


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey")
def sort_asc(t: Tables) -> DataFrame:
    return ranked(t.nation.select("n_nationkey", "n_name"), ["n_nationkey"])


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_name")
def sort_multi(t: Tables) -> DataFrame:
    return ranked(t.customer.select("c_custkey", "c_name", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_name")])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k_global(t: Tables) -> DataFrame:
    return ranked(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query("SELECT event_id, event_type, value FROM events")
def repartition_preserves(t: Tables) -> DataFrame:
    return relayout(relayout(t.events.select("event_id", "event_type", "value"), None, "event_type"), 2, shuffle=False)


@query(
    """
    SELECT o_orderstatus AS key, count(*) AS n FROM orders GROUP BY 1
    UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1
    """
)
def persist_reuse(t: Tables) -> DataFrame:
    with persisted(count_by(t.orders, "o_orderstatus", "o_orderpriority", out="n")) as kept:
        by_status = kept.groupBy(F.col("o_orderstatus").alias("key")).agg(F.sum("n").alias("n"))
        by_priority = kept.groupBy(F.col("o_orderpriority").alias("key")).agg(F.sum("n").alias("n"))
        return materialise(by_status.union(by_priority), "persist")


@query("SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders")
def map_partitions(t: Tables) -> DataFrame:
    def to_cents(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        hundred = pa.scalar(100.0)
        for batch in batches:
            cents = pc.round(pc.multiply(batch.column("o_totalprice"), hundred)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("o_orderkey"), cents], names=["o_orderkey", "cents"])

    return map_batches(t.orders.select("o_orderkey", "o_totalprice"), to_cents, "o_orderkey long, cents long")
