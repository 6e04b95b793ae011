"""Sources and sinks, read back after a write where the operator is a sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from logweir.operators import (
    assert_schema,
    create_table,
    drop_table,
    join_on,
    list_catalog,
    rename_table,
    sized,
)
from logweir.queries.derived import page_clicks
from logweir.queries.registry import Tables, query
from logweir.sinks import (
    save_bucketed,
    write_day_hour,
    write_external,
    write_parquet,
    write_partitioned,
    write_text,
)
from logweir.sources import (
    employer_source,
    list_files,
    load_ctrl_a,
    read_delimited,
    read_employer_source,
    read_employer_text,
    read_external,
    read_json_strings,
    read_lines,
    read_merged,
    records,
    sql_on_path,
    write_employer_text,
)
from logweir.session import scratch_table
from logweir.sources.employer_text import employer_schema
from logweir.sources.generated import words_for


@query("SELECT * FROM nation")
def scan_parquet(t: Tables) -> DataFrame:
    return t.spark.read.load(t.path("nation"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def sql_on_file(t: Tables) -> DataFrame:
    sql = "SELECT c_custkey, c_acctbal FROM {source} WHERE c_acctbal > 0"
    return sql_on_path(t.spark, "parquet", t.path("customer"), sql)


@query(
    """
    SELECT p_partkey AS value, CASE WHEN p_size <= 25 THEN p_size * p_size END AS square,
           CASE WHEN p_size > 25 THEN p_size * p_size * p_size END AS cube,
           CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS key
    FROM part
    """
)
def merge_schema_squares(t: Tables) -> DataFrame:
    out, size = t.scratch("squares"), F.col("p_size")
    squares = t.part.filter(size <= 25).select(F.col("p_partkey").alias("value"), (size * size).alias("square"))
    cubes = t.part.filter(size > 25).select(F.col("p_partkey").alias("value"), (size * size * size).alias("cube"))
    write_parquet(squares, f"{out}/key=1")
    write_parquet(cubes, f"{out}/key=2")
    return read_merged(t.spark, out).select("value", "square", "cube", "key")


@query("SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events")
def json_props_struct(t: Tables) -> DataFrame:
    wrapped = t.events.select(
        F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "props": '), "props", F.lit("}")).alias("j")
    )
    return read_json_strings(wrapped, "j").select("event_id", F.col("props.k").alias("k"))


@query("SELECT event_id, event_type, value FROM events")
def json_lines_scan(t: Tables) -> DataFrame:
    out = t.scratch("json")
    t.events.select("event_id", "event_type", "value").write.json(out)
    return t.spark.read.json(out).select("event_id", "event_type", "value")


@query(
    """
    SELECT c_custkey + 1 AS key, 'val_' || (c_custkey + 1) AS value, c_name FROM customer
    """
)
def range_records(t: Tables) -> DataFrame:
    # Customer keys count from 0, the records from 1.
    made = records(t.spark, t.customer.count())
    numbered = t.customer.select((F.col("c_custkey") + 1).alias("number"), "c_name")
    return join_on(made, numbered, [("key", "number")]).select("key", "value", "c_name")


@query(
    """
    SELECT event_id AS i, CAST(event_id % 3 AS INTEGER) AS partition,
           substring('abcdef', CAST(('0x' || substring(md5(event_id || '-0'), 1, 8))::BIGINT % 6 + 1 AS INTEGER), 1)
             AS word
    FROM events
    """
)
def word_stream(t: Tables) -> DataFrame:
    return words_for(t.events, "event_id")


@query("SELECT DISTINCT c_mktsegment AS segment, true AS filled FROM customer", name="list_files")
def file_listing(t: Tables) -> DataFrame:
    out = t.scratch("listed")
    write_partitioned(t.customer.select("c_custkey", "c_mktsegment"), out, "c_mktsegment")
    segment = F.regexp_extract("path", "/c_mktsegment=([^/]*)/", 1).alias("segment")
    return list_files(t.spark, f"{out}/*/*.parquet").groupBy(segment).agg((F.sum("length") > 0).alias("filled"))


@query("SELECT 'nations_here' AS name, count(*) AS rows FROM nation UNION ALL SELECT 'regions_here', count(*) FROM region")
def catalog_listing(t: Tables) -> DataFrame:
    """The views that the catalog lists, of those made here, each with its rows."""
    t.nation.createOrReplaceTempView("nations_here")
    t.region.createOrReplaceTempView("regions_here")
    listed = [r.name for r in list_catalog(t.spark).where("kind = 'table' AND name LIKE '%s_here'").collect()]
    counts = [t.spark.table(name).select(F.lit(name).alias("name")).groupBy("name").agg(F.count("*").alias("rows")) for name in listed]
    return reduce(DataFrame.union, counts)


@query("SELECT r_regionkey, r_name FROM region")
def schema_checked_scan(t: Tables) -> DataFrame:
    return assert_schema(t.region.select("r_regionkey", "r_name"), StructType.fromDDL("r_regionkey int, r_name string"))


@query("SELECT event_id, event_type FROM events")
def sized_scan(t: Tables) -> DataFrame:
    return sized(t.events.select("event_id", "event_type"), t.path("events"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC")
def sort_desc(t: Tables) -> DataFrame:
    store = read_external(t.spark, "parquet", {"path": t.path("customer")})
    return store.select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"))


@query(
    """
    SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN '"' || n_name WHEN 1 THEN '' WHEN 2 THEN n_name || ' "x"' ELSE n_name END
             AS n_name, n_regionkey FROM nation
    """
)
def ctrl_a_load(t: Tables) -> DataFrame:
    """Names with quotes in them and empty ones: the format has no quoting."""
    out, kind = t.scratch("ctrl-a"), F.col("n_nationkey") % 4
    name = F.when(kind == 0, F.concat(F.lit('"'), "n_name")).when(kind == 1, "").when(kind == 2, F.concat("n_name", F.lit(' "x"'))).otherwise(F.col("n_name"))
    write_text(t.nation.select("n_nationkey", name.alias("n_name"), "n_regionkey"), out, sep="\u0001")
    return load_ctrl_a(t.spark, out, "n_nationkey int, n_name string, n_regionkey int")


@query(
    """
    SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS domain, url, CAST(length(html) AS VARCHAR) AS traffic
    FROM pages WHERE starts_with(url, 'https://')
    """
)
def cdn_parse(t: Tables) -> DataFrame:
    # Plain http pages are written with a field too few, which the arity rule leaves out.
    out = t.scratch("cdn")
    clicks = page_clicks(t.pages)
    head = F.lit("edge,CN,3,20190506030101,10.0.0.1")
    cut = F.when(F.col("url").startswith("https://"), head).otherwise("edge,CN,3")
    clicks.select(F.concat_ws(",", cut, "domain", "url", "traffic").alias("value")).write.text(out)
    return read_delimited(t.spark, out).select("domain", "url", "traffic")


@query("SELECT s_suppkey || ',' || s_name || ',' || s_nationkey AS value FROM supplier")
def text_roundtrip(t: Tables) -> DataFrame:
    out = t.scratch("text")
    write_text(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), out)
    return read_lines(t.spark, out)


_EMPLOYERS = """
    SELECT c_custkey AS id, c_name AS name, {gender} AS gender, CAST(round(c_acctbal * 100) AS BIGINT) AS salary,
           CAST(c_nationkey AS BIGINT) AS {last}
    FROM customer
    """
_LABELLED = "CASE c_nationkey % 4 WHEN 0 THEN '男' WHEN 1 THEN '女' ELSE '未知' END"


def _write_employers(t: Tables) -> str:
    out = t.scratch("employers")
    salary = F.round(F.col("c_acctbal") * 100).cast("bigint")
    padded = F.concat(F.lit(" "), "c_name", F.lit(" "))
    write_text(t.customer.select("c_custkey", padded, F.col("c_nationkey") % 4, salary, "c_nationkey"), out)
    return out


@query(_EMPLOYERS.format(gender="CAST(c_nationkey % 4 AS VARCHAR)", last="com"))
def employer_text_scan(t: Tables) -> DataFrame:
    return read_employer_text(t.spark, _write_employers(t))


@query(_EMPLOYERS.format(gender=_LABELLED, last="comm"))
def employer_source_labels(t: Tables) -> DataFrame:
    employer_source(t.spark)
    return t.spark.read.format("employer_text").options(path=_write_employers(t) + "/*", decode_gender="true").load()


@query(_EMPLOYERS.format(gender="CAST(c_nationkey % 4 AS VARCHAR)", last="bonus"))
def employer_source_schema(t: Tables) -> DataFrame:
    employer_source(t.spark)
    reader = t.spark.read.format("employer_text").schema(employer_schema("bonus"))
    return reader.load(_write_employers(t))


@query(
    """
    SELECT c_custkey AS id, CAST(round(c_acctbal * 100) AS BIGINT) AS salary FROM customer
    WHERE c_nationkey % 4 = 1 AND round(c_acctbal * 100) > 100000 AND c_custkey % 2 = 0
    """
)
def employer_source_pruned(t: Tables) -> DataFrame:
    """Two columns; two of the filters reach the reader."""
    staff = read_employer_source(t.spark, _write_employers(t), ["id", "gender", "salary"])
    return staff.where("gender = '1' AND salary > 100000 AND id % 2 = 0").select("id", "salary")


@query(
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS gender, c_nationkey::BIGINT AS salary, c_custkey AS com FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'SUPPLIER', s_nationkey::BIGINT, s_suppkey FROM supplier
    """
)
def employer_source_write(t: Tables) -> DataFrame:
    """Written through the source: what an overwrite replaces is gone, what is appended is added."""
    out = t.scratch("employers")
    people = lambda df, key, name, kind, nation: df.select(
        F.col(key).alias("id"), F.col(name).alias("name"), kind.alias("gender"), F.col(nation).cast("bigint").alias("salary"), F.col(key).alias("com")
    )
    suppliers = people(t.supplier, "s_suppkey", "s_name", F.lit("SUPPLIER"), "s_nationkey")
    write_employer_text(suppliers, out)
    write_employer_text(people(t.customer, "c_custkey", "c_name", F.col("c_mktsegment"), "c_nationkey").repartition(3), out, "overwrite")
    write_employer_text(suppliers, out)
    return read_employer_source(t.spark, out)


@query("SELECT * FROM supplier")
def parquet_roundtrip(t: Tables) -> DataFrame:
    out = t.scratch("parquet")
    write_parquet(t.supplier, out)
    return t.spark.read.parquet(out)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def partitioned_roundtrip(t: Tables) -> DataFrame:
    out = t.scratch("partitioned")
    write_partitioned(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), out, "o_orderstatus")
    return t.spark.read.parquet(out)


@query("SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey")
def bucketed_roundtrip(t: Tables) -> DataFrame:
    # Both sides in the same buckets: the join reads them without a shuffle.
    customers, orders = scratch_table("customer_buckets"), scratch_table("order_buckets")
    for df, table, key in ((t.customer, customers, "c_custkey"), (t.orders, orders, "o_custkey")):
        save_bucketed(df, table, 42, [key], sort=[key], path=t.scratch("buckets"), gather=True)
    joined = join_on(t.spark.table(customers), t.spark.table(orders), [("c_custkey", "o_custkey")], strategy="merge")
    return joined.select("c_custkey", "c_name", "o_orderkey")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def part_bucket_roundtrip(t: Tables) -> DataFrame:
    table = scratch_table("order_parts")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    save_bucketed(orders, table, 8, ["o_custkey"], partition_by=["o_orderstatus"], path=t.scratch("part-buckets"))
    return t.spark.table(table)


@query("SELECT c_custkey AS id, c_name FROM customer")
def catalog_table_scan(t: Tables) -> DataFrame:
    table = scratch_table("customer_table")
    t.customer.write.option("path", t.scratch("table")).saveAsTable(table)
    return t.spark.sql(f"SELECT c_custkey AS id, c_name FROM {table}")


@query("SELECT r_regionkey, r_name FROM region")
def table_rename_roundtrip(t: Tables) -> DataFrame:
    old, new = scratch_table("region_old"), scratch_table("region_new")
    create_table(t.spark, old, "r_regionkey INT, r_name STRING", t.scratch("created"), hash_by="r_name")
    t.region.select("r_regionkey", "r_name").write.insertInto(old)
    rename_table(t.spark, old, new)
    drop_table(t.spark, old)
    return t.spark.table(new)


@query(
    """
    SELECT event_id, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H') AS hour
    FROM events
    """
)
def day_hour_partition(t: Tables) -> DataFrame:
    out = t.scratch("day-hour")
    rows = t.events.select(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("day"), F.date_format("ts", "HH").alias("hour")
    )
    write_day_hour(rows, out)
    return t.spark.read.schema("event_id long, day string, hour string").parquet(out)


@query(
    """
    SELECT user_id AS word, count(*) AS cnt FROM events GROUP BY 1 HAVING count(*) > 11
    UNION ALL SELECT user_id, count(*) FROM events GROUP BY 1 HAVING count(*) > 70
    """
)
def external_append(t: Tables) -> DataFrame:
    options = {"path": t.scratch("store")}
    counts = t.events.groupBy(F.col("user_id").alias("word")).agg(F.count("*").alias("cnt"))
    write_external(counts.filter("cnt > 11"), "parquet", options)
    write_external(counts.filter("cnt > 70"), "parquet", options)
    return read_external(t.spark, "parquet", options)
