"""Row edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logweir.operators import PartTable, append_rows, delete_where, swap_snapshot, update_where, upsert
from logweir.queries.registry import Tables, query
from logweir.session import scratch_table


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1000 ELSE o_totalprice END
             AS o_totalprice FROM orders
    UNION ALL SELECT -1 - o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'
    """
)
def upsert_orders(t: Tables) -> DataFrame:
    raised = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.col("o_totalprice") + 1000)
    added = t.orders.filter("o_orderstatus = 'P'").select(-1 - F.col("o_orderkey"), "o_totalprice")
    changes = raised.union(added).toDF("o_orderkey", "o_totalprice")
    return upsert(t.orders.select("o_orderkey", "o_totalprice"), changes, ["o_orderkey"])


@query(
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END
             AS o_orderstatus FROM orders
    UNION ALL SELECT -1 - o_orderkey, NULL, 'N' FROM orders WHERE o_orderstatus = 'P'
    """
)
def upsert_columns(t: Tables) -> DataFrame:
    marked = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("U"))
    added = t.orders.filter("o_orderstatus = 'P'").select(-1 - F.col("o_orderkey"), F.lit("N"))
    changes = marked.union(added).toDF("o_orderkey", "o_orderstatus")
    return upsert(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), changes, ["o_orderkey"])


@query(
    """
    SELECT COALESCE(c_custkey, o_custkey) AS key, COALESCE(last, c_acctbal) AS amount
    FROM customer FULL JOIN (
      SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS last FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
    ) ON c_custkey = o_custkey
    """
)
def upsert_latest(t: Tables) -> DataFrame:
    """Every order sets its customer's amount; the latest one counts."""
    changes = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("amount"), "o_orderkey")
    base = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    return upsert(base, changes, ["key"], order="o_orderkey")


@query(
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 1000.0 ELSE c_acctbal END::DOUBLE AS c_acctbal
    FROM customer
    """,
    name="update_where",
)
def update_where_segment(t: Tables) -> DataFrame:
    raised = {"c_acctbal": F.lit(1000.0)}
    return update_where(t.customer, F.col("c_mktsegment") == "MACHINERY", raised).select("c_custkey", "c_acctbal")


@query(
    """
    SELECT c_custkey FROM customer
    WHERE c_mktsegment = 'BUILDING' OR c_mktsegment <> 'MACHINERY'
    """,
    name="delete_where",
)
def delete_where_segment(t: Tables) -> DataFrame:
    # The condition is NULL for one segment, whose rows must stay.
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return delete_where(t.customer, segment == "MACHINERY").select("c_custkey")


@query("SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation", name="append_rows")
def append_rows_names(t: Tables) -> DataFrame:
    return append_rows(t.region.select(F.col("r_name").alias("name")), t.nation.select(F.col("n_name").alias("name")))


@query("SELECT s_suppkey, s_name FROM supplier WHERE NOT s_acctbal < 0")
def snapshot_swap(t: Tables) -> DataFrame:
    table = scratch_table("supplier")
    t.supplier.write.option("path", t.scratch("snapshot")).saveAsTable(table)
    swap_snapshot(delete_where(t.spark.table(table), F.col("s_acctbal") < 0), table, t.scratch("snapshot"))
    return t.spark.table(table).select("s_suppkey", "s_name")


@query(
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderkey % 1000 <> 8 AND NOT (o_custkey % 50 = 3 AND o_orderkey % 10 = 0)
    UNION ALL SELECT -1 - o_orderkey, o_custkey, 0.0 FROM orders WHERE o_orderkey % 1000 = 9
    """
)
def part_table_edits(t: Tables) -> DataFrame:
    """Merged, deleted by key and by condition; old versions are dropped at the end."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    table = PartTable.create(orders, t.scratch("parts"), ["o_orderkey"], parts=32)
    kind = F.col("o_orderkey") % 1000
    raised = orders.where(kind == 7).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    added = orders.where(kind == 9).select((-1 - F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", F.lit(0.0).alias("o_totalprice"))
    table.merge(raised.union(added))
    table.delete(orders.where(kind == 8))
    table.delete_where((F.col("o_custkey") % 50 == 3) & (F.col("o_orderkey") % 10 == 0) & (F.col("o_orderkey") >= 0))
    table.vacuum()
    return table.read()


@query("SELECT count(*) AS rows, true AS kept FROM orders WHERE o_orderkey % 97 = 5 AND o_orderkey < 100")
def part_table_untouched(t: Tables) -> DataFrame:
    """Few changed keys: as many parts at most are written, all others keep their folders; and the keys are found again."""
    orders = t.orders.select("o_orderkey", "o_totalprice")
    table = PartTable.create(orders, t.scratch("parts"), ["o_orderkey"], parts=32)
    few = orders.where((F.col("o_orderkey") % 97 == 5) & (F.col("o_orderkey") < 100))
    before = table.manifest()["parts"]
    table.merge(few.withColumn("o_totalprice", F.lit(-1.0)))
    after = table.manifest()["parts"]
    changed = sum(after[p] != folder for p, folder in before.items())
    found = table.lookup(few.select("o_orderkey")).where("o_totalprice = -1")
    return found.agg(F.count("*").alias("rows"), (F.count("*") >= F.lit(changed)).alias("kept"))
