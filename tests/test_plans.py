"""The physical plans keep the shape the jobs rely on."""

import pytest
from pyspark.sql import functions as F

from logweir import operators as op
from logweir.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plan_of(spark):
    return lambda name: plan(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize(
    "name",
    [
        "job_domain_top_hits",
        "job_domain_top_traffic",
        "job_domain_hourly",
        "job_domain_top_sql",
        "job_area_product_top3",
        "job_access_log_paid",
        "sorted_word_count",
        "json_status",
        "epoch_millis",
        "udaf_average",
        "word_stream",
    ],
)
def test_no_python_in_the_plan(plan_of, name):
    text = plan_of(name)
    assert not any(node in text for node in PYTHON_NODES), text


@pytest.mark.parametrize(
    "name", ["job_domain_top_hits", "job_area_product_top3", "job_domain_top_sql", "topn_per_group", "topn_by_traffic"]
)
def test_top_n_cuts_before_the_shuffle(plan_of, name):
    text = plan_of(name)
    assert "Partial" in text and "WindowGroupLimit" in text


def test_flagship_shuffles_counts_only(plan_of):
    text = plan_of("job_area_product_top3")
    clicks = text[text.index("partial_count") :]
    assert "Exchange hashpartitioning" not in clicks
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in clicks


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_gt", "GreaterThan(value,21.0)"),
        ("filter_between", "LessThanOrEqual(l_quantity,19.0)"),
        ("sql_on_file", "GreaterThan(c_acctbal,0.0)"),
        ("temp_view_sql", "LessThanOrEqual(c_acctbal,1900.0)"),
    ],
)
def test_filters_reach_the_scan(plan_of, name, pushed):
    assert pushed in plan_of(name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("project_cols", "struct<c_name:string,c_mktsegment:string>"),
        ("group_count", "struct<event_type:string>"),
        ("hourly_sum", "struct<ts:timestamp_ntz,user_id:bigint,value:double>"),
        ("word_count", "struct<text:string>"),
    ],
)
def test_scans_read_only_used_columns(plan_of, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(name)


def test_partition_filter_prunes(spark):
    orders = QUERIES["partitioned_roundtrip"](spark, FOLDER)
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan(orders.filter("o_orderstatus = 'F'"))


def test_bucketed_join_reads_without_shuffle(plan_of):
    text = plan_of("bucketed_roundtrip")
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_small_lookup_is_broadcast_and_large_is_not(spark, monkeypatch):
    big, small = spark.range(1000).toDF("k"), spark.range(10).toDF("k").withColumn("v", F.lit(1))
    assert "BroadcastHashJoin" in plan(op.lookup_join(big, small, "k"))
    assert not op.broadcast_if_small(small, max_rows=5)._jdf.queryExecution().logical().toString().startswith("ResolvedHint")


@pytest.mark.parametrize("strategy, node", [("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")])
def test_join_strategy(spark, strategy, node):
    a, b = spark.range(10).toDF("a"), spark.range(10).toDF("b")
    assert node in plan(op.join_on(a, b, [("a", "b")], strategy=strategy))


def test_edge_values_need_no_window(plan_of):
    for name in ("first_value", "last_value"):
        assert "Window" not in plan_of(name)


def test_upsert_reads_the_base_once(spark):
    base = spark.range(100_000).select(F.col("id").alias("k"), F.lit(0).alias("v"), F.lit(1).alias("w"))
    changes = spark.createDataFrame([(1, 9)], "k long, v int")
    text = plan(op.upsert(base, changes, ["k"]))
    assert text.count("Range (") == 1 and "FullOuter" in text


def test_statuses_are_parsed_for_ranked_products_only(plan_of):
    """The JSON is read above the first cut of each area, not below it."""
    text = plan_of("job_area_product_top3")
    parse = max(text.rfind("get_json_object"), text.rfind("variant"), text.rfind("parse_json"))
    assert -1 < parse < text.rfind("WindowGroupLimit")


def test_file_listing_reads_no_content(plan_of):
    assert "ReadSchema: struct<path:string,length:bigint>" in plan_of("list_files")
