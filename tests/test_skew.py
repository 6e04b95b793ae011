"""A key holding a third of all rows is split, and results stay whole."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from logweir import operators as op
from logweir import sinks

ROWS = 120_000


@contextmanager
def settings(spark, **conf):
    keys = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@pytest.fixture(scope="module")
def clicks(spark):
    """A third of the rows have key 0, the others one of 1 to 1,000."""
    hot = F.col("id") % 3 == 0
    rows = spark.range(0, ROWS, 1, 8)
    # A payload that does not compress, so that partition sizes follow row counts.
    return rows.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 1000 + 1).cast("long").alias("k"),
        "id",
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


SMALL_PARTS = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "256KB",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "8",
}


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_join_splits_the_hot_key(spark, clicks):
    names = spark.range(0, 1001).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    with settings(spark, **SMALL_PARTS):
        rows, plan = final_plan(op.join_on(clicks, names, [("k", "key")], strategy="merge"))
    assert "skew=true" in plan
    assert len(rows) == ROWS and {r.id for r in rows} == set(range(ROWS))
    assert all(r.name == f"n{r.k}" for r in rows)


def test_first_value_splits_the_hot_key(spark, clicks):
    with settings(spark, **SMALL_PARTS):
        rows, plan = final_plan(op.first_value(clicks, ["k"], ["id"], "payload"))
    assert "skew=true" in plan
    first = {}
    for row in sorted(rows, key=lambda r: r.id):
        assert row.first_value == first.setdefault(row.k, row.payload)
    assert len(rows) == ROWS


def test_blocklist_splits_the_hot_key(spark, clicks):
    listed = spark.range(1, 500).toDF("k").hint("merge")
    with settings(spark, **SMALL_PARTS):
        rows, plan = final_plan(op.blocklist(clicks, listed, "k"))
    assert "skew=true" in plan
    assert len(rows) == sum(1 for i in range(ROWS) if i % 3 == 0 or i % 1000 + 1 >= 500)


def test_small_writes_use_all_cores(spark, clicks, tmp_path):
    sinks.write_partitioned(clicks.withColumn("k", F.least("k", F.lit(200))), str(tmp_path / "t"), "k")
    files = [p for p in (tmp_path / "t").glob("k=*/*.parquet")]
    assert len(files) == 201 and len({p.name.split("-")[1] for p in files}) == spark.sparkContext.defaultParallelism


def test_partitioned_write_splits_the_hot_folder(spark, clicks, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks.files, "SMALL_BYTES", 0)
    with settings(spark, **SMALL_PARTS):
        sinks.write_partitioned(clicks.withColumn("k", F.least("k", F.lit(9))), str(tmp_path / "t"), "k")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("k=*")}
    assert max(files.values()) > 1 and len(files) >= 9
    assert spark.read.parquet(str(tmp_path / "t")).select("id").distinct().count() == ROWS


def test_counts_shuffle_partial_results_only(spark, clicks):
    df = op.hits_and_sum(clicks, ["k"], "id")
    with settings(spark, **SMALL_PARTS):
        rows, plan = final_plan(df)
    assert sum(r.hits for r in rows) == ROWS
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")


def test_collected_hot_group_is_chunked(spark, clicks):
    rows = op.collect_by(clicks, "k", "id", max_values=5_000).collect()
    assert max(len(r["values"]) for r in rows) == 5_000
    assert sum(len(r["values"]) for r in rows) == ROWS
    hot = sorted(r.chunk for r in rows if r.k == 0)
    assert hot == list(range(-(-(ROWS // 3) // 5_000)))
