import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweir import operators as op
from logweir.functions import Aggregator, MeanAggregator
from logweir.functions.text import WHITESPACE
from logweir.operators.projection import split_fields


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("Michael", None), ("Andy", 30), ("Justin", 19)], "name string, age long")


@pytest.fixture(scope="module")
def skewed(spark):
    """Rows of which a third share one key; some keys are NULL."""
    rng = random.Random(7)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", "c", None] * 2 + [f"k{i}" for i in range(5)]), rng.randrange(40), i)
            for i in range(3000)]
    return data, spark.createDataFrame(data, "k string, v int, id int").repartition(6)


# ---- projections and filters ----


def test_people_examples(people):
    assert rows(op.where(people, F.col("age") > 21)) == [("Andy", 30)]
    assert {r[0] for r in op.project(people, (F.col("age") + 1).alias("a")).collect()} == {None, 31, 20}
    assert Counter(rows(op.count_by(people, "age"))) == Counter([(None, 1), (19, 1), (30, 1)])
    assert rows(op.where(people, "age BETWEEN 13 AND 19"), "name") == [("Justin",)]


def test_format_row(people):
    shown = people.select(op.format_row("Name: {}, age {}", "name", "age").alias("v"))
    assert {r.v for r in shown.collect()} == {"Name: Michael, age null", "Name: Andy, age 30", "Name: Justin, age 19"}
    with pytest.raises(ValueError):
        op.format_row("{} {}", "name")


def test_row_map(people):
    mapped = {r.m["name"]: r.m["age"] for r in people.select(op.row_map("name", "age").alias("m")).collect()}
    assert mapped == {"Michael": None, "Andy": "30", "Justin": "19"}


def test_fields(spark):
    lines = spark.createDataFrame([("a,b,c",), ("a,b",), ("x,y,z,",)], "value string")
    fields = op.where_arity(split_fields(lines, ","), "fields", 3)
    assert rows(op.pick_fields(fields, "fields", {"third": 2, "first": 0})) == [("c", "a"), ("z", "x")]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        op.pick_fields(split_fields(lines, ","), "fields", {"third": 2}).collect()


def test_explode_tokens(spark):
    df = spark.createDataFrame([(1, " a b"), (2, "")], "i int, s string")
    assert rows(op.explode_tokens(df, "s", WHITESPACE)) == [(1, ""), (1, "a"), (1, "b"), (2, "")]
    assert rows(op.explode_tokens(df, "s", WHITESPACE, drop_empty=True)) == [(1, "a"), (1, "b")]


def test_word_count(spark):
    lines = spark.createDataFrame([("hello,word",), ("hello,every,one",), ("one,to,one",)], "value string")
    assert dict(rows(op.word_count(lines, "value", ","))) == {"one": 3, "hello": 2, "word": 1, "every": 1, "to": 1}


# ---- joins ----


@pytest.fixture(scope="module")
def join_sides(spark):
    wide = spark.createDataFrame([("01", "x"), ("02", "y"), ("03", "z")], "id string, name string")
    base = spark.createDataFrame([("01", "north", "22"), ("05", "south", "22")], "bid string, city string, age string")
    return wide, base


@pytest.mark.parametrize("strategy, salt", [(None, None), ("merge", None), ("shuffle_hash", None), (None, 3)])
def test_join_on(join_sides, strategy, salt):
    wide, base = join_sides
    joined = op.join_on(wide, base, [("id", "bid")], strategy=strategy, salt=salt)
    assert rows(joined, "id", "name", "city", "age") == [("01", "x", "north", "22")]
    assert joined.columns == ["id", "name", "bid", "city", "age"]


def test_join_on_refuses(join_sides):
    wide, base = join_sides
    with pytest.raises(ValueError):
        op.join_on(wide, base, [("id", "bid")], strategy="other")
    with pytest.raises(ValueError):
        op.join_on(wide, base, [("id", "bid")], how="full", salt=2)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_of_hot_key_is_whole(spark, skewed, how):
    data, df = skewed
    names = [("hot", "H1"), ("hot", "H2"), ("a", "A"), ("zz", "Z")]
    right = spark.createDataFrame(names, "rk string, label string")
    wanted = []
    for k, _, i in data:
        labels = [label for name, label in names if name == k]
        wanted += [(i, label) for label in labels or ([None] if how == "left" else [])]
    assert rows(op.join_on(df, right, [("k", "rk")], how=how, salt=5), "id", "label") == sorted(wanted, key=repr)


def test_lookup_join(spark):
    big = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, n int")
    small = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "only", 1)], "k string, label string, at int")
    joined = op.lookup_join(big, small, "k", dedupe_small_by=F.col("at"))
    assert rows(joined, "k", "n", "label") == [("a", 1, "new"), ("a", 2, "new"), ("b", 3, "only")]
    assert op.lookup_join(big, small, "k").count() == 5


def test_local_copies(spark, monkeypatch):
    from logweir.operators import joins

    df = spark.range(100).select("id", F.lit("é").alias("s"), F.array(F.lit(None).cast("int")).alias("a.b"))
    copy = op.local_copy(df)
    assert copy.schema.simpleString() == df.schema.simpleString() and rows(copy) == rows(df)
    assert op.local_copy(df.limit(0)).count() == 0
    assert op.local_copy(df.withColumn("s", F.repeat(F.lit("x"), 10_000))) is None
    assert op.local_copy(df.select(F.parse_json(F.lit("1")).alias("v"))) is None
    monkeypatch.setattr(joins, "LOCAL_ROWS", 99)
    assert op.local_copy(df) is None
    assert rows(op.broadcast_if_small(df)) == rows(df)


def test_arrow_aggregates_make_no_call_for_a_key(spark):
    df = spark.range(10_000).select((F.col("id") % 5000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    mean = op.custom_aggregate(df, ["k"], "v", MeanAggregator(), "m")
    plan = mean._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan and "partial_sum" in plan
    assert mean.count() == 5000


def test_is_small(spark):
    df = spark.range(100)
    assert op.is_small(df) and op.is_small(df.limit(0))
    assert not op.is_small(df, max_rows=99)
    assert not op.is_small(df, max_bytes=50)


def test_block_and_allow(spark):
    people = spark.createDataFrame([("17", "17,3,1"), ("18", "18,2,0"), (None, "?")], "k string, line string")
    listed = spark.createDataFrame([("17", True), ("17", True), ("18", False)], "k string, flag boolean")
    assert set(rows(op.blocklist(people, listed, "k", "flag"), "k")) == {("18",), (None,)}
    assert rows(op.blocklist(people, listed, "k"), "k") == [(None,)]
    assert rows(op.allowlist(people, listed, "k", "flag"), "k") == [("17",)]
    flagged = op.flag_join(people, listed.filter("flag").distinct(), "k")
    assert {(r.k, r.flag) for r in flagged.collect()} == {("17", True), ("18", False), (None, False)}


# ---- aggregates ----


def test_hits_and_sum(skewed):
    data, df = skewed
    wanted = defaultdict(lambda: [0, 0])
    for k, v, _ in data:
        wanted[k][0] += 1
        wanted[k][1] += v
    assert {r.k: [r.hits, r.v] for r in op.hits_and_sum(df, ["k"], "v").collect()} == dict(wanted)


@pytest.mark.parametrize("limit", [100_000, 7])
def test_collect_by_is_whole(skewed, limit):
    data, df = skewed
    got, held = Counter(), defaultdict(dict)
    for row in op.collect_by(df, "k", "v", max_values=limit).collect():
        assert row.chunk not in held[row.k]
        held[row.k][row.chunk] = [entry["v"] for entry in row["values"]]
        for entry in row["values"]:
            got[(row.k, entry["v"])] += entry["copies"]
    assert got == Counter((k, v) for k, v, _ in data)
    for k, chunks in held.items():
        values = [v for chunk in sorted(chunks) for v in chunks[chunk]]
        assert values == sorted(values) and sorted(chunks) == list(range(len(chunks)))
        assert all(len(chunks[c]) == limit for c in sorted(chunks)[:-1])
    assert (max(map(len, held.values())) > 1) == (limit == 7)


def test_collect_by_null_and_repeats(spark):
    df = spark.createDataFrame([(None, 3), (None, 3), (None, None), (1, 2), (1, 1), (1, 4)], "k int, v int")
    got = {(r.k, r.chunk): [tuple(e) for e in r["values"]] for r in op.collect_by(df, "k", "v", max_values=2).collect()}
    assert got == {(None, 0): [(None, 1), (3, 2)], (1, 0): [(1, 1), (2, 1)], (1, 1): [(4, 1)]}


class Widest(Aggregator):
    """Difference of the largest and smallest value."""

    buffer = StructType().add("lo", "long").add("hi", "long")
    result = StructType().add("x", "long")["x"].dataType

    def reduce(self, values):
        return int(values.min()), int(values.max())

    def merge(self, buffers):
        return int(buffers["lo"].min()), int(buffers["hi"].max())

    def finish(self, buffer):
        return buffer[1] - buffer[0]


@pytest.mark.parametrize("pending", [100_000, 2])
def test_custom_aggregate(skewed, pending):
    data, df = skewed
    groups = defaultdict(list)
    for k, v, _ in data:
        groups[k].append(v)
    spread = op.custom_aggregate(df, ["k"], "v", Widest(), "spread", pending)
    assert {r.k: r.spread for r in spread.collect()} == {k: max(v) - min(v) for k, v in groups.items()}
    mean = {r.k: r.m for r in op.custom_aggregate(df, ["k"], "v", MeanAggregator(), "m", pending).collect()}
    assert all(math.isclose(mean[k], sum(v) / len(v)) for k, v in groups.items())


def test_mean_aggregator_skips_null(spark):
    df = spark.createDataFrame([("a", None), ("a", 4.0), ("b", None)], "k string, v double")
    got = {r.k: r.m for r in op.custom_aggregate(df, ["k"], "v", MeanAggregator(), "m").collect()}
    assert got["a"] == 4.0 and math.isnan(got["b"])


def test_custom_aggregate_keeps_keys_exact(spark):
    big = 2**53
    df = spark.createDataFrame([(big + 1, "x", 1), (None, "x", 2), (big + 2, None, 3), (big + 1, "x", 5)], "k long, s string, v long")
    got = {(r.k, r.s): r.m for r in op.custom_aggregate(df, ["k", "s"], "v", MeanAggregator(), "m").collect()}
    assert got == {(big + 1, "x"): 3.0, (None, "x"): 2.0, (big + 2, None): 3.0}
    odd = spark.createDataFrame([(float("nan"), 1.0), (None, 3.0), (float("nan"), 5.0)], "k double, v double")
    assert sorted((r.k is None, r.m) for r in op.custom_aggregate(odd, ["k"], "v", MeanAggregator(), "m").collect()) == [(False, 3.0), (True, 3.0)]


def test_totals_and_min_max(spark):
    df = spark.createDataFrame([(0, 170.5), (1, 160.0), (0, 182.0)], "sex int, height double")
    assert rows(op.min_max_by(df, "sex", "height")) == [(0, 2, 170.5, 182.0), (1, 1, 160.0, 160.0)]
    assert op.totals(df, n=F.count("*"), s=F.sum("sex")).first() == (3, 1)


def test_observed_counts(spark):
    df, metrics = op.observed(spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int"), total=F.lit(True), even=F.expr("x % 2 = 0"))
    assert df.agg(F.sum("x")).first()[0] == 10
    assert metrics.get == {"total": 4, "even": 2}


def test_pv_by_domain(spark):
    full = ["-"] * 72
    full[10] = "a.example"
    df = spark.createDataFrame([(full,), (full,), (["short"],)], "fields array<string>")
    assert rows(op.pv_by_domain(df)) == [("-", 1), ("a.example", 2)]


# ---- windows ----


def test_first_and_last_value(spark):
    data = [("A", 1, "A1"), ("A", 2, "A2"), ("A", 3, "A3"), ("B", 1, "B1"), ("B", 2, "B2"), ("B", 3, "B3"), ("C", 1, "C1")]
    df = spark.createDataFrame(data, "k string, i int, v string")
    first = op.first_value(df, ["k"], ["i"], "v")
    assert rows(first, "v", "first_value") == sorted((v, k + "1") for k, _, v in data)
    backward = spark.createDataFrame([("A", 1, "A3"), ("A", 2, "A2"), ("A", 3, "A1"), ("C", 1, "C1")], "k string, i int, v string")
    last = op.last_value(backward, ["k"], ["i"], "v")
    assert rows(last, "v", "last_value") == [("A1", "A1"), ("A2", "A1"), ("A3", "A1"), ("C1", "C1")]


def test_edge_values_of_skewed_groups(skewed):
    data, df = skewed
    first, last = {}, {}
    for k, v, i in sorted(data, key=lambda r: (r[1], r[2])):
        first.setdefault(k, v * 10_000 + i)
        last[k] = v * 10_000 + i
    tagged = df.withColumn("tag", F.col("v") * 10_000 + F.col("id"))
    both = op.last_value(op.first_value(tagged, ["k"], ["v", "id"], "tag"), ["k"], ["v", "id"], "tag")
    got = both.collect()
    assert len(got) == len(data)
    assert all(r.first_value == first[r.k] and r.last_value == last[r.k] for r in got)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9)), min_size=1, max_size=60), n=st.integers(1, 4))
def test_top_n_matches_brute_force(spark, data, n):
    numbered = [(k, v, i) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(numbered, "k string, v int, id int")
    wanted = []
    for k, group in itertools.groupby(sorted(numbered, key=lambda r: (r[0], -r[1], r[2])), key=lambda r: r[0]):
        wanted += [(k, v, i, rank) for rank, (_, v, i) in enumerate(itertools.islice(group, n), 1)]
    assert rows(op.top_n(df, ["k"], [F.desc("v"), F.asc("id")], n)) == sorted(wanted, key=repr)


@pytest.mark.parametrize("splits", [None, 1, 5])
def test_top_n_of_a_hot_group(spark, skewed, splits):
    data, df = skewed
    groups = defaultdict(list)
    for k, v, i in data:
        groups[k].append((-v, i))
    wanted = [(k, -v, i, r) for k, g in groups.items() for r, (v, i) in enumerate(sorted(g)[:20], 1)]
    top = op.top_n(df, ["k"], [F.desc("v"), F.asc("id")], 20, splits=splits)
    assert rows(top) == sorted(wanted, key=repr)
    assert op.top_n(df, ["k"], [F.desc("v"), F.asc("id")], 2000).count() == len(data)


def test_ranked(spark):
    df = spark.createDataFrame([("x", 1), ("y", 3), ("z", 3)], "k string, n int")
    assert [r.k for r in op.ranked(df, [F.desc("n"), "k"]).collect()] == ["y", "z", "x"]
    assert [r.k for r in op.ranked(df, [F.desc("n"), "k"], 1).collect()] == ["y"]


# ---- layout, snapshots, catalog ----


def test_partitions_for():
    mib = 1024 * 1024
    assert [op.partitions_for(n * mib) for n in (0, 127, 128, 300)] == [1, 1, 2, 3]


def test_sized_and_relayout(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(5).write.parquet(path)
    df = op.sized(spark.read.parquet(path), path)
    assert df.count() == 1000 and df.rdd.getNumPartitions() == 1
    assert op.relayout(df, 3).rdd.getNumPartitions() == 3
    assert op.relayout(op.relayout(df, 3), 2, shuffle=False).rdd.getNumPartitions() == 2
    assert op.relayout(df, None, "id").count() == 1000


def test_persisted(spark):
    with op.persisted(spark.range(10)) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not kept.is_cached


def test_map_batches_sets_up_once_per_partition(spark):
    def tag(batches):
        import uuid

        import pyarrow as pa

        setup = uuid.uuid4().hex
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([setup] * len(batch))], ["id", "setup"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = op.map_batches(spark.range(0, 100, 1, 3), tag, "id long, setup string").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.id for r in got) == list(range(100)) and len({r.setup for r in got}) == 3


def test_upsert(spark):
    base = spark.createDataFrame([(f"key-{i}", 1000 + i) for i in range(1, 11)], "word string, cnt int")
    changes = spark.createDataFrame([("key-10", 8888), ("key-11", 1)], "word string, cnt int")
    once = op.upsert(base, changes, ["word"])
    wanted = {**{f"key-{i}": 1000 + i for i in range(1, 10)}, "key-10": 8888, "key-11": 1}
    assert dict(rows(once)) == wanted and once.count() == 11
    assert rows(op.upsert(once, changes, ["word"])) == rows(once)


def test_upsert_of_some_columns(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, pay double")
    changes = spark.createDataFrame([(2, None), (3, 9.0)], "id int, pay double")
    assert rows(op.upsert(base, changes, ["id"])) == [(1, "a", 1.0), (2, "b", None), (3, None, 9.0)]


def test_upsert_takes_the_latest(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, name string")
    changes = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (3, "c", 1), (None, "m", 1)], "id int, name string, at int")
    assert rows(op.upsert(base, changes, ["id"], order="at")) == [(1, "new"), (2, "b"), (3, "c"), (None, "m"), (None, "n")]
    with pytest.raises(Exception, match="several changes"):
        op.upsert(base, changes, ["id"]).collect()


def test_parts_and_salts_split_equal_rows(spark):
    same = spark.range(0, 1000, 1, 2).select(F.lit(7).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    assert op.top_n(same, ["k"], [F.asc("k")], 900, splits=8).count() == 900
    right = spark.createDataFrame([(7, "x")], "rk int, label string")
    assert op.join_on(same, right, [("k", "rk")], salt=4).count() == 1000
    salts = same.withColumn("s", F.monotonically_increasing_id() % 4).groupBy("s").count().collect()
    assert {r["count"] for r in salts} == {250}


def test_row_edits(spark):
    staff = spark.createDataFrame([("z1", 20, 18000), ("z2", 50, 300000), ("l1", 22, None)], "name string, age int, pay int")
    more = op.append_rows(staff, spark.createDataFrame([(1, "n", 2)], "pay int, name string, age int"))
    assert ("n", 2, 1) in rows(more)
    assert dict(rows(op.update_where(staff, F.col("name") == "z1", {"age": F.lit(1000)}), "name", "age"))["z1"] == 1000
    assert rows(op.delete_where(staff, F.col("pay") > 100_000), "name") == [("l1",), ("z1",)]
    assert op.delete_where(staff).count() == 0


def test_swap_snapshot(spark, tmp_path):
    spark.range(5).write.option("path", str(tmp_path / "v1")).saveAsTable("swap_me")
    try:
        old = spark.table("swap_me")
        op.swap_snapshot(op.delete_where(old, F.col("id") > 2), "swap_me", str(tmp_path / "v2"))
        assert rows(spark.table("swap_me")) == [(0,), (1,), (2,)]
        assert spark.read.parquet(str(tmp_path / "v1")).count() == 5
    finally:
        op.drop_table(spark, "swap_me")


def test_views_tables_and_schemas(spark, people, tmp_path):
    assert rows(op.sql_over(people, "people_v", "SELECT name AS names, 1 AS ages FROM people_v WHERE age > 21")) == [("Andy", 1)]
    assert op.global_sql(people, "people_g", "SELECT * FROM global_temp.people_g").count() == 3
    names = {(r.kind, r.name) for r in op.list_catalog(spark).collect()}
    assert ("table", "people_v") in names and ("function", "upper") in names
    wide = StructType().add("age", "double").add("name", "string")
    assert op.conform(people, wide).columns == ["age", "name"]
    assert op.assert_schema(people, people.schema) is people
    with pytest.raises(TypeError):
        op.assert_schema(people, wide)
    op.create_table(spark, "made", "word STRING, cnt INT", str(tmp_path / "made"), hash_by="word")
    op.create_table(spark, "made", "word STRING, cnt INT", str(tmp_path / "made"), hash_by="word")
    spark.sql("INSERT INTO made VALUES ('a', 1)")
    op.rename_table(spark, "made", "remade")
    assert rows(spark.table("remade")) == [("a", 1)]
    op.drop_table(spark, "remade")
    op.drop_table(spark, "remade")
    assert not spark.catalog.tableExists("remade")
