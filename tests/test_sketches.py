"""Thinned joins, pruned top-N, frequent items and the part table."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logweir.operators import PartTable, bloom_join, frequent_items, pruned_top_n, sketches


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- Bloom filter ----


def test_the_filter_is_below_the_shuffle(spark):
    big = spark.range(0, 20_000, 1, 4).select((F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 5000, 50).select(F.col("id").alias("j"), (F.col("id") * 2).alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bloom_join(big, small, [("k", "j")], bits=1 << 16)
        assert rows(joined) == rows(big.join(small, big.k == small.j))
        plan = joined._jdf.queryExecution().sparkPlan().toString().split("\n")
        lines = joined._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = "\n".join(lines)
    assert "getbit" in final and "Join" in "".join(plan)
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(k" in x)
    bits = next(i for i, x in enumerate(lines) if "getbit" in x)
    assert bits > exchange  # deeper in the tree: rows are thinned before they are shuffled


def test_false_positives_are_few_and_members_all_pass(spark):
    keys = spark.range(0, 3000).select((F.col("id") * 7).alias("k"))
    words = sketches.bloom_words(keys, [F.col("k")], 1 << 15).scalar()
    probe = spark.range(0, 70_000).select(F.col("id").alias("k"))
    passed = {r.k for r in probe.where(sketches.maybe_in(words, [F.col("k")], 1 << 15)).collect()}
    members = {i * 7 for i in range(3000)}
    assert members <= passed
    share = len(passed - members) / (70_000 - len([m for m in members if m < 70_000]))
    assert 0 < share < 0.03  # (1 - e^(-4 * 3000 / 32768))^4 is 0.9 %


def test_bloom_keys(spark):
    big = spark.createDataFrame([(1, "a", 0.0), (2, None, -0.0), (None, "a", 5.0), (1, "b", 1.0), (1, "a", 2.0)], "i int, s string, d double")
    small = spark.createDataFrame([(1, "a", 0.0), (7, "z", None)], "j long, t string, e double")
    for keys in ([("i", "j")], [("i", "j"), ("s", "t")], [("d", "e")], [("d", "j")]):
        for how in ("inner", "left_semi"):
            cond = [big[a] == small[b] for a, b in keys]
            assert rows(bloom_join(big, small, keys, how, bits=128)) == rows(big.join(small, cond, how))
    assert bloom_join(big, small.limit(0), [("i", "j")], bits=64).count() == 0
    for bad in (dict(how="left"), dict(bits=100), dict(keys=[("s", "j")])):
        with pytest.raises(ValueError):
            bloom_join(big, small, **{"keys": [("i", "j")], **bad})


# ---- pruned top N ----


def top(data, n):
    out = []
    for g in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        out += [(*r, i + 1) for i, r in enumerate(own[:n])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 7, 150, 5000])
def test_pruned_top_n(spark, n):
    rng = random.Random(n)
    data = [("hot", rng.randrange(1_000_000), i) for i in range(6000)]
    data += [("ties", 5, i) for i in range(3000)] + [(None, rng.random() and rng.randrange(9), i) for i in range(50)]
    data += [("nulls", None if i % 10 else i, i) for i in range(400)] + [("one", 1, 1)]
    df = spark.createDataFrame(data, "g string, v long, i long").repartition(5)
    assert rows(pruned_top_n(df, ["g"], "v", n, [F.asc("i")])) == top(data, n)


def test_rows_below_the_cutoff_go_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 4).select((F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"))
    cuts = {r.g: r for r in sketches.cutoffs(df, ["g"], "v", 20).collect()}
    kept = df.where(F.col("v") >= F.when(F.col("g") == 0, F.lit(cuts[0]._cut)).otherwise(F.lit(cuts[1]._cut))).groupBy("g").count().collect()
    assert {r._total for r in cuts.values()} == {50_000}
    assert all(20 <= r["count"] <= 1000 for r in kept)


def test_groups_that_fall_short_are_done_again(spark, monkeypatch):
    data = [(g, (i * 7919) % 10_007, i) for g in "ab" for i in range(5000)]
    df = spark.createDataFrame(data, "g string, v long, i long")
    right = sketches.cutoffs

    def wrong(df, by, value, n):
        return right(df, by, value, n).withColumn("_cut", F.when(F.col("g") == "a", 10_005.0).otherwise(F.col("_cut")))

    monkeypatch.setattr(sketches, "cutoffs", wrong)
    assert rows(pruned_top_n(df, ["g"], "v", 12, [F.asc("i")])) == top(data, 12)


def test_too_many_groups_for_cutoffs(spark, monkeypatch):
    data = [(g, (i * 7919) % 101, i) for g in "ab" for i in range(300)]
    monkeypatch.setattr(sketches, "is_small", lambda df: False)
    df = spark.createDataFrame(data, "g string, v long, i long")
    assert rows(pruned_top_n(df, ["g"], "v", 12, [F.asc("i")])) == top(data, 12)


# ---- frequent items ----


@pytest.mark.parametrize("tracked", [16, 64, 4096])
@pytest.mark.parametrize("k", [1, 10, 400])
def test_frequent_items(spark, tracked, k):
    rng = random.Random(k)
    data = [f"w{int(rng.paretovariate(0.8)) % 3000}" for _ in range(20_000)] + [None] * 500
    df = spark.createDataFrame([(w,) for w in data], "w string").repartition(6)
    wanted = sorted(Counter(w for w in data if w is not None).items(), key=lambda x: (-x[1], x[0]))[:k]
    assert [tuple(r) for r in frequent_items(df, "w", k, tracked).collect()] == wanted


def test_frequent_items_of_nothing(spark):
    assert frequent_items(spark.createDataFrame([(None,)], "w string"), "w", 3).collect() == []


def test_when_the_candidates_settle_it(spark, monkeypatch):
    assert sketches.settled(5, 71, 5, 1000, 100) and not sketches.settled(5, 70, 5, 1000, 100)
    assert not sketches.settled(4, 900, 5, 1000, 100) and not sketches.settled(0, None, 1, 0, 100)
    asked = []
    monkeypatch.setattr(sketches, "settled", lambda *a: asked.append(a) or True)
    data = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, "often").otherwise(F.concat(F.lit("x"), F.col("id"))).alias("w"))
    assert [tuple(r) for r in frequent_items(data, "w", 1, 256).collect()] == [("often", 25_000)]
    assert asked == [(1, 25_000, 1, 50_000, 256)]  # counted exactly among the candidates


# ---- part table ----


@pytest.fixture
def table(spark, tmp_path):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("x").alias("s"))
    return PartTable.create(df, f"file://{tmp_path}/t", ["k"], parts=8)


def contents(table, **kw):
    return {r.k: (r.v, r.s) for r in table.read(**kw).collect()}


def test_unchanged_parts_keep_their_files(spark, table):
    before = table.manifest()["parts"]
    changes = spark.createDataFrame([(3, 100), (500, 7)], "k int, v long")  # another key type than the table's
    assert table.merge(changes) == 1
    after = table.manifest()["parts"]
    assert 1 <= sum(after[p] != folder for p, folder in before.items()) <= 2
    held = contents(table)
    assert held[3] == (100, "x") and held[500] == (7, None) and held[4] == (8, "x") and len(held) == 201
    assert contents(table, version=0)[3] == (6, "x")  # an older version is still there


def test_deletes_and_updates(spark, table):
    table.delete(spark.createDataFrame([(1,), (2,), (999,)], "k long"))
    table.update_where(F.col("k") == 5, {"v": F.col("v") + 1})
    table.delete_where(F.col("k") >= 100)
    held = contents(table)
    assert set(held) == set(range(100)) - {1, 2} and held[5] == (11, "x")
    assert table.versions() == [0, 1, 2, 3]
    assert table.delete_where(F.col("k") < 0) == 3  # nothing hit, no version
    with pytest.raises(ValueError):
        table.update_where(F.lit(True), {"k": F.lit(1)})
    table.delete_where(F.lit(True))
    assert contents(table) == {}
    assert table.merge(spark.createDataFrame([(1, 1, "y")], "k long, v long, s string")) == 5
    assert contents(table) == {1: (1, "y")}


def test_lookup_reads_the_parts_of_its_keys(spark, table):
    keys = spark.createDataFrame([(7,), (7,), (1000,)], "k long")
    found = table.lookup(keys)
    assert [tuple(r) for r in found.collect()] == [(7, 14, "x")]
    assert 1 <= len({f.split("_part=")[1].split("/")[0] for f in found.inputFiles() if "_part=" in f}) <= 2


def test_two_edits_of_one_version(spark, table):
    m = table.manifest()
    rows = table.read([0])
    table._swap(m, [0], rows)
    with pytest.raises(RuntimeError, match="version 1"):
        table._swap(m, [0], rows)
    assert table.versions() == [0, 1] and len(contents(table)) == 200


def test_vacuum(spark, table):
    before = set(table.manifest()["parts"].values())
    table.merge(spark.createDataFrame([(3, 100)], "k long, v long"))
    now = set(table.manifest()["parts"].values())
    assert table.vacuum() == len(before - now) == 1
    assert table.versions() == [1] and len(contents(table)) == 200
    with pytest.raises(ValueError):
        table.read(version=0)
    with pytest.raises(ValueError):
        PartTable.create(spark.range(1), table.path, ["id"])


def test_several_changes_for_a_key(spark, table):
    changes = spark.createDataFrame([(3, 1, 1), (3, 2, 2)], "k long, v long, at long")
    with pytest.raises(Exception, match="several"):
        table.merge(changes.drop("at"))
    table.merge(changes, order="at")
    assert contents(table)[3] == (2, "x")
