import math
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logweir import functions as fn
from logweir.functions import udfs
from logweir.functions.text import WHITESPACE


@pytest.mark.parametrize(
    "sep, text, fields",
    [
        (",", "a,b,,", ["a", "b"]),
        (",", ",a,,b", ["", "a", "", "b"]),
        (",", ",,", []),
        (",", "", [""]),
        (",", "plain", ["plain"]),
        (",", None, None),
        ("\t", "a\tb\t\t", ["a", "b"]),
        (" ", "a  b ", ["a", "", "b"]),
        (WHITESPACE, " a \n\t b\r\n", ["", "a", "b"]),
        (WHITESPACE, " \t ", []),
        ("ab", "1ab2abab", ["1", "2"]),
        (r"\|", "x|y||", ["x", "y"]),
    ],
)
def test_split_java(column, sep, text, fields):
    assert column(lambda c: fn.split_java(c, sep), [text]) == [fields]


def test_item_count(column):
    assert column(fn.item_count, ["t,g,x,h", "z,e", "c,b", "one", "", ",,", "a,,", None]) == [4, 2, 2, 1, 1, 0, 1, None]


def test_like_count_agrees_with_item_count(spark):
    rows = spark.createDataFrame([("t,g,x,h",), ("z,e",), ("",), (",,",), ("a,,",), (None,)], "s string")
    pairs = rows.select(fn.item_count(F.col("s")).alias("a"), fn.like_count()("s").alias("b")).collect()
    assert [r.a for r in pairs] == [r.b for r in pairs]
    fn.register_udfs(spark)
    assert spark.sql("SELECT like_count('t,g,x,h') AS n").first().n == 4


def test_like_count_copies_a_slice_of_a_batch_at_a_time():
    texts = ["t,g,x,h", "", ",,", "a,,", None, "one", "é,ü,,", "x" * 3_000_000 + ",y", *["a,b," * 25_000] * 300]
    values = pa.array(texts)
    assert max(len(x) for x in udfs._short(values)) <= 15
    assert pa.concat_arrays([*udfs._short(values)]).equals(values)
    pool = pa.default_memory_pool()
    held = pool.bytes_allocated()
    tracemalloc.start()
    assert fn.like_count().func(values).to_pylist() == [4, 1, 0, 1, None, 1, 2, 2, *[50_000] * 300]
    assert tracemalloc.get_traced_memory()[1] < 2_000_000 and pool.bytes_allocated() - held < 2_000_000
    tracemalloc.stop()
    for kind in (pa.string(), pa.large_string()):
        assert fn.like_count().func(pa.array([], kind)).to_pylist() == []
        assert fn.like_count().func(pa.array([None, "p,q"], kind).slice(1)).to_pylist() == [2]


@pytest.mark.parametrize(
    "url, domain, spec, code",
    [
        ("http://a.example/line.html", "a.example", "/line.html", "line.html"),
        ("http://a.example/a/b/c/line.html?a=b&c=d", "a.example", "/a/b/c/line.html", "a/b/c/line.html?a=b&c=d"),
        ("http://b.example/line.html", "a.example", None, None),
        ("http://aXexample/line.html", "a.example", None, None),
        ("http://a.example/p#top", "a.example", "/p", "p#top"),
        ("http://a.example/", "a.example", "/", None),
    ],
)
def test_resource_path(spark, url, domain, spec, code):
    df = spark.createDataFrame([(url, domain)], "u string, d string")
    u, d = F.col("u"), F.col("d")
    row = df.select(fn.resource_path(u, d).alias("s"), fn.resource_path(u, d, "code").alias("c")).first()
    assert (row.s, row.c) == (spec, code)
    with pytest.raises(ValueError):
        fn.resource_path(u, d, "other")


def test_hour_bucket(column):
    texts = ["20190506030101", "2019050603", "201905060", "", None]
    assert column(fn.hour_bucket, texts) == ["2019050603", "2019050603"] + ["1901010101"] * 3


def test_bracket_time(column):
    assert column(fn.bracket_time, ["[20190101010101 +0800]", "[x]", None]) == ["20190101010101", None, None]


def test_safe_numbers(column):
    texts = ["12", "-7", "+5", " 12 ", "1.5", "x", "", None, "9" * 30]
    assert column(fn.safe_long, texts) == [12, -7, 5, 0, 0, 0, 0, 0, 0]
    assert column(fn.safe_int, ["12", "3000000000", "x", None]) == [12, None, None, None]
    assert column(fn.safe_double, ["8332", "1.5e1", "x", "", None]) == [8332.0, 15.0, 0.0, 0.0, 0.0]


def test_strict_fails(column):
    assert column(lambda c: fn.strict(c, "bigint"), ["12"]) == [12]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(lambda c: fn.strict(c, "bigint"), ["x"])


def test_epoch_millis(column):
    texts = ["2019-06-08 10:40:39", "bad", "", None]
    assert column(fn.epoch_millis, texts) == [1559990439000, 0, 0, 0]


def test_epoch_millis_of_long_fields(column):
    texts = ["2019-6-8 1:4:1234", "2019-6-8 1:4:12345", "02019-06-08 01:04:00", "2019-06-0008 01:04:00", "9" * 30 + "-1-1 1:1:1", "2019-999999999-1 1:1:1"]
    base = 1559955840000
    assert column(fn.epoch_millis, texts) == [base + 1234_000, base + 12345_000, base, base, 0, 0]


def test_whole_numbers_end_with_the_text(column):
    assert column(fn.safe_long, ["12\n", "\n12", "12"]) == [0, 0, 12]
    assert column(fn.safe_int, ["12\n", "12"]) == [None, 12]


def test_average_of_large_numbers(spark):
    df = spark.createDataFrame([(2**62,)] * 3, "x long")
    assert df.agg(fn.average("x").alias("a")).first().a == float(2**62)


def test_built_in_names_are_refused(spark):
    with pytest.raises(ValueError):
        fn.register_average(spark, "Mean")


def test_epoch_millis_lenient(column):
    exact, rolled = 1559955843000, 1577836800000
    texts = ["2019-6-8 1:4:3", "2019-06-08 01:04:03.5", "  2019-06-08  01:04:03", "2019-13-01 00:00:00", "2019-12-31 24:00:00"]
    assert column(fn.epoch_millis, texts) == [exact, exact, exact, rolled, rolled]


def test_day_and_hour(column):
    compact = lambda c: fn.compact_time(c)
    texts = ["2019-06-08 10:40:39", "bad"]
    assert column(compact, texts) == ["20190608104039", "19700101000000"]
    assert column(lambda c: fn.day_of(compact(c)), texts) == ["20190608", "19700101"]
    assert column(lambda c: fn.hour_of(compact(c)), texts) == ["10", "00"]


def test_json_status(column):
    cases = {
        '{"product_status": 1}': 1,
        '{"product_status": 1.9}': 1,
        '{"product_status": -1.9}': -1,
        '{"product_status": "1"}': -1,
        '{"product_status": true}': -1,
        '{"product_status": null}': 0,
        '{"product_status": 1e12}': 2147483647,
        '{"product_status": -1e12}': -2147483648,
        '{"other": 1}': -1,
        "{}": -1,
        "[]": -1,
        '[{"product_status": 1}]': -1,
        "{bad": -1,
        "": -1,
        None: -1,
    }
    assert column(fn.json_status, list(cases)) == list(cases.values())


def test_decode(column):
    assert column(fn.gender_label, ["0", "1", "2", None]) == ["男", "女", "未知", "未知"]
    assert column(lambda c: fn.decode(c, {"a": "x"}, "z"), ["a", "b"]) == ["x", "z"]


def test_means(spark):
    df = spark.createDataFrame([(3,), (4,), (None,)], "x int")
    row = df.select(fn.int_mean("x").alias("i"), fn.average("x").alias("a")).first()
    assert (row.i, row.a) == (3, 3.5)
    empty = df.filter("x > 9").select(fn.int_mean("x").alias("i"), fn.average("x").alias("a")).first()
    assert empty.i is None and math.isnan(empty.a)


def test_registered_average(spark):
    pay = spark.createDataFrame([("M", 3000), ("A", 4500), ("J", 3500), ("B", 4000)], "name string, salary long")
    pay.createOrReplaceTempView("pay")
    fn.register_average(spark, "my_average")
    assert spark.sql("SELECT my_average(salary) AS a FROM pay").first().a == 3750.0
    assert pay.agg(fn.average("salary").alias("a")).first().a == 3750.0
    merged = "SELECT my_average_of(sum(salary), count(salary)) AS a FROM pay"
    assert spark.sql(merged).first().a == 3750.0
    assert math.isnan(spark.sql(merged + " WHERE salary < 0").first().a)
