import json

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweir import sinks, sources
from logweir.session import scratch_path
from logweir.sources import employer_text
from logweir.sources.files import ACCESS_LOG_FIELDS, json_schema
from logweir.sources.jdbc import _split_options
from logweir.sources.streams import log_options


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- files ----


def test_read_lines(spark, tmp_path):
    path = write(tmp_path / "w", "fig,plum\nfig,pear,lime\nlime,date,lime")
    assert rows(sources.read_lines(spark, path)) == [("fig,pear,lime",), ("fig,plum",), ("lime,date,lime",)]


def test_read_delimited_keeps_exact_arity(spark, tmp_path):
    path = write(tmp_path / "d", "a,b,c\na,b\na,b,c,d\n,,c\na,b,c,\n")
    assert rows(sources.read_delimited(spark, path, ",", ["x", "y", "z"])) == [("", "", "c"), ("a", "b", "c"), ("a", "b", "c")]


def access_line(**known):
    fields = ["-"] * 72
    for name, value in known.items():
        fields[ACCESS_LOG_FIELDS[name]] = value
    return "\t".join(fields)


def test_parse_access_log(spark):
    good = access_line(cdn="edge", time="[20190101010101 +0800]", domain="d.example", traffic="16384")
    lines = spark.createDataFrame([(good,), ("too\tshort",)], "value string")
    row = sources.parse_access_log(lines).first()
    assert (row.cdn, row.region, row.time, row.domain, row.traffic) == ("edge", "-", "20190101010101", "d.example", "16384")
    assert sources.parse_access_log(lines).count() == 1
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        sources.parse_access_log(lines, arity=None).collect()


def test_json_strings(spark):
    df = spark.createDataFrame([('{"name":"Yin","address":{"city":"Columbus","state":"Ohio"}}',)], "j string")
    row = sources.read_json_strings(df, "j").first()
    assert (row.name, row.address.city, row.address.state) == ("Yin", "Columbus", "Ohio")
    mixed = spark.createDataFrame([('{"a": 1, "b": 1.5}',), ('{"a": 2, "c": null, "d": [1]}',), ("{bad",), (None,)], "j string")
    assert json_schema(mixed, "j").simpleString() == "struct<a:bigint,b:double,c:string,d:array<bigint>>"
    assert [r.a for r in sources.read_json_strings(mixed, "j", "a long").collect()] == [1, 2, None, None]


def test_json_schema_by_kind(spark):
    """Names like types, numbers beyond BIGINT, keys of several kinds and empty or nested objects."""
    texts = ['{"VOID": 1, "n": 12345678901234567890, "DECIMAL": {"OBJECT": [{"x": null}]}, "m": 1, "e": {}}', '{"m": "t", "a b": true, "n": 1}']
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    found = {r.VOID: (r.n, r.m, r["a b"]) for r in sources.read_json_strings(df, "j").collect()}
    assert found == {1: (Decimal("12345678901234567890"), "1", None), None: (Decimal(1), "t", True)}


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "p.json", '{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    df = spark.read.json(path)
    assert df.schema.simpleString() == "struct<age:bigint,name:string>"
    assert rows(df) == [(19, "Justin"), (30, "Andy"), (None, "Michael")]


def test_sql_on_path_and_merged(spark, tmp_path):
    out = str(tmp_path / "t")
    squares = spark.range(1, 6).select(F.col("id").alias("value"), (F.col("id") * F.col("id")).alias("square"))
    cubes = spark.range(6, 11).select(F.col("id").alias("value"), F.expr("id * id * id AS cube"))
    sinks.write_parquet(squares, f"{out}/key=1")
    sinks.write_parquet(cubes, f"{out}/key=2")
    merged = sources.read_merged(spark, out)
    assert sorted(merged.columns) == ["cube", "key", "square", "value"] and merged.count() == 10
    found = sources.sql_on_path(spark, "parquet", f"{out}/key=1", "SELECT max(square) FROM {source}")
    assert found.first()[0] == 25


def test_load_ctrl_a(spark, tmp_path):
    odd = write(tmp_path / "odd", '1\x01"open\n2\x01\n3\x01\\N\n\x01"a" b\n')
    assert rows(sources.load_ctrl_a(spark, odd, "key int, value string")) == [(1, '"open'), (2, ""), (3, None), (None, '"a" b')]
    path = write(tmp_path / "kv", "238\x01val_238\n86\x01val_86\n0\x01val_0\n0\x01val_0\n")
    df = sources.load_ctrl_a(spark, path, "key int, value string")
    assert rows(df.filter("key < 10")) == [(0, "val_0"), (0, "val_0")]
    joined = df.join(sources.records(spark, 100), "key")
    assert [tuple(r) for r in joined.collect()] == [(86, "val_86", "val_86")]


def test_list_files(spark, tmp_path):
    write(tmp_path / "a.txt", "12345")
    write(tmp_path / "b.txt", "1")
    listed = sources.list_files(spark, f"{tmp_path}/*.txt")
    assert sorted(r.length for r in listed.collect()) == [1, 5]


def test_generated(spark):
    words = sources.generate_words(spark, 1000, seed=3)
    got = words.collect()
    assert {r.i for r in got} == set(range(1, 1001)) and {r.word for r in got} == set("abcdef")
    assert all(r.partition == r.i % 3 for r in got)
    assert sorted(got) == sorted(sources.generate_words(spark, 1000, seed=3).collect())
    assert sources.in_memory(spark, [1, 2, 3], "int").columns == ["value"]


# ---- Avro ----


def avro_long(n):
    n = (n << 1) ^ (n >> 63)
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def avro_text(text):
    data = text.encode()
    return avro_long(len(data)) + data


def avro_user(name, color, numbers):
    out = avro_text(name) + (avro_long(1) if color is None else avro_long(0) + avro_text(color))
    if numbers:
        out += avro_long(len(numbers)) + b"".join(map(avro_long, numbers))
    return out + avro_long(0)


def test_read_avro(spark, tmp_path):
    fields = [
        {"name": "name", "type": "string"},
        {"name": "favorite_color", "type": ["string", "null"]},
        {"name": "favorite_numbers", "type": {"type": "array", "items": "int"}},
    ]
    schema = json.dumps({"type": "record", "name": "User", "fields": fields})
    block = avro_user("Alyssa", None, [3, 9, 15, 20]) + avro_user("Ben", "red", [])
    sync = bytes(range(16))
    meta = avro_long(2) + avro_text("avro.schema") + avro_text(schema) + avro_text("avro.codec") + avro_text("null") + avro_long(0)
    data = b"Obj\x01" + meta + sync + avro_long(2) + avro_long(len(block)) + block + sync
    (tmp_path / "users.avro").write_bytes(data)
    wanted = StructType.fromDDL("name string, favorite_color string, favorite_numbers array<int>")
    users = [("Alyssa", None, [3, 9, 15, 20]), ("Ben", "red", [])]
    assert rows(sources.read_avro(spark, str(tmp_path / "users.avro"), wanted)) == users
    (tmp_path / "users").write_bytes(data)
    try:
        assert rows(sources.read_avro(spark, str(tmp_path / "users"), wanted)) == users
    except ValueError as error:
        assert "spark-avro" in str(error)


# ---- employer text ----

EMPLOYERS = "7, ann ,1,520,31\n8,bo,0,610,42,extra\n9,cy,2,700,53,,\n\n10,di,3,820,64"


@pytest.fixture
def employers(tmp_path):
    write(tmp_path / "e1.txt", EMPLOYERS)
    write(tmp_path / "e2.txt", EMPLOYERS)
    return str(tmp_path)


def read_both(spark, path, schema=None, decode=False):
    sources.employer_source(spark)
    reader = spark.read.format("employer_text").option("decode_gender", str(decode).lower())
    reader = reader.schema(schema) if schema else reader
    through_source = reader.load(path)
    through_text = sources.read_employer_text(spark, path, schema, decode)
    assert through_source.columns == through_text.columns
    assert rows(through_source) == rows(through_text)
    return through_text


def test_employer_text(spark, employers):
    df = read_both(spark, f"{employers}/e1.txt")
    assert df.columns == ["id", "name", "gender", "salary", "com"]
    assert rows(df)[0] == (10, "di", "3", 820, 64) and df.count() == 4


def test_employer_labels_over_glob(spark, employers):
    df = read_both(spark, f"{employers}/*.txt", decode=True)
    assert df.columns[-1] == "comm"
    assert dict(rows(df.groupBy("gender").count())) == {"女": 2, "男": 2, "未知": 4}
    assert read_both(spark, employers, decode=True).count() == 8


def test_employer_globs_in_folders(spark, tmp_path):
    for folder in ("north", "nook", "south"):
        (tmp_path / "all" / folder).mkdir(parents=True)
        write(tmp_path / "all" / folder / "e.txt", EMPLOYERS)
    assert read_both(spark, f"{tmp_path}/all/n*/e.txt").count() == 8
    assert read_both(spark, f"{tmp_path}/a*/*/*.txt").count() == 12
    assert read_both(spark, f"{tmp_path}/all/n*").count() == 8


def test_employer_user_schema(spark, employers):
    schema = StructType.fromDDL("number bigint, who string, Gender string")
    assert rows(read_both(spark, f"{employers}/e1.txt", schema, True))[0] == (10, "di", "未知")
    with pytest.raises(ValueError):
        sources.read_employer_text(spark, employers, StructType.fromDDL("number double"))
    with pytest.raises(Exception, match="BIGINT or STRING"):
        spark.read.format("employer_text").schema("number double").load(employers).collect()


def test_employer_bad_input_fails(spark, tmp_path):
    sources.employer_source(spark)
    for text in ("7,ann,1", "x,ann,1,2,3", "7,ann,1,520,"):
        path = write(tmp_path / "bad.txt", text)
        with pytest.raises(Exception):
            spark.read.format("employer_text").load(path).collect()
        with pytest.raises(Exception):
            sources.read_employer_text(spark, path).collect()
    with pytest.raises(Exception, match="path is required"):
        spark.read.format("employer_text").load().collect()


@pytest.mark.parametrize("size", [1, 2, 5, 7, 64])
def test_employer_splits_cover_every_line_once(tmp_path, monkeypatch, size):
    path = write(tmp_path / "e.txt", EMPLOYERS)
    monkeypatch.setattr(employer_text, "SPLIT_BYTES", size)
    splits = employer_text.EmployerReader(path, employer_text.employer_schema(), False).partitions()
    lines = [line for split in splits for block in employer_text.line_blocks(split) for line in block.to_pylist()]
    assert lines == [line for line in EMPLOYERS.split("\n") if line]


# ---- databases and logs: options only, no server is started ----


def test_jdbc_split_options():
    assert _split_options(None, None, None) == {}
    options = _split_options("id", (1, 9), 4)
    assert options == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError):
        _split_options("id", None, 4)


def test_log_options():
    options = log_options("h:1", "t1,t2", "g", "earliest", rate_per_partition=100, partitions=3)
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t1,t2"
    assert options["maxOffsetsPerTrigger"] == "1500"
    with pytest.raises(ValueError):
        log_options("h:1", "t", "g", "middle")
    with pytest.raises(ValueError):
        log_options("h:1", "t", "g", rate_per_partition=100)


# ---- sinks ----


def test_write_text(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double")
    sinks.write_text(df, str(tmp_path / "t"))
    assert rows(spark.read.text(str(tmp_path / "t"))) == [("1,null,2.5",)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_text(df, str(tmp_path / "t"))


def test_write_partitioned_prunes(spark, tmp_path):
    out = str(tmp_path / "p")
    sinks.write_partitioned(spark.range(100).withColumn("k", F.col("id") % 4), out, "k")
    assert sorted(p.name for p in (tmp_path / "p").glob("k=*")) == ["k=0", "k=1", "k=2", "k=3"]
    assert spark.read.parquet(out).filter("k = 1").count() == 25
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_day_hour_rerun_replaces_its_own_folders(spark, tmp_path):
    out = str(tmp_path / "dh")
    schema = "id int, day string, hour string"
    sinks.write_day_hour(spark.createDataFrame([(1, "20190608", "08"), (2, "20190608", "09")], schema), out)
    again = spark.createDataFrame([(3, "20190608", "08")], schema)
    sinks.write_day_hour(again, out)
    sinks.write_day_hour(again, out)
    assert rows(spark.read.schema(schema).parquet(out)) == [(2, "20190608", "09"), (3, "20190608", "08")]


def test_buckets_join_without_shuffle(spark, tmp_path):
    for name in ("bucket_l", "bucket_r"):
        df = spark.range(100).withColumn("v", F.col("id") * 2)
        sinks.save_bucketed(df, name, 4, ["id"], sort=["id"], path=str(tmp_path / name), gather=name == "bucket_l")
    try:
        joined = spark.table("bucket_l").join(spark.table("bucket_r").hint("merge"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.sql("DROP TABLE bucket_l")
        spark.sql("DROP TABLE bucket_r")


def test_partitioned_buckets(spark, tmp_path):
    df = spark.createDataFrame([("Alyssa", None), ("Ben", "red")], "name string, color string")
    sinks.save_bucketed(df, "color_buckets", 42, ["name"], partition_by=["color"], path=str(tmp_path / "c"))
    try:
        assert rows(spark.table("color_buckets")) == [("Alyssa", None), ("Ben", "red")]
    finally:
        spark.sql("DROP TABLE color_buckets")


def test_write_external_appends(spark, tmp_path):
    options = {"path": str(tmp_path / "x")}
    for _ in range(2):
        sinks.write_external(spark.range(3), "parquet", options)
    assert sources.read_external(spark, "parquet", options).count() == 6


def test_scratch_path(spark):
    one, two = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
