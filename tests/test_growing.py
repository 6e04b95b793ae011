"""The employer source's pruning and two-phase writes, and streams of growing files."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import datasource as ds, functions as F

from logweir import sources, streaming as st
from logweir.sources import employer_text, growing_text
from logweir.sources.employer_text import EmployerReader, FileSplit, employer_schema, filter_test, split_fields
from logweir.sources.growing_text import GrowingReader, whole_bytes


def staff(spark, n=40):
    return spark.range(n).selectExpr("id", "concat('n', id) AS name", "string(id % 4) AS gender", "id * 10 AS salary", "id AS com")


@pytest.fixture
def files(spark, tmp_path):
    sources.write_employer_text(staff(spark), str(tmp_path / "staff"))
    return str(tmp_path / "staff")


def test_filters_reach_the_reader(spark, files):
    df = sources.read_employer_source(spark, files, ["id", "salary"]).where("salary > 300 AND id IN (31, 33, 34) AND id % 2 = 1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "300" not in plan and "33" not in plan
    assert sorted(map(tuple, df.collect())) == [(31, 310), (33, 330)]


def test_only_needed_fields_are_split(files, monkeypatch):
    split = []

    def counted(lines, positions):
        split.append((len(lines), list(positions)))
        return split_fields(lines, positions)

    monkeypatch.setattr(employer_text, "split_fields", counted)
    layout = employer_schema()
    reader = EmployerReader(files, pa_schema(layout, "name", "gender"), False, layout)
    wanted = ds.EqualTo(("gender",), "3")
    assert list(reader.pushFilters([wanted])) == []
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["name"] for r in rows} == {f"n{i}" for i in range(3, 40, 4)} and {r["gender"] for r in rows} == {"3"}
    # The filter's field of all lines, the other one's of a fourth of them, the other fields never.
    assert sum(n for n, p in split if p == [2]) == 40 and sum(n for n, p in split if p == [1]) == 10
    assert {tuple(p) for _, p in split} == {(2,), (1,)}


def pa_schema(layout, *names):
    from pyspark.sql.types import StructType

    return StructType([layout[n] for n in names])


@pytest.mark.parametrize(
    "wanted, kept",
    [
        (ds.EqualTo(("id",), 3), [3]),
        (ds.Not(ds.EqualTo(("id",), 3)), [1, 2, 4]),
        (ds.In(("id",), (1, 4, 9)), [1, 4]),
        (ds.GreaterThanOrEqual(("id",), 3), [3, 4]),
        (ds.LessThan(("id",), 2), [1]),
        (ds.IsNotNull(("id",)), [1, 2, 3, 4]),
        (ds.IsNull(("id",)), []),
    ],
)
def test_number_filters(wanted, kept):
    name, test = filter_test(wanted, employer_schema())
    col = pa.array([1, 2, 3, 4], pa.int64())
    assert name == "id" and col.filter(test(col)).to_pylist() == kept


def test_text_filters_and_those_left_to_spark():
    schema, col = employer_schema(), pa.array(["ab", "bc", "é"])
    for wanted, kept in [(ds.StringStartsWith(("name",), "a"), ["ab"]), (ds.StringEndsWith(("name",), "c"), ["bc"]),
                         (ds.StringContains(("name",), "b"), ["ab", "bc"]), (ds.GreaterThan(("name",), "b"), ["bc", "é"])]:
        assert col.filter(filter_test(wanted, schema)[1](col)).to_pylist() == kept
    for other in (ds.EqualTo(("nobody",), 1), ds.EqualTo(("id", "x"), 1), ds.EqualTo(("id",), 1.5), ds.EqualTo(("id",), True),
                  ds.StringContains(("id",), "1"), ds.EqualNullSafe(("id",), 1), ds.Not(ds.EqualNullSafe(("id",), 1))):
        assert filter_test(other, schema) is None


def test_a_bad_field_counts_only_where_it_is_read(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1,ann,0,x,2\n2,bob,1,30,4\n3,cy\n")
    read = lambda *names: sources.read_employer_source(spark, str(tmp_path), names)
    assert sorted(r.id for r in read("id").collect()) == [1, 2, 3]
    assert [r.salary for r in read("id", "salary").where("id = 2").collect()] == [30]
    for names in (["salary"], ["id", "gender"]):
        with pytest.raises(Exception, match="fields|parse|invalid"):
            read(*names).collect()
    assert read("id").count() == 3
    with pytest.raises(Exception, match="other"):
        spark.read.format("employer_text").option("layout", employer_schema().json()).schema("other long").load(str(tmp_path)).collect()


def test_writes_add_and_replace(spark, tmp_path):
    out = str(tmp_path / "out")
    sources.write_employer_text(staff(spark, 5).repartition(3), out)
    sources.write_employer_text(staff(spark, 2), out)
    assert sorted(r.id for r in sources.read_employer_source(spark, out).collect()) == [0, 0, 1, 1, 2, 3, 4]
    sources.write_employer_text(staff(spark, 3), out, "overwrite")
    assert sorted(map(tuple, sources.read_employer_source(spark, out).collect())) == sorted(map(tuple, staff(spark, 3).collect()))
    sources.write_employer_text(staff(spark, 0), out)
    assert not [f for f in os.listdir(out) if f.startswith("_")]


@pytest.mark.parametrize("bad", ["a,b", "a\nb", " a", None])
def test_a_failing_task_leaves_no_file(spark, tmp_path, bad):
    out = str(tmp_path / "out")
    sources.write_employer_text(staff(spark, 5), out)
    before = sorted(os.listdir(out))
    rows = staff(spark, 50).repartition(4).withColumn("name", F.when(F.col("id") == 44, F.lit(bad)).otherwise(F.col("name")))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="name"):
            sources.write_employer_text(rows, out, mode)
    assert sorted(os.listdir(out)) == before
    assert sources.read_employer_source(spark, out).count() == 5


# ---- growing files ----


@pytest.fixture
def log(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    class Log:
        out, state, done = str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "done")

        def add(self, name, text):
            with open(folder / name, "a") as f:
                f.write(text)

        def run(self, fn=None):
            stream = sources.stream_growing(spark, str(folder), self.done).select("value")
            st.run_available(stream, self.out, self.state, fn=fn)
            return self.values()

        def values(self):
            return sorted((r.batch_id, r.value) for r in st.batch_results(spark, self.out, "value string").collect())

        def committed(self):
            return {os.path.basename(p): n for p, n in sources.committed_offset(self.done).items()}

    log = Log()
    log.folder = folder
    return log


def test_added_lines_come_once(log):
    log.add("a.log", "1\n2\n")
    assert log.run() == [(0, "1"), (0, "2")]
    log.add("a.log", "3\nhalf")
    log.add("b.log", "4\n\n")
    assert log.run()[2:] == [(1, ""), (1, "3"), (1, "4")]
    assert log.committed() == {"a.log": 4}  # of the first batch, as the second came
    log.add("a.log", " line\n")
    assert log.run()[5:] == [(2, "half line")]
    assert log.committed() == {"a.log": 6, "b.log": 3}
    assert len(log.run()) == 6  # nothing new, no batch


def test_a_kill_in_a_batch_loses_and_repeats_nothing(log):
    log.add("a.log", "1\n2\n")
    log.run()

    def killed(batch, batch_id):
        raise RuntimeError("killed")

    log.add("a.log", "3\n")
    with pytest.raises(Exception, match="killed"):
        log.run(killed)
    assert log.committed() in ({}, {"a.log": 4})  # the failed batch isn't done
    log.add("a.log", "4\n")
    assert [v for _, v in log.run()] == ["1", "2", "3"]  # the failed batch as it was
    assert [v for _, v in log.run()] == ["1", "2", "3", "4"]
    assert log.committed() == {"a.log": 6}


def test_a_shorter_file_fails(log):
    log.add("a.log", "1\n2\n")
    log.run()
    (log.folder / "a.log").write_text("1\n")
    with pytest.raises(Exception, match="bytes"):
        log.run()


@pytest.mark.parametrize("size", [1, 3, 8, 1000])
def test_splits_of_a_batch_cover_it_once(tmp_path, monkeypatch, size):
    path = tmp_path / "x.log"
    path.write_text("one\ntwo\n\nthree é\nfour\nrest")
    monkeypatch.setattr(employer_text, "SPLIT_BYTES", size)
    monkeypatch.setattr(growing_text, "TAIL_BYTES", size)
    reader = GrowingReader(str(path))
    end = reader.latestOffset()
    assert end == {str(path): len("one\ntwo\n\nthree é\nfour\n".encode())}
    assert reader.latestOffset() == end and reader.initialOffset() == {}
    start = {str(path): 4}
    got = [r for split in reader.partitions(start, end) for b in reader.read(split) for r in b.to_pylist()]
    assert [(r["position"], r["value"]) for r in got] == [(4, "two"), (8, ""), (9, "three é"), (18, "four")]
    assert reader.partitions(end, end) == []


def test_whole_bytes(tmp_path):
    path = tmp_path / "x"
    path.write_text("no break")
    assert whole_bytes(str(path), 8) == 0 and GrowingReader(str(path)).latestOffset() == {}
    path.write_text("")
    assert whole_bytes(str(path), 0) == 0
    assert isinstance(FileSplit("a", 0, 1), FileSplit)
