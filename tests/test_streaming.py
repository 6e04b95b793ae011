import os
import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logweir import streaming as st
from logweir.operators import blocklist
from logweir.sources import stream_files, stream_lines


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


class Feed:
    """A folder of text files, one batch each, and the folders of a query over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.files = spark, tmp_path, 0
        (tmp_path / "in").mkdir()

    def put(self, *lines):
        path = self.root / "in" / f"{self.files}.txt"
        path.write_text("".join(line + "\n" for line in lines))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def lines(self):
        return stream_lines(self.spark, "text", path=str(self.root / "in"), maxFilesPerTrigger="1")

    def words(self):
        return self.lines().select(F.explode(F.split("value", " ")).alias("word"))

    @property
    def out(self):
        return str(self.root / "out")

    @property
    def state(self):
        return str(self.root / "state")

    def run(self, stream, mode="append", fn=None):
        st.run_available(stream, self.out, self.state, mode, fn)
        return st.batch_results(self.spark, self.out, stream.schema)

    def by_batch(self, results, value="count", key="word"):
        got = {}
        for r in results.collect():
            got.setdefault(r.batch_id, {})[r[key]] = r[value]
        return got


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_batch_counts_forget(feed, capfd):
    feed.put("a b a")
    feed.put("b c")
    st.batch_counts(feed.words(), "word", feed.out, feed.state, show=10).awaitTermination()
    results = st.batch_results(feed.spark, feed.out, "word string, count long")
    assert feed.by_batch(results) == {0: {"a": 2, "b": 1}, 1: {"b": 1, "c": 1}}


def test_running_counts_give_every_key(feed):
    feed.put("a b a")
    feed.put("b c")
    results = feed.run(st.running_counts(feed.words(), "word"), "complete")
    assert feed.by_batch(results) == {0: {"a": 2, "b": 1}, 1: {"a": 2, "b": 2, "c": 1}}
    assert dict(rows(st.last_batch(results))) == {"a": 2, "b": 2, "c": 1}


def test_changed_counts_give_keys_of_the_batch(feed):
    feed.put("a b a")
    feed.put("b c")
    results = feed.run(st.changed_counts(feed.words(), "word"), "update")
    assert feed.by_batch(results) == {0: {"a": 2, "b": 1}, 1: {"b": 2, "c": 1}}


def test_state_survives_restart(feed):
    feed.put("a b a")
    assert feed.by_batch(feed.run(st.running_counts(feed.words(), "word"), "complete")) == {0: {"a": 2, "b": 1}}
    feed.put("b c")
    results = feed.run(st.running_counts(feed.words(), "word"), "complete")
    assert feed.by_batch(results)[1] == {"a": 2, "b": 2, "c": 1}
    feed.run(st.running_counts(feed.words(), "word"), "complete")
    assert dict(rows(st.last_batch(results))) == {"a": 2, "b": 2, "c": 1}


def test_no_input_gives_no_rows(feed):
    results = feed.run(st.running_counts(feed.words(), "word"), "complete")
    assert results.count() == 0 and st.last_batch(results).count() == 0
    assert results.columns == ["word", "count", "batch_id"]


def test_custom_state(feed):
    feed.put("a b a a")
    feed.put("b c")
    ones = feed.words().withColumn("n", F.lit(1))
    largest = st.stateful(ones, "word", "n", lambda key, new, old: max(new, old or 0), "largest")
    assert feed.by_batch(feed.run(largest, "update"), "largest") == {0: {"a": 3, "b": 1}, 1: {"b": 1, "c": 1}}


def test_custom_state_keeps_keys_exact(feed):
    big = 2**53
    feed.put(f"{big + 1} x {big + 2}")
    feed.put(f"{big + 2} x")
    keys = feed.words().select(F.col("word").try_cast("bigint").alias("k"), F.lit(1).alias("n"))
    results = feed.run(st.stateful(keys, "k", "n", lambda key, new, old: new + (old or 0) + (key is None), "s"), "update")
    assert feed.by_batch(results, "s", "k") == {0: {big + 1: 1, big + 2: 1, None: 2}, 1: {big + 2: 2, None: 4}}


def test_custom_state_of_a_hot_key(feed):
    words = ["hot" if i % 3 == 0 else f"w{i % 50}" for i in range(3000)]
    feed.put(*words[:1500])
    feed.put(*words[1500:])
    ones = feed.words().withColumn("n", F.lit(1))
    results = feed.run(st.stateful(ones, "word", "n", lambda key, new, old: new + (old or 0)), "update")
    final = results.groupBy("word").agg(F.max_by("state", "batch_id").alias("n"))
    assert dict(rows(final)) == dict(Counter(words))


def test_seeded_counts(feed):
    feed.put("hello a")
    feed.put("a")
    seed = feed.spark.createDataFrame([("hello", 1), ("world", 1)], "word string, count int")
    st.seeded_counts(feed.words(), seed, "word", feed.out, feed.state)
    results = st.batch_results(feed.spark, feed.out, "word string, count long")
    assert feed.by_batch(results) == {0: {"hello": 2, "world": 1, "a": 1}, 1: {"hello": 2, "world": 1, "a": 2}}


def test_the_seed_is_read_once(feed):
    feed.put("a")
    seed = feed.spark.createDataFrame([("a", 5), (None, 2)], "word string, count long")
    st.seeded_counts(feed.words(), seed, "word", feed.out, feed.state)
    feed.put("a b")
    other = feed.spark.createDataFrame([("a", 700)], "word string, count long")
    st.seeded_counts(feed.words(), other, "word", feed.out, feed.state)
    results = st.batch_results(feed.spark, feed.out, "word string, count long")
    assert feed.by_batch(results) == {0: {"a": 6, None: 2}, 1: {"a": 7, None: 2, "b": 1}}


def test_per_batch_sql(feed):
    feed.put("a b a")
    feed.put("b")
    sql = "SELECT word, count(*) AS total FROM batch_words GROUP BY word"
    st.per_batch_sql(feed.words(), "batch_words", sql, feed.out, feed.state).awaitTermination()
    results = st.batch_results(feed.spark, feed.out, "word string, total long")
    assert feed.by_batch(results, "total") == {0: {"a": 2, "b": 1}, 1: {"b": 1}}


def test_blocklist_on_stream(feed):
    feed.put("17,3,1", "18,2,0")
    feed.put("17,9,9", "19,1,1")
    keyed = feed.lines().select(F.split("value", ",")[0].alias("k"), "value")
    listed = feed.spark.createDataFrame([("17", True)], "k string, flag boolean")
    kept = feed.run(blocklist(keyed, listed, "k", "flag"))
    assert rows(kept, "value") == [("18,2,0",), ("19,1,1",)]


@pytest.fixture
def timed(spark, tmp_path):
    """Stream of words with times, two files."""
    data = [
        [("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:03", "a"), ("2024-01-01 00:00:07", "b")],
        [("2024-01-01 00:00:12", "a"), ("2024-01-01 00:00:26", "b")],
    ]
    schema = "t string, word string"
    for i, part in enumerate(data):
        df = spark.createDataFrame(part, schema).selectExpr("CAST(t AS timestamp) AS ts", "word")
        df.coalesce(1).write.parquet(str(tmp_path / f"in{i}"))
    return stream_files(spark, f"{tmp_path}/in*", df.schema, files_per_batch=1), Feed(spark, tmp_path)


def seconds(df, *cols):
    picked = [F.date_format(c, "ss").alias(c) for c in cols]
    return rows(df.select(*picked, "word", "count"))


def test_sliding_counts_merged(timed):
    stream, feed = timed
    windows = st.sliding_counts(stream, "ts", "word", "20 seconds", "10 seconds")
    assert seconds(st.last_batch(feed.run(windows, "complete")), "start", "end") == [
        ("00", "20", "a", 3), ("00", "20", "b", 1), ("10", "30", "a", 1), ("10", "30", "b", 1),
        ("20", "40", "b", 1), ("50", "10", "a", 2), ("50", "10", "b", 1)]


def test_sliding_counts_concat_keeps_batches_apart(timed):
    stream, feed = timed
    windows = st.sliding_counts(stream, "ts", "word", "20 seconds", "10 seconds", mode="concat", batch="5 seconds")
    got = seconds(st.last_batch(feed.run(windows, "complete")), "start", "batch_start")
    assert got == [
        ("00", "00", "a", 2), ("00", "05", "b", 1), ("00", "10", "a", 1), ("10", "10", "a", 1),
        ("10", "25", "b", 1), ("20", "25", "b", 1), ("50", "00", "a", 2), ("50", "05", "b", 1)]


def test_sliding_counts_refuse(spark):
    with pytest.raises(ValueError):
        st.sliding_counts(spark.range(1), "ts", "id", "1 s", "1 s", mode="concat")


def test_watermark_lets_old_windows_go(timed):
    stream, feed = timed
    windows = st.sliding_counts(stream, "ts", "word", "10 seconds", "10 seconds", watermark="1 second")
    closed = feed.run(windows, "append")
    assert ("00", "10", "a", 2) in seconds(closed, "start", "end")


def test_offset_ranges(spark):
    log = spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("t", 2, 0)], "topic string, partition int, offset long")
    assert rows(st.offset_ranges(log)) == [("t", 0, 5, 7), ("t", 2, 0, 1)]


def test_once_per_batch(spark, tmp_path):
    seen = []
    run = st.once_per_batch(lambda batch, batch_id: seen.append(batch_id), str(tmp_path / "ledger"))
    for batch_id in (0, 0, 1, 0, 1, 2):
        run(spark.range(3), batch_id)
    assert seen == [0, 1, 2]
    failing = st.once_per_batch(lambda batch, batch_id: 1 / 0, str(tmp_path / "ledger"))
    failing(spark.range(3), 2)
    with pytest.raises(ZeroDivisionError):
        failing(spark.range(3), 3)
    run(spark.range(3), 3)
    assert seen == [0, 1, 2, 3]


def test_rate_cap_and_file_sink(feed):
    for i in range(3):
        feed.put(f"w{i}")
    query = st.append_files(feed.words(), feed.out, feed.state)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert rows(feed.spark.read.schema("word string").parquet(feed.out)) == [("w0",), ("w1",), ("w2",)]


def test_stop_when_idle(feed):
    feed.put("a")
    query = st.write_batches(feed.words(), feed.out, feed.state, interval="100 milliseconds")
    stopper = threading.Thread(target=st.stop_when_idle, args=(query, 1.0))
    stopper.start()
    deadline = time.monotonic() + 60
    while feed.files < 2 and time.monotonic() < deadline:
        feed.put("b")
    stopper.join(60)
    assert not query.isActive and query.exception() is None
    results = st.batch_results(feed.spark, feed.out, "word string")
    assert rows(results, "word") == [("a",), ("b",)]
