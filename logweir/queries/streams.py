"""Streaming operators run over the events table until its input is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from logweir.operators import blocklist, explode_tokens
from logweir.plans import employees
from logweir.queries.derived import cents, employee_lines
from logweir.queries.registry import Tables, query
from logweir.queries.relational import _BUSY_USERS, _busy_users
from logweir.session import materialise
from logweir.sources import committed_offset, stream_files, stream_growing
from logweir.sources.employer_text import locate, matching_files
from logweir.streaming import (
    append_files,
    batch_counts,
    batch_results,
    chained_windows,
    changed_counts,
    idle_totals,
    last_batch,
    offset_ranges,
    open_totals,
    per_batch_sql,
    rocksdb,
    run_available,
    running_counts,
    seeded_counts,
    sliding_counts,
    stateful,
)

_COUNT_SCHEMA = "event_type string, count long"


PARTS = 3


def _arriving(t: Tables, start: Callable[[DataFrame], object]) -> None:
    """The events come in ``PARTS`` parts by id; ``start`` runs the stream on what is new, a batch for each part."""
    source = t.scratch("arriving")
    for part in range(PARTS):
        t.events.where(F.col("event_id") % PARTS == part).write.mode("append").parquet(source)
        start(stream_files(t.spark, source, t.events.schema))


def _results(t: Tables, build: Callable[[DataFrame], DataFrame], mode: str, schema: str, fn=None) -> DataFrame:
    """Every batch of a stream built from the arriving events, with its number."""
    out, state = t.scratch("stream"), t.scratch("stream-state")
    _arriving(t, lambda events: run_available(build(events), out, state, mode, fn))
    return batch_results(t.spark, out, schema)


@query("SELECT event_type, count(*) AS count, event_id % 3 AS batch_id FROM events GROUP BY ALL")
def stream_batch_count(t: Tables) -> DataFrame:
    out, state = t.scratch("stream"), t.scratch("stream-state")
    _arriving(t, lambda events: batch_counts(events, "event_type", out, state).awaitTermination())
    return batch_results(t.spark, out, _COUNT_SCHEMA)


@query("SELECT 4::BIGINT AS batches, max(n) AS events_of_largest FROM (SELECT event_id % 4, count(*) AS n FROM events GROUP BY 1)")
def stream_rate_cap(t: Tables) -> DataFrame:
    """One file of four in each batch, however many wait."""
    source, out = t.scratch("waiting"), t.scratch("stream")
    t.events.select("event_id", (F.col("event_id") % 4).alias("part")).repartition("part").write.partitionBy("part").parquet(source)
    waiting = stream_files(t.spark, f"{source}/*", t.events.select("event_id").schema, files_per_batch=1)
    run_available(waiting, out, t.scratch("stream-state"), fn=lambda batch, _: batch.agg(F.count("*").alias("n")))
    sizes = batch_results(t.spark, out, "n long")
    return sizes.agg(F.countDistinct("batch_id").alias("batches"), F.max("n").alias("events_of_largest"))


@query(
    """
    SELECT word, count(*) AS count, batch_id FROM (
      SELECT event_type AS word, event_id % 3 AS batch_id FROM events
      UNION ALL SELECT 'user' || user_id, event_id % 3 FROM events) GROUP BY ALL
    """
)
def stream_log_words(t: Tables) -> DataFrame:
    out, state = t.scratch("stream"), t.scratch("stream-state")

    def count(events: DataFrame) -> None:
        log = events.select(F.concat_ws(",", "event_type", F.concat(F.lit("user"), "user_id")).alias("value"))
        batch_counts(explode_tokens(log, "value", ","), "word", out, state).awaitTermination()

    _arriving(t, count)
    return batch_results(t.spark, out, "word string, count long")


@query("SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def stream_running_count(t: Tables) -> DataFrame:
    counts = _results(t, lambda events: running_counts(events, "user_id"), "complete", "user_id long, count long")
    return last_batch(counts)


@query("SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def stream_state_update(t: Tables) -> DataFrame:
    changed = _results(t, lambda events: changed_counts(events, "user_id"), "update", "user_id long, count long")
    return changed.groupBy("user_id").agg(F.max_by("count", "batch_id").alias("count"))


@query(
    """
    SELECT CASE WHEN user_id % 7 <> 0 THEN 9007199254740992 + user_id END AS k,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1
    """
)
def stream_custom_state(t: Tables) -> DataFrame:
    """State by keys beyond the whole numbers a DOUBLE holds, with NULL among them."""

    def totals(events: DataFrame) -> DataFrame:
        key = F.when(F.col("user_id") % 7 != 0, F.lit(2**53) + F.col("user_id")).alias("k")
        amounts = events.select(key, F.round(F.col("value") * 100).cast("bigint").alias("cents"))
        return stateful(amounts, "k", "cents", lambda key, new, old: (old or 0) + new, "total")

    states = _results(t, totals, "update", "k long, total long")
    return states.groupBy("k").agg(F.max_by("total", "batch_id").alias("total"))


@query("SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def stream_restart(t: Tables) -> DataFrame:
    """Two runs from one checkpoint, the second after new files have come."""
    source, out, state = t.scratch("arriving"), t.scratch("stream"), t.scratch("stream-state")
    early = F.col("event_type").isin("view", "click")
    for part in (early, ~early):
        t.events.filter(part).select("user_id").write.mode("append").parquet(source)
        changed = changed_counts(stream_files(t.spark, source, t.events.select("user_id").schema), "user_id")
        run_available(changed, out, state, "update")
    results = batch_results(t.spark, out, "user_id long, count long")
    return results.groupBy("user_id").agg(F.max_by("count", "batch_id").alias("count"))


_HOURS = "strftime({}, '%Y-%m-%d %H:%M')"
_SLIDES = "SELECT unnest([0, 1]) AS s"


def _as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd HH:mm") for name in names})


@query(
    f"""
    SELECT {_HOURS.format("w")} AS start, {_HOURS.format("w + INTERVAL 4 HOUR")} AS end, event_type,
           count(*) AS count
    FROM (SELECT event_type, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL (2 * s) HOUR AS w
          FROM events, ({_SLIDES}))
    GROUP BY w, event_type
    """
)
def stream_sliding_count(t: Tables) -> DataFrame:
    build = lambda events: sliding_counts(events, "ts", "event_type", "4 hours", "2 hours")
    schema = "start timestamp, end timestamp, event_type string, count long"
    windows = _results(t, build, "update", schema).groupBy("start", "end", "event_type")
    return _as_text(windows.agg(F.max_by("count", "batch_id").alias("count")), "start", "end")


@query(
    f"""
    SELECT {_HOURS.format("w")} AS start, {_HOURS.format("w + INTERVAL 4 HOUR")} AS end,
           {_HOURS.format("b")} AS batch_start, event_type, count
    FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, b, TIMESTAMP '1970-01-01') - INTERVAL (2 * s) HOUR AS w
          FROM (SELECT date_trunc('hour', ts) AS b, event_type, count(*) AS count FROM events GROUP BY ALL),
               ({_SLIDES}))
    """
)
def stream_window_concat(t: Tables) -> DataFrame:
    build = lambda events: sliding_counts(events, "ts", "event_type", "4 hours", "2 hours", mode="concat", batch="1 hour")
    schema = "start timestamp, end timestamp, batch_start timestamp, event_type string, count long"
    windows = _results(t, build, "update", schema).groupBy("start", "end", "batch_start", "event_type")
    return _as_text(windows.agg(F.max_by("count", "batch_id").alias("count")), "start", "end", "batch_start")


@query(
    """
    SELECT event_type, CAST(sum(n) AS BIGINT) AS count FROM (
      SELECT event_type, 1 AS n FROM events UNION ALL
      SELECT o_orderstatus, 1 FROM orders) GROUP BY event_type
    """
)
def stream_seeded_count(t: Tables) -> DataFrame:
    seed = t.orders.groupBy(F.col("o_orderstatus").alias("event_type")).count()
    out, state = t.scratch("stream"), t.scratch("stream-state")
    _arriving(t, lambda events: seeded_counts(events, seed, "event_type", out, state))
    return last_batch(batch_results(t.spark, out, _COUNT_SCHEMA))


@query("SELECT event_type, count(*) AS total, event_id % 3 AS batch_id FROM events GROUP BY ALL")
def stream_batch_sql(t: Tables) -> DataFrame:
    out, state = t.scratch("stream"), t.scratch("stream-state")
    sql = "SELECT event_type, count(*) AS total FROM event_words GROUP BY event_type"
    _arriving(t, lambda events: per_batch_sql(events, "event_words", sql, out, state).awaitTermination())
    return batch_results(t.spark, out, "event_type string, total long")


@query(f"SELECT event_id, user_id FROM events WHERE user_id NOT IN ({_BUSY_USERS})")
def stream_blocklist(t: Tables) -> DataFrame:
    # Worked out once, not again in every batch.
    busy = materialise(_busy_users(t), "busy")
    kept = lambda events: blocklist(events.select("event_id", "user_id"), busy, "user_id").select("event_id", "user_id")
    return _results(t, kept, "append", "event_id long, user_id long").drop("batch_id")


@query(
    """
    SELECT 'events' AS topic, CAST(event_id % 3 AS INTEGER) AS partition,
           min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
    FROM events GROUP BY 2
    """
)
def stream_offset_ranges(t: Tables) -> DataFrame:
    log = lambda events: events.select(
        F.lit("events").alias("topic"), (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    schema = "topic string, partition int, from_offset long, until_offset long"
    ranges = _results(t, log, "append", schema, lambda b, _: offset_ranges(b))
    return ranges.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")
    )


@query("SELECT event_id, event_type, value FROM events")
def stream_file_sink(t: Tables) -> DataFrame:
    out, state, columns = t.scratch("stream"), t.scratch("stream-state"), ["event_id", "event_type", "value"]
    _arriving(t, lambda events: append_files(events.select(*columns), out, state).awaitTermination())
    return t.spark.read.schema(t.events.select(*columns).schema).parquet(out)


def _grow(t: Tables, folder: str, lines: DataFrame, files: int) -> None:
    """Write ``lines (id, value)``, in order of id, as the files of ``folder``; a larger id only adds to its file."""
    made = t.scratch("grown")
    ordered = lines.select("id", "value", F.pmod(F.xxhash64("id"), F.lit(files)).alias("file"))
    ordered.repartition(files, "file").sortWithinPartitions("file", "id").drop("id").write.partitionBy("file").text(made)
    filesystem, inner = locate(folder)
    filesystem.create_dir(inner, recursive=True)
    for path, _ in matching_files(f"{made}/*/part-*"):
        _, own = locate(path)
        filesystem.move(own, f"{inner}/{own.split('/')[-2]}.log")


@query("SELECT event_id || ':' || event_type AS value, 1::BIGINT AS times FROM events")
def stream_growing_lines(t: Tables) -> DataFrame:
    """Lines added to four files between three runs; every run starts again at the checkpoint."""
    folder, out, state, done = (t.scratch(x) for x in ("growing", "stream", "stream-state", "committed"))
    lines = t.events.select(F.col("event_id").alias("id"), F.concat_ws(":", "event_id", "event_type").alias("value"))
    last = t.events.agg(F.max("event_id")).first()[0] or 0
    for part in range(1, PARTS + 1):
        _grow(t, folder, lines.where(F.col("id") <= last * part // PARTS), 4)
        run_available(stream_growing(t.spark, f"{folder}/*.log", done).select("value"), out, state)
    return batch_results(t.spark, out, "value string").groupBy("value").agg(F.count("*").alias("times"))


@query("SELECT true AS complete, 4::BIGINT AS files")
def stream_growing_committed(t: Tables) -> DataFrame:
    """When the second batch has come, the stream says that all of the first one's bytes are done."""
    folder, out, state, done = (t.scratch(x) for x in ("growing", "stream", "stream-state", "committed"))
    lines = t.events.select(F.col("event_id").alias("id"), F.concat_ws(":", "event_id", "event_type").alias("value"))
    last = t.events.agg(F.max("event_id")).first()[0] or 0
    _grow(t, folder, lines.where(F.col("id") <= last // 2), 4)
    sizes = materialise(t.spark.read.format("binaryFile").load(f"{folder}/*.log").select("path", "length"), "sizes")
    run_available(stream_growing(t.spark, f"{folder}/*.log", done).select("value"), out, state)
    _grow(t, folder, lines, 4)
    run_available(stream_growing(t.spark, f"{folder}/*.log", done).select("value"), out, state)
    rows = [(path, n) for path, n in committed_offset(done).items()]
    told = t.spark.createDataFrame(rows, "path string, told long")
    name = lambda c: F.regexp_extract(c, "([^/]+)$", 1)
    both = sizes.select(name("path").alias("file"), "length").join(told.select(name("path").alias("file"), "told"), "file", "full_outer")
    return both.agg(F.bool_and(F.coalesce(F.col("told") == F.col("length"), F.lit(False))).alias("complete"), F.count("*").alias("files"))


def _arriving_in_time(t: Tables, start: Callable[[DataFrame], object], behind: str | None = None) -> None:
    """The events come in ``PARTS`` parts by time, then, if asked for, one without type that is ``behind`` later than all."""
    source = t.scratch("arriving")
    first, last = t.events.agg(F.min("ts"), F.max("ts")).first()
    parts = [t.events.where((F.col("ts") >= first + k * (last - first) / PARTS) & ((F.col("ts") < first + (k + 1) * (last - first) / PARTS) | F.lit(k == PARTS - 1))) for k in range(PARTS)]
    if behind:
        end = F.lit(last) + F.expr(f"INTERVAL {behind}")
        parts.append(t.spark.range(1).select(*((end if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in t.events.schema)))
    for part in parts:
        part.write.mode("append").parquet(source)
        start(stream_files(t.spark, source, t.events.schema))


_IDLE_HOURS = 24


@query(
    f"""
    WITH timed AS (SELECT user_id, epoch_us(ts) // 1000 AS ms, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
    seeded AS (
      SELECT user_id, ms, cents, 1 AS n FROM timed
      UNION ALL SELECT user_id, min(ms) - {_IDLE_HOURS * 3_600_000 // 2}, 1000 + user_id, 2 FROM timed GROUP BY 1),
    marked AS (SELECT *, ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms) > {_IDLE_HOURS * 3_600_000} AS cut FROM seeded),
    spans AS (SELECT *, count(*) FILTER (WHERE cut) OVER (PARTITION BY user_id ORDER BY ms) AS span FROM marked)
    SELECT user_id, min(ms) AS first, max(ms) AS last, CAST(sum(cents) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS n,
           max(ms) + {_IDLE_HOURS * 3_600_000} < (SELECT max(ms) - 3600000 FROM timed) AS done
    FROM spans GROUP BY user_id, span
    """
)
def stream_idle_totals(t: Tables) -> DataFrame:
    """Each user starts from a seed; totals of users who fell silent were given out, the others are read from the state."""
    out, state, idle = t.scratch("stream"), t.scratch("stream-state"), _IDLE_HOURS * 3_600_000
    starts = t.events.groupBy("user_id").agg((F.unix_millis(F.min("ts").cast("timestamp")) - idle // 2).alias("first"))
    seed = starts.select("user_id", "first", F.col("first").alias("last"), (F.col("user_id") + 1000).alias("total"), F.lit(2).alias("n"))
    seed = materialise(seed, "seed")

    def run(events: DataFrame) -> None:
        timed = events.withColumn("cents", cents("value"))
        run_available(idle_totals(timed, "user_id", "ts", "cents", idle, "1 hour", seed), out, state)

    with rocksdb(t.spark):
        _arriving_in_time(t, run)
    columns = ["user_id", "first", "last", "total", "n"]
    done = batch_results(t.spark, out, "user_id long, first long, last long, total long, n long").select(*columns, F.lit(True).alias("done"))
    return done.unionByName(open_totals(t.spark, state, "user_id").select(*columns, F.lit(False).alias("done")))


@query(
    f"""
    SELECT {_HOURS.format("w")} AS start, {_HOURS.format("w + INTERVAL 4 HOUR")} AS end, event_type,
           count(*) AS count, 1::BIGINT AS times
    FROM (SELECT event_type, time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL (2 * s) HOUR AS w
          FROM events, ({_SLIDES}))
    GROUP BY w, event_type
    """
)
def stream_chained_windows(t: Tables) -> DataFrame:
    """Every window is given out in one batch, all of them once a late event has moved the watermark on."""
    out, state = t.scratch("stream"), t.scratch("stream-state")
    build = lambda events: chained_windows(events, "ts", "event_type", "1 hour", "4 hours", "2 hours", "1 hour")
    _arriving_in_time(t, lambda events: run_available(build(events), out, state), "2 days")
    results = batch_results(t.spark, out, "start timestamp, end timestamp, event_type string, count long")
    windows = results.groupBy("start", "end", "event_type").agg(F.max("count").alias("count"), F.count("*").alias("times"))
    return _as_text(windows, "start", "end")


def _employee_stream(t: Tables) -> tuple[str, str]:
    """Folders of the rows and of the counts of employee lines that come in ``PARTS`` parts."""
    source, out, state, counts = (t.scratch(x) for x in ("arriving", "stream", "stream-state", "counts"))
    for part in range(PARTS):
        employee_lines(t.events.where(F.col("event_id") % PARTS == part)).write.mode("append").text(source)
        lines = stream_files(t.spark, source, StructType.fromDDL("value string"), "text")
        employees.run_stream(lines, out, state, counts)
    return out, counts


@query("SELECT event_id % 3 AS batch_id, count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1")
def stream_emp_counts(t: Tables) -> DataFrame:
    return employees.batch_counts(t.spark, _employee_stream(t)[1])


@query(
    """
    SELECT CAST(event_id AS INTEGER) AS id, event_type AS name, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END::DOUBLE AS salary,
           CASE WHEN event_type = 'signup' THEN '19700101' ELSE strftime(ts, '%Y%m%d') END AS day
    FROM events WHERE event_type <> 'error'
    """
)
def stream_emp_rows(t: Tables) -> DataFrame:
    schema = "id int, name string, time long, salary double, hour string, day string"
    return t.spark.read.schema(schema).parquet(_employee_stream(t)[0]).select("id", "name", "salary", "day")
