"""A stream of the lines that are added to growing text files.

The offset of a stream is the number of bytes of each file, up to its last line break, that batches have taken. A
batch is the bytes between two offsets, in splits of the size the scan has; a line belongs to the split that its
first byte is in, so a batch that is run again after a crash gives the same lines. The offset of a done batch can be
written to a folder that other programs watch; Spark tells the source of it when the next batch comes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from logweir.sources import employer_text
from logweir.sources.employer_text import FileSplit, locate, matching_files, numbered_lines

TAIL_BYTES = 64 * 1024


class GrowingText(DataSource):
    """``spark.readStream.format("growing_text")`` with options ``path`` and ``committed``.

    ``path`` is a file, folder or glob. Columns are ``path``, ``position`` (of the line's first byte) and ``value``. New
    files join at any time. Only whole lines are read: what follows the last line break waits for the next one. A file
    that got shorter fails the stream, one that is gone is forgotten. ``committed`` is a folder for the last done offset.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_text"

    def schema(self) -> str:
        return "path string, position long, value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if "path" not in self.options:
            raise ValueError("path is required")
        return GrowingReader(self.options["path"], self.options.get("committed"))


def whole_bytes(path: str, size: int) -> int:
    """Bytes of a file up to and with its last line break, of the first ``size``."""
    filesystem, inner = locate(path)
    with filesystem.open_input_file(inner) as source:
        end = size
        while end > 0:
            start = max(0, end - TAIL_BYTES)
            source.seek(start)
            at = source.read(end - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


class GrowingReader(DataSourceStreamReader):
    def __init__(self, path: str, committed: str | None = None):
        self.path, self.committed = path, committed
        self.seen: dict[str, tuple[int, int]] = {}  # size and whole bytes of each file when last looked at

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        now = {}
        for path, size in matching_files(self.path):
            seen = self.seen.get(path)
            now[path] = seen if seen and seen[0] == size else (size, whole_bytes(path, size))
        self.seen = now
        return {path: whole for path, (_, whole) in now.items() if whole}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        splits = []
        for path, last in sorted(end.items()):
            first = start.get(path, 0)
            if last < first:
                raise ValueError(f"{path} had {first} bytes and has {last} now")
            step = employer_text.SPLIT_BYTES
            splits += [FileSplit(path, at, min(at + step, last)) for at in range(first, last, step)]
        return splits

    def read(self, partition: FileSplit) -> Iterator[pa.RecordBatch]:
        for positions, lines in numbered_lines(partition):
            if len(lines):
                path = pa.array([partition.path] * len(lines), pa.string())
                yield pa.RecordBatch.from_arrays([path, positions, lines], ["path", "position", "value"])

    def commit(self, end: dict) -> None:
        if self.committed is None:
            return
        filesystem, inner = locate(self.committed)
        filesystem.create_dir(inner, recursive=True)
        with filesystem.open_output_stream(f"{inner}/offset.new") as out:
            out.write(json.dumps(end, sort_keys=True).encode())
        filesystem.move(f"{inner}/offset.new", f"{inner}/offset.json")


def committed_offset(folder: str) -> dict[str, int]:
    """Bytes of each file whose lines are done, as the last ``commit`` wrote them; empty before the first."""
    filesystem, inner = locate(folder)
    if not filesystem.get_file_info(f"{inner}/offset.json").is_file:
        return {}
    with filesystem.open_input_file(f"{inner}/offset.json") as source:
        return json.loads(source.read())


def stream_growing(spark: SparkSession, path: str, committed: str | None = None) -> DataFrame:
    """Stream of the lines added to the files of ``path``: ``path, position, value``."""
    spark.dataSource.register(GrowingText)
    reader = spark.readStream.format("growing_text")
    return (reader.option("committed", committed) if committed else reader).load(path)
