"""Employer text files: comma fields, trimmed, typed by a schema of BIGINT and STRING columns.

The data source splits a line only as far as the columns asked for, takes filters into its reader and writes in two
phases: tasks write files apart, and only those of tasks that the job counts are moved in place.
"""

from __future__ import annotations

import fnmatch
import io
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as ds
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, Filter, InputPartition, WriterCommitMessage
from pyspark.sql.types import LongType, StringType, StructField, StructType

from logweir.functions.codes import GENDER_LABELS, UNKNOWN_GENDER, gender_label
from logweir.functions.text import split_java

SPLIT_BYTES = 128 * 1024 * 1024
READ_BYTES = 1024 * 1024


def employer_schema(last: str = "com") -> StructType:
    """Default columns; the last one is ``com`` or, with gender labels, ``comm``."""
    names = {"id": LongType(), "name": StringType(), "gender": StringType(), "salary": LongType(), last: LongType()}
    return StructType([StructField(name, type_, False) for name, type_ in names.items()])


def check_types(schema: StructType) -> StructType:
    for field in schema:
        if not isinstance(field.dataType, (LongType, StringType)):
            raise ValueError(f"column {field.name} must be BIGINT or STRING")
    return schema


def read_employer_text(
    spark: SparkSession, path: str, schema: StructType | None = None, decode_gender: bool = False
) -> DataFrame:
    """Employer files through Spark's text scan.

    Fields beyond the schema are ignored; a short line or a bad number fails the job. Blank lines
    are skipped. ``decode_gender`` puts labels in a column named ``gender``.
    """
    schema = check_types(schema or employer_schema("comm" if decode_gender else "com"))
    fields = spark.read.text(path).filter("trim(value) <> ''").select(split_java(F.col("value"), ",").alias("f"))
    columns = []
    for i, field in enumerate(schema):
        col = F.trim(F.col("f")[i], F.lit(" \t\r"))
        if decode_gender and field.name.lower() == "gender":
            col = gender_label(col)
        columns.append(col.cast(field.dataType).alias(field.name))
    return fields.select(*columns)


class FileSplit(InputPartition):
    """Bytes ``start`` to ``end`` of a file; a line belongs to the split its first byte is in."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class EmployerText(DataSource):
    """``spark.read.format("employer_text")`` with options ``path``, ``decode_gender`` and ``layout``.

    ``layout`` is the schema of the files' fields as JSON, in order; the columns asked for, by schema, are taken from it by name.
    Without it the schema is the layout.
    """

    @classmethod
    def name(cls) -> str:
        return "employer_text"

    def _decodes(self) -> bool:
        return self.options.get("decode_gender", "false").lower() == "true"

    def _layout(self) -> StructType | None:
        return check_types(StructType.fromJson(json.loads(self.options["layout"]))) if "layout" in self.options else None

    def _path(self) -> str:
        if "path" not in self.options:
            raise ValueError("path is required")
        return self.options["path"]

    def schema(self) -> StructType:
        return self._layout() or employer_schema("comm" if self._decodes() else "com")

    def reader(self, schema: StructType) -> DataSourceReader:
        return EmployerReader(self._path(), check_types(schema), self._decodes(), self._layout())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if self._decodes():
            raise ValueError("labels cannot be written as codes")
        return EmployerWriter(self._path(), check_types(schema), overwrite)


Test = Callable[[pa.Array], pa.Array]

_COMPARE = {
    ds.EqualTo: pc.equal,
    ds.GreaterThan: pc.greater,
    ds.GreaterThanOrEqual: pc.greater_equal,
    ds.LessThan: pc.less,
    ds.LessThanOrEqual: pc.less_equal,
}
_TEXT = {ds.StringStartsWith: pc.starts_with, ds.StringEndsWith: pc.ends_with, ds.StringContains: pc.match_substring}


def filter_test(wanted: Filter, schema: StructType) -> tuple[str, Test] | None:
    """Column and test of a filter that the reader can decide, else None. Columns hold no NULL."""
    if isinstance(wanted, ds.Not):
        inner = filter_test(wanted.child, schema)
        return inner and (inner[0], lambda col: pc.invert(inner[1](col)))
    path = getattr(wanted, "attribute", ())
    if len(path) != 1 or path[0] not in schema.names:
        return None
    name, kind = path[0], type(wanted)
    if kind in (ds.IsNotNull, ds.IsNull):
        return name, lambda col: pc.is_valid(col) if kind is ds.IsNotNull else pc.is_null(col)
    number = isinstance(schema[name].dataType, LongType)
    fits = lambda x: isinstance(x, int if number else str) and not isinstance(x, bool)
    if kind is ds.In and all(map(fits, wanted.value)):
        values = pa.array(wanted.value, pa.int64() if number else pa.string())
        return name, lambda col: pc.is_in(col, values)
    if kind in _COMPARE and fits(wanted.value):
        return name, lambda col: _COMPARE[kind](col, wanted.value)
    if kind in _TEXT and not number:
        return name, lambda col: _TEXT[kind](col, wanted.value)
    return None


def split_fields(lines: pa.Array, positions: Sequence[int]) -> list[pa.Array]:
    """The fields at ascending ``positions``, trimmed; fields behind the last one are not looked at.

    Trailing empty fields don't count; a line without one of the fields is an error.
    """
    wanted = set(positions)
    if not wanted:
        return []
    parts = (f"(?P<f{i}>[^,]*)" if i in wanted else "[^,]*" for i in range(max(wanted) + 1))
    found = pc.extract_regex(pc.utf8_rtrim(lines, ","), "^" + ",".join(parts) + "(?:,|$)")
    if found.null_count:
        raise ValueError(f"a line has fewer than {max(wanted) + 1} fields")
    return [pc.utf8_trim(pc.struct_field(found, f"f{i}"), " \t\r") for i in positions]


class EmployerReader(DataSourceReader):
    """Reads the fields that filters need from every line and the other columns' only from the lines that are kept.

    So a bad number in a line that a filter leaves out does not fail the job unless the filter is on that column.
    """

    def __init__(self, path: str, schema: StructType, decode_gender: bool, layout: StructType | None = None):
        self.path, self.schema, self.decode_gender = path, schema, decode_gender
        self.layout = layout or schema
        unknown = set(schema.names) - set(self.layout.names)
        if unknown:
            raise ValueError(f"the layout lacks {sorted(unknown)}")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for wanted in filters:
            if filter_test(wanted, self.schema):
                self.filters.append(wanted)
            else:
                yield wanted

    def partitions(self) -> list[InputPartition]:
        splits = []
        for path, size in matching_files(self.path):
            for start in range(0, size, SPLIT_BYTES):
                splits.append(FileSplit(path, start, min(start + SPLIT_BYTES, size)))
        return splits

    def read(self, partition: FileSplit) -> Iterator[pa.RecordBatch]:
        for lines in line_blocks(partition):
            if len(lines):
                yield self._batch(lines)

    def _columns(self, lines: pa.Array, names: Sequence[str]) -> dict[str, pa.Array]:
        """Typed columns of the lines."""
        names = sorted(names, key=self.layout.names.index)
        fields = split_fields(lines, [self.layout.names.index(name) for name in names])
        return {name: self._typed(name, col) for name, col in zip(names, fields)}

    def _typed(self, name: str, col: pa.Array) -> pa.Array:
        if self.decode_gender and name.lower() == "gender":
            for code, label in GENDER_LABELS.items():
                col = pc.if_else(pc.equal(col, code), label, col)
            known = pc.is_in(col, pa.array(list(GENDER_LABELS.values())))
            col = pc.if_else(known, col, UNKNOWN_GENDER)
        return col.cast(_arrow(self.schema[name]))

    def _batch(self, lines: pa.Array) -> pa.RecordBatch:
        tests = [filter_test(wanted, self.schema) for wanted in self.filters]
        held = self._columns(lines, {name for name, _ in tests})
        if tests:
            keep = None
            for name, test in tests:
                passed = test(held[name])
                keep = passed if keep is None else pc.and_(keep, passed)
            lines = lines.filter(keep)
            held = {name: col.filter(keep) for name, col in held.items()}
        held |= self._columns(lines, set(self.schema.names) - set(held))
        arrow_schema = pa.schema([(f.name, _arrow(f)) for f in self.schema])
        if not arrow_schema.names:
            return pa.RecordBatch.from_struct_array(pa.array([{}] * len(lines), pa.struct([])))
        return pa.RecordBatch.from_arrays([held[name] for name in arrow_schema.names], schema=arrow_schema)


def _arrow(field: StructField) -> pa.DataType:
    return pa.int64() if isinstance(field.dataType, LongType) else pa.string()


@dataclass
class WrittenFile(WriterCommitMessage):
    """A task's file in the job's folder, None if the task had no rows."""

    name: str | None


class EmployerWriter(DataSourceArrowWriter):
    """Writes lines in two phases.

    Each task attempt writes a file of its own into a folder of the job that readers pass over. ``commit`` moves the
    files of the attempts that count in place, ``abort`` leaves nothing behind. An overwrite removes the files that
    were there before only after the new ones are in place.
    """

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path.rstrip("/"), schema, overwrite
        self.job = uuid.uuid4().hex
        # Made here on the driver only: a task that outlives an abort finds no folder to write to.
        filesystem, _, apart = self._folder()
        filesystem.create_dir(apart, recursive=True)

    def _folder(self) -> tuple[fs.FileSystem, str, str]:
        """File system, target folder and the job's own folder."""
        filesystem, inner = locate(self.path)
        return filesystem, inner, f"{inner}/_job-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        filesystem, _, apart = self._folder()
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.txt"
        out = None
        try:
            for batch in iterator:
                if not len(batch):
                    continue
                if out is None:
                    out = filesystem.open_output_stream(f"{apart}/{name}")
                out.write(self._lines(batch))
        except BaseException:
            if out is not None:
                out.close()
            if filesystem.get_file_info(f"{apart}/{name}").is_file:
                filesystem.delete_file(f"{apart}/{name}")
            raise
        if out is not None:
            out.close()
        return WrittenFile(name if out is not None else None)

    def _lines(self, batch: pa.RecordBatch) -> bytes:
        cells = [col.cast(pa.string()) for col in batch.columns]
        for name, col in zip(batch.schema.names, cells):
            if col.null_count or pc.any(pc.match_substring_regex(col, "[,\n\r]|^[ \t]|[ \t]$")).as_py():
                raise ValueError(f"column {name} has a value that a line cannot hold")
        # A line ends with a comma if its last field is empty, which would not count; all else reads back as it was.
        if pc.any(pc.equal(cells[-1], "")).as_py():
            raise ValueError(f"column {batch.schema.names[-1]} is empty, which a line cannot hold at its end")
        lines = pc.binary_join_element_wise(*cells, ",")
        return "".join(f"{line}\n" for line in lines.to_pylist()).encode()

    def commit(self, messages: list[WrittenFile | None]) -> None:
        filesystem, target, apart = self._folder()
        filesystem.create_dir(target, recursive=True)
        before = [path for path, _ in matching_files(target)] if self.overwrite else []
        for message in messages:
            if message is not None and message.name is not None:
                filesystem.move(f"{apart}/{message.name}", f"{target}/{self.job}-{message.name}")
        for path in before:
            filesystem.delete_file(path)
        self._clear(filesystem, apart)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        filesystem, _, apart = self._folder()
        self._clear(filesystem, apart)

    def _clear(self, filesystem: fs.FileSystem, apart: str) -> None:
        if filesystem.get_file_info(apart).type == fs.FileType.Directory:
            filesystem.delete_dir(apart)


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path; a path without a scheme is a local or mounted one."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def matching_files(path: str) -> list[tuple[str, int]]:
    """Files of a path, folder or glob on any file system Arrow knows, with their sizes; each part may be a glob."""
    filesystem, inner = locate(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    parts = inner.split("/")
    fixed = next((i for i, part in enumerate(parts) if set(part) & set("*?[")), len(parts))
    top, pattern = "/".join(parts[:fixed]) or "/", parts[fixed:]
    info = filesystem.get_file_info(top)
    if info.is_file:
        found = [] if pattern else [info]
    else:
        found = filesystem.get_file_info(fs.FileSelector(top, recursive=len(pattern) > 1))
        depth = len([p for p in parts[:fixed] if p])
        names = lambda f: [p for p in f.path.split("/") if p][depth:]
        pattern = pattern or ["*"]
        found = [f for f in found if len(names(f)) == len(pattern) and all(map(fnmatch.fnmatch, names(f), pattern))]
        folders = [f for f in found if not f.is_file] if parts[fixed:] else []
        for folder in folders:
            found += filesystem.get_file_info(fs.FileSelector(folder.path))
    keep = [f for f in found if f.is_file and not f.base_name.startswith(("_", "."))]
    return sorted((prefix + f.path, f.size) for f in keep)


def numbered_lines(split: FileSplit) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Blocks of the lines that start inside a split, with the positions of their first bytes."""
    filesystem, inner = locate(split.path)
    with io.BufferedReader(filesystem.open_input_file(inner), READ_BYTES) as source:
        at = split.start
        if at > 0:
            # Step back one byte: a line that starts right at the split is then not skipped.
            source.seek(at - 1)
            at += len(source.readline()) - 1
        while at < split.end:
            block = source.read(min(READ_BYTES, split.end - at))
            if not block:
                return
            if not block.endswith(b"\n"):
                block += source.readline()
            raw = pa.array(block.removesuffix(b"\n").split(b"\n"), pa.binary())
            ends = pc.cumulative_sum(pc.add(pc.binary_length(raw).cast(pa.int64()), 1))
            yield pc.add(pa.concat_arrays([pa.array([0], pa.int64()), ends[:-1]]), at), raw.cast(pa.string())
            at += len(block)


def line_blocks(split: FileSplit) -> Iterator[pa.Array]:
    """Blocks of the lines that start inside a split, blank ones left out."""
    for _, lines in numbered_lines(split):
        yield lines.filter(pc.not_equal(pc.utf8_trim_whitespace(lines), ""))


def employer_source(spark: SparkSession) -> None:
    """Register the source under the name ``employer_text``, and let filters reach its reader."""
    spark.dataSource.register(EmployerText)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_employer_source(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    layout: StructType | None = None,
    decode_gender: bool = False,
) -> DataFrame:
    """The ``columns`` of employer files through the data source; filters on the result reach its reader."""
    employer_source(spark)
    layout = check_types(layout or employer_schema("comm" if decode_gender else "com"))
    asked = StructType([layout[name] for name in (columns if columns is not None else layout.names)])
    options = {"layout": layout.json(), "decode_gender": str(decode_gender).lower()}
    return spark.read.format("employer_text").options(**options).schema(asked).load(path)


def write_employer_text(df: DataFrame, path: str, mode: str = "append") -> None:
    """Rows of BIGINT and STRING columns as comma lines in ``path``; ``mode`` is ``append`` or ``overwrite``.

    A NULL, and text with a comma, a line break or blanks at an end, fail the job and leave the folder as it was.
    """
    employer_source(df.sparkSession)
    df.write.format("employer_text").mode(mode).save(path)
