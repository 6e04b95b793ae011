from logweir.sources.avro import read_avro
from logweir.sources.employer_text import employer_source, read_employer_source, read_employer_text, write_employer_text
from logweir.sources.files import (
    list_files,
    load_ctrl_a,
    parse_access_log,
    read_delimited,
    read_json_strings,
    read_lines,
    read_merged,
    sql_on_path,
)
from logweir.sources.generated import generate_words, in_memory, records
from logweir.sources.growing_text import committed_offset, stream_growing
from logweir.sources.jdbc import read_external, read_jdbc, read_jdbc_query
from logweir.sources.streams import stream_files, stream_lines, stream_log

__all__ = [
    "committed_offset",
    "employer_source",
    "generate_words",
    "in_memory",
    "list_files",
    "load_ctrl_a",
    "parse_access_log",
    "read_avro",
    "read_delimited",
    "read_employer_source",
    "read_employer_text",
    "read_external",
    "read_jdbc",
    "read_jdbc_query",
    "read_json_strings",
    "read_lines",
    "read_merged",
    "records",
    "sql_on_path",
    "stream_files",
    "stream_growing",
    "stream_lines",
    "stream_log",
    "write_employer_text",
]
