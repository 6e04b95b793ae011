"""Licences of files by header and directory."""

import pytest
from logweir.llm.licenses import TEMPLATES, Scanner, licences

from tests.llm.rows import clashing

PATHS = "doc_id long, path string, text string"
APACHE, MIT, GPL = TEMPLATES["Apache-2.0"], TEMPLATES["MIT"], TEMPLATES["GPL-3.0"]


def result(df, **options):
    return {r.doc_id: (r.licence, r.found, r.from_path) for r in licences(df, **options).collect()}


def test_headers_and_inheritance(spark):
    code = "def f(x):\n    return x + 1  # the value\n" * 20
    wrapped = "\n".join(f"# {x}" for x in ["Licensed under the Apache License, Version 2.0 (the \"License\");", "you may not use this file except in compliance with the License.", "You may obtain a copy of the License at", "http://www.apache.org/licenses/LICENSE-2.0"])
    rows = [
        (1, "LICENSE", MIT[1]),
        (2, "a/b/code.py", code),
        (3, "a/own.py", f"{wrapped}\n{code}"),
        (4, "a/x/COPYING.txt", f"Words before it.\n{GPL[0]}\n{code}"),
        (5, "a/x/y/z/deep.py", code),
        (6, "a/x/mit.py", f"// {MIT[0]}\n{code}"),
        (7, "c/notice.txt", APACHE[0]),
        (8, "c/d/e.py", code),
        (9, "top.py", ""),
        (10, None, None),
        (11, "c/spdx.py", f"# SPDX-License-Identifier: BSD-3-Clause\n{code}"),
        (12, "cc/e.py", code),
    ]
    assert result(spark.createDataFrame(rows, PATHS)) == {
        1: ("MIT", "header", None),
        2: ("MIT", "inherited", "LICENSE"),
        3: ("Apache-2.0", "header", None),
        4: ("GPL-3.0", "header", None),
        5: ("GPL-3.0", "inherited", "a/x/COPYING.txt"),
        6: ("MIT", "header", None),
        7: ("Apache-2.0", "header", None),
        8: ("Apache-2.0", "inherited", "c/notice.txt"),
        9: ("MIT", "inherited", "LICENSE"),
        10: ("MIT", "inherited", "LICENSE"),
        11: ("BSD-3-Clause", "header", None),
        12: ("MIT", "inherited", "LICENSE"),
    }


@pytest.mark.parametrize("name", TEMPLATES)
def test_every_notice_names_itself(name):
    scanner = Scanner({}, 100, 0.75)
    for text in TEMPLATES[name]:
        cosine, found = scanner.header(f"some words\n// {text}\nother words of this file")
        assert found == name and cosine > 0.9


def test_no_licence_odd_rows_and_ties(spark):
    rows = [(1, "d/x", "the licence to be silly is in the words of this long and winding line of nothing much"), (2, "d/y", None), (2, "d/y", None), (None, "d/z", ""), (3, "d/q", "licen " * 30_000)]
    df = clashing(spark.createDataFrame(rows, PATHS), "dir", "own", "depth", "g")
    assert {(r.licence, r.found) for r in licences(df).collect()} == {(None, "none")} and licences(df).count() == 5
    tie = [(1, "e/b.txt", MIT[0]), (2, "e/a.txt", MIT[0]), (3, "e/c", "x")]
    assert result(spark.createDataFrame(tie, PATHS))[3] == ("MIT", "inherited", "e/a.txt")
    assert result(df.limit(0)) == {}
