"""String functions, all plain column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

WHITESPACE = r"\s+"
_LITERAL = re.compile(r"[^.^$*+?()\[\]{}|\\]")  # one character with no meaning in a regex


def split_java(col: Column, sep: str) -> Column:
    """Split on the regex ``sep`` and drop trailing empty fields, as ``String.split`` does.

    The empty string gives one empty field; a string of separators only gives none.
    """
    if sep == WHITESPACE:
        ends = " \t\n\x0b\f\r"
    elif _LITERAL.fullmatch(sep):
        ends = sep
    else:
        return _trimmed_split(col, F.regexp_replace(col, f"(?:{sep})++$", ""), sep)
    # Trimming reads the whole text, so only the few texts that end in a separator get it.
    ended = reduce(Column.__or__, (F.endswith(col, F.lit(char)) for char in ends))
    return F.when(~ended, F.split(col, sep)).otherwise(_trimmed_split(col, F.rtrim(col, F.lit(ends)), sep))


def _trimmed_split(col: Column, core: Column, sep: str) -> Column:
    return (
        F.when(col == "", F.array(F.lit("")))
        .when(core == "", F.array().cast("array<string>"))
        .otherwise(F.split(core, sep))
    )


def item_count(col: Column, sep: str = ",") -> Column:
    """Number of separated items, trailing empty items not counted; NULL stays NULL."""
    return F.when(col.isNotNull(), F.size(split_java(col, sep)))


def url_host(url: Column) -> Column:
    """Host part of a URL, NULL when the text is not a URL."""
    return F.nullif(F.regexp_extract(url, "^[a-zA-Z]+://([^/?#]+)", 1), F.lit(""))


def resource_path(url: Column, domain: Column, mode: str = "spec") -> Column:
    """File part of ``url`` after ``//domain/``; NULL when the URL is on another domain.

    ``spec`` gives ``/a/b.html`` without query and fragment; ``code`` gives the bare remainder,
    query included, up to the next ``//domain/``. The domain is matched literally.
    """
    if mode not in ("spec", "code"):
        raise ValueError(f"unknown mode {mode!r}")
    marker = F.concat(F.lit("//"), domain, F.lit("/"))
    at = F.call_function("instr", url, marker)
    rest = F.call_function("substring", url, at + F.length(marker))
    if mode == "code":
        cut = F.nullif(F.call_function("substring_index", rest, marker, F.lit(1)), F.lit(""))
    else:
        cut = F.concat(F.lit("/"), F.substring_index(F.substring_index(rest, "?", 1), "#", 1))
    return F.when(F.contains(url, marker), cut)
