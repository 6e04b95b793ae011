"""Licences of files: TF-IDF cosine of headers and licence files to templates, then the nearest licensed directory.

A term's weight is its count times its inverse document frequency over all files; frequencies are counted for the
templates' terms only, any other term weighs as one that no file has. Candidates are stretches of ``STRETCHES``
consecutive lines that begin or end at a line with a licence word, and the whole file; each is compared with every
template, and the best cosine of at least ``least`` names the licence. A file that as a whole is like a template, or
one that is named like a licence file, licenses its directory. Files without a licence of their own take that of the
nearest ancestor directory which has one: directories are few, so the ancestors of the distinct ones are joined.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from logweir.llm.scan import Rolling, flat, lower, slices
from logweir.llm.tables import cut

# Notices by SPDX identifier, as their publishers word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This library is free software: licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under the CC0 1.0 Universal license."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Unlicense."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
}
LICENCE_WORD = r"(?i)licen[cs]|spdx|permission|redistribut|public domain"
STRETCHES = (1, 2, 4, 8)
_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying)([.-][^/]*)?$"
_TERM = re.compile(r"[a-z]+|\d+")


def terms(text: str) -> Counter:
    return Counter(_TERM.findall(text.lower()))


def templates() -> list[tuple[str, Counter]]:
    """(identifier, terms) of the notices and of the SPDX tag of each identifier."""
    tags = [(name, [f"SPDX-License-Identifier: {name}"]) for name in TEMPLATES]
    return [(name, terms(text)) for name, texts in [*TEMPLATES.items(), *tags] for text in texts]


class Scanner:
    """Best template by cosine, with weights from document frequencies."""

    def __init__(self, frequency: dict[str, int], n_files: int, least: float):
        self.least = least
        self.weight = {t: log((n_files + 1) / (k + 1)) + 1 for t, k in frequency.items()}
        self.rare = log(n_files + 1) + 1
        self.templates = [(name, t, self.norm(t)) for name, t in templates()]

    def norm(self, t: Counter) -> float:
        return sqrt(sum((n * self.weight.get(term, self.rare)) ** 2 for term, n in t.items()))

    def best(self, text: str) -> tuple[float, str | None]:
        """(cosine, identifier) of the best template, equal cosines by order of the templates."""
        mine = terms(text)
        size = self.norm(mine)
        best = (0.0, None)
        for name, other, norm in self.templates:
            few, many = (mine, other) if len(mine) < len(other) else (other, mine)
            dot = sum(n * many[t] * self.weight.get(t, self.rare) ** 2 for t, n in few.items() if t in many)
            if dot and dot / (size * norm) > best[0] + 1e-9:
                best = (dot / (size * norm), name)
        return best

    def header(self, text: str) -> tuple[float, str | None]:
        """Best stretch of lines."""
        lines = re.split(r"\r\n|\r|\n", text)
        best: tuple[float, str | None] = (0.0, None)
        seen = set()
        for i, line in enumerate(lines):
            if re.search(LICENCE_WORD, line):
                for n in STRETCHES:
                    for a in {i, max(0, i - n + 1)}:
                        if (a, n) not in seen:
                            seen.add((a, n))
                            found = self.best("\n".join(lines[a : a + n]))
                            best = found if found[0] > best[0] + 1e-9 else best
        return best


_KIND = np.zeros(256, np.int8)
_KIND[97:123], _KIND[48:58] = 1, 2


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every term of the texts."""
    raw, offsets = flat(texts, " ")
    raw = lower(raw)
    kind = _KIND[raw]
    edge = np.flatnonzero(np.diff(kind, prepend=np.int8(0)))  # where runs of one kind begin
    first = edge[kind[edge] > 0]
    after = np.append(edge, len(raw))[np.searchsorted(edge, first) + 1]
    return np.searchsorted(offsets, first, "right") - 1, Rolling(raw).hash(first, after)


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: list[str]) -> Iterator[pa.RecordBatch]:
    """Number of files with each of the terms, a row for each term and task."""
    _, known = term_hashes(pa.array(vocabulary))
    order = np.argsort(known)
    counts = np.zeros(len(vocabulary), np.int64)
    for whole in batches:
        for batch in slices(whole, "text"):
            row, hashed = term_hashes(batch.column("text"))
            at = np.minimum(np.searchsorted(known[order], hashed), len(known) - 1)
            hit = known[order][at] == hashed
            pairs = np.unique(row[hit] * len(known) + order[at[hit]])
            counts += np.bincount(pairs % len(known), minlength=len(known))
    yield pa.RecordBatch.from_arrays([pa.array(vocabulary), pa.array(counts)], ["term", "n"])


def _scan(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = pc.fill_null(batch.column("text"), "")
            maybe = pc.match_substring_regex(texts, LICENCE_WORD)
            n = len(batch)
            name, cosine, file_name, file_cosine = [None] * n, [0.0] * n, [None] * n, [0.0] * n
            for i in np.flatnonzero(maybe.to_numpy(zero_copy_only=False)):
                text = texts[int(i)].as_py()
                cosine[i], found = scanner.header(text)
                name[i] = found if cosine[i] >= scanner.least else None
                file_cosine[i], found = scanner.best(text)
                file_name[i] = found if file_cosine[i] >= scanner.least else None
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("path"), pa.array(name, pa.string()), pa.array(cosine, pa.float64()), pa.array(file_name, pa.string()), pa.array(file_cosine, pa.float64())],
                ["doc_id", "path", "own", "cosine", "whole", "whole_cosine"],
            )


def licences(files: DataFrame, least: float = 0.75) -> DataFrame:
    """Per file ``doc_id, path, licence, found, cosine, from_path``; ``found`` is header, inherited or none.

    ``files (doc_id, path, text)``; directories are the parts of the path before each ``/``, the top one is empty. Of
    several licence files of a directory the highest cosine counts, then the first path. A file's own licence goes
    before an inherited one; a licence file doesn't need to inherit. A null or empty text has no licence of its own;
    a null path is the top directory's. Repeated rows give a row each, other columns aren't read, an empty table
    gives no rows.
    """
    rows = files.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("text").cast("string").alias("text")
    )
    vocabulary = sorted({t for _, other in templates() for t in other})
    counted = rows.select("text").mapInArrow(lambda batches: _frequencies(batches, vocabulary), "term string, n long")
    frequency = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    scanner = Scanner(frequency, rows.count(), least)
    scanned = cut(
        rows.mapInArrow(lambda batches: _scan(batches, scanner), "doc_id long, path string, own string, cosine double, whole string, whole_cosine double")
        .withColumn("dir", F.regexp_replace("path", r"/?[^/]*$", "")),
        "licences",
    )
    named = F.col("path").rlike(_FILE)
    licence = F.coalesce("whole", F.when(named, F.col("own")))
    givers = scanned.where(licence.isNotNull()).withColumn("how", F.struct("whole_cosine", "cosine"))
    top = givers.groupBy("dir").agg(F.max("how").alias("top"))
    best = givers.join(top, "dir").where("how = top")
    best = best.groupBy("dir").agg(F.min(F.struct(F.col("path").alias("from_path"), licence.alias("licence"))).alias("g"))
    dirs = scanned.select("dir").distinct()
    parts = F.split("dir", "/")
    ancestors = dirs.withColumn("depth", F.explode(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))))
    ancestors = ancestors.withColumn("up", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    near = ancestors.join(best.select(F.col("dir").alias("up"), "g"), "up").groupBy("dir").agg(F.max(F.struct("depth", "g")).alias("n"))
    placed = scanned.join(near.select("dir", F.col("n.g").alias("g")), "dir", "left")
    own = F.col("own").isNotNull()
    return placed.select(
        "doc_id",
        "path",
        F.coalesce("own", "g.licence").alias("licence"),
        F.when(own, "header").when(F.col("g").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(own, F.round("cosine", 6)).alias("cosine"),
        F.when(~own, F.col("g.from_path")).alias("from_path"),
    )
