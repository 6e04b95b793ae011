"""Near-duplicate lines by a deletion-neighbourhood join.

Lines are compared by words. Of any length, a line equal to an earlier one goes. The edit bound is one word put in, left
out or replaced, and holds for two lines of which the longer has ``min_words`` words or more: in a shorter one a word is
too large a part. Each distinct line of such a length emits hashed keys of itself with one word left out, once with and once without the place of that
word. Two lines that share such a key with its place differ by one replaced word there; a line whose whole equals
another's key has one word less. So the members of a bucket are all within the bound of its earliest, or of the one
whole line, and each is joined to that one only. The edit distance is then verified on the words.

The full neighbourhood has a key for every word of a text. Before it, a line emits one key for each third of its
words left out: lines within the bound agree outside the third with the edit. Only lines that share such a key with
another go on, and only the words of that third are left out one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logweir.llm.scan import U, Rolling, Words, mix, slices, unpack
from logweir.llm.tables import aside, cut, packed, put_back

BLOCKS = 3
PARTS = 2 * BLOCKS
SWAP, SHORTER, WHOLE, TEXT = 0, 1, 2, 3

_LINES = "doc_id long, line long, n long, h long, g long, keys array<long>"
_KEYS = "kind int, key long, doc_id long, line long, words string"


class Lines:
    """The lines (split at ``\\n``) of a column: row, number in its text, and its first and last word."""

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts, fold=False)
        breaks = np.flatnonzero(words.bytes == 10)
        # A word begins a line if a line break, or the start of its text, lies before it.
        seen = np.searchsorted(breaks, words.start)
        new = np.ones(len(seen), bool)
        new[1:] = (seen[1:] != seen[:-1]) | (words.row[1:] != words.row[:-1])
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(seen))[: len(self.first)]
        self.row = words.row[self.first]
        self.number = seen[self.first] - np.searchsorted(breaks, words.at[:-1])[self.row]
        self.n = self.last - self.first
        self.rolling = Rolling(words.hash)

    def skip(self, first: np.ndarray, begin: np.ndarray, end: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words of a line without those from ``begin`` to ``end``."""
        size = begin - first + last - end
        head, tail = self.rolling.raw(first, begin), self.rolling.raw(end, last)
        return mix(head + tail * self.rolling.up[begin - first] + size.astype(U) * U(0xD6E8FEB86659FD93))


def _scan(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Every line with a word, with two hashes of the whole and, if it can have neighbours, the keys of its thirds."""
    for whole in batches:
        for batch in slices(whole, "text"):
            lines = Lines(batch.column("text"))
            first, last, n = lines.first, lines.last, lines.n
            h = lines.skip(first, last, last, last)
            g = mix(h ^ lines.rolling.hash(first, last - 1)) + lines.words.hash[last - 1] if len(n) else h
            keys = np.zeros((len(n), 2 * BLOCKS), U)
            for shorter in (0, 1):
                c = n - shorter
                for b in range(BLOCKS):
                    begin, end = c * b // BLOCKS, c * (b + 1) // BLOCKS
                    left = lines.skip(first, first + begin, last - (c - end), last)
                    keys[:, shorter * BLOCKS + b] = mix(left + (c * BLOCKS + b).astype(U) * U(0xA0761D6478BD642F))
            # A line one word short of the least length only meets longer ones.
            count = np.where(n >= min_words, 2 * BLOCKS, np.where(n + 1 >= min_words, BLOCKS, 0))
            used = np.arange(2 * BLOCKS) < count[:, None]
            offsets = np.append(0, np.cumsum(count)).astype(np.int32)
            ids = batch.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[lines.row]), pa.array(lines.number), pa.array(n), pa.array(h.view(np.int64)), pa.array(g.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[used].view(np.int64))),
                ],
                ["doc_id", "line", "n", "h", "g", "keys"],
            )


def _neighbours(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The deletion neighbourhood of the chosen lines inside their chosen parts, the whole lines, and their words."""
    for whole in batches:
        for batch in slices(whole, "text", 300_000):
            lines = Lines(batch.column("text"))
            lists = batch.column("marks")
            mark = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
            own = np.searchsorted(lines.row * (1 << 40) + lines.number, row * (1 << 40) + mark // PARTS)
            shorter, block = mark % PARTS // BLOCKS, mark % BLOCKS
            once = np.unique(own)
            emits = lines.n[own] >= min_words
            own, shorter, block = own[emits], shorter[emits], block[emits]
            c = lines.n[own] - shorter
            begin, end = c * block // BLOCKS, c * (block + 1) // BLOCKS + shorter
            each = np.repeat(np.arange(len(own)), end - begin)
            at = np.arange(len(each)) - np.repeat(np.cumsum(end - begin) - end, end - begin)
            first, last = lines.first[own[each]], lines.last[own[each]]
            left = lines.skip(first, first + at, first + at + 1, last)
            swap = shorter[each] == 0
            key = np.where(swap, mix(left + (at + 1).astype(U) * U(0xE7037ED1A0B428DB)), left)
            full = lines.skip(lines.first[once], lines.last[once], lines.last[once], lines.last[once])
            w = lines.words
            texts = [b" ".join(w.bytes[w.start[k] : w.end[k]].tobytes() for k in range(lines.first[i], lines.last[i])).decode("utf-8", "replace") for i in once]
            ids = batch.column("doc_id").to_numpy()
            kinds = np.where(swap, SWAP, SHORTER)
            for kind, key, line, text in ((kinds, key, own[each], None), (np.full(len(once), WHOLE), full, once, None), (np.full(len(once), TEXT), None, once, texts)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kind.astype(np.int32)),
                        pa.nulls(len(line), pa.int64()) if key is None else pa.array(key.view(np.int64)),
                        pa.array(ids[lines.row[line]]), pa.array(lines.number[line]),
                        pa.nulls(len(line), pa.string()) if text is None else pa.array(text, pa.string()),
                    ],
                    ["kind", "key", "doc_id", "line", "words"],
                )


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word put in, left out or replaced, or nothing, makes ``a`` of ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = zip(batch.column("words").to_pylist(), batch.column("others").to_pylist())
        keep = [within_one(a.split(" "), b.split(" ")) for a, b in both]
        yield batch.select(["doc_id", "line"]).filter(pa.array(keep, pa.bool_()))


def removed_lines(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """``(doc_id, line)`` of the lines that an earlier line equals or comes within one word of."""
    rows = cut(docs.mapInArrow(lambda batches: _scan(batches, min_words), _LINES), "lines")
    place = F.struct("doc_id", "line")
    firsts = cut(rows.groupBy("n", "h", "g").agg(F.min(F.struct("doc_id", "line", "keys")).alias("f")).select("n", "h", "g", "f.*"), "firsts")
    copies = rows.join(
        firsts.select("n", "h", "g", F.struct("doc_id", "line").alias("first")), ["n", "h", "g"]
    ).where(place != F.col("first")).select("doc_id", "line")
    thirds = firsts.select("doc_id", "line", "h", F.posexplode("keys").alias("part", "key"))
    shared = thirds.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low < high").select("key")
    marks = thirds.select("key", "doc_id", (F.col("line") * PARTS + F.col("part")).alias("mark"))
    chosen = marks.join(shared, "key", "left_semi").groupBy("doc_id").agg(F.collect_set("mark").alias("marks"))
    texts = packed(docs).join(chosen, "doc_id").select("doc_id", "body_", "marks")
    near = cut(texts.mapInArrow(lambda batches: _neighbours(unpack(batches), min_words), _KEYS), "neighbours")
    keyed = near.where(F.col("kind") != TEXT).withColumn("own", place)
    # A key with its place and one without never meet: the former is mixed with the place.
    of = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("own")))
    stars = keyed.groupBy("key").agg(of(SWAP).alias("swap"), of(SHORTER).alias("shorter"), of(WHOLE).alias("whole"), F.count("*").alias("k")).where("k > 1")
    centre = F.when(F.col("kind") == SWAP, F.col("swap")).when(F.col("kind") == SHORTER, F.col("whole")).otherwise(F.col("shorter"))
    pairs = keyed.join(stars, "key").withColumn("c", centre).where("c < own").select(
        "doc_id", "line", F.col("c.doc_id").alias("other"), F.col("c.line").alias("at")
    ).distinct()
    texts = near.where(F.col("kind") == TEXT).select("doc_id", "line", "words")
    others = texts.toDF("other", "at", "others")
    checked = pairs.join(texts, ["doc_id", "line"]).join(others, ["other", "at"]).select("doc_id", "line", "words", "others")
    return copies.union(checked.mapInArrow(_verify, "doc_id long, line long")).distinct()


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns with the text that is left, the number of lines and of removed lines."""
    for batch in batches:
        n_lines, n_removed, texts = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone_").to_pylist()):
            lines = [] if text is None else text.split("\n")
            drop = set(gone or ())
            n_lines.append(len(lines))
            n_removed.append(len(drop))
            texts.append(text if not drop else "\n".join(x for i, x in enumerate(lines) if i not in drop))
        rest = [c for c in batch.schema.names if c != "gone_"]
        columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in rest]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], [*rest, "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """The documents without the lines that repeat an earlier one, with ``n_lines`` and ``n_removed``.

    Lines are split at ``\\n``; words are runs of other than space and ``\\t`` to ``\\r``, compared with case. A line goes
    if a line of a smaller doc_id, or an earlier line of the same document, has the same words, or differs by one word
    put in, left out or replaced where the longer of both has at least ``min_words`` words; whether that line stays or
    not. Blank lines always stay. A null text stays null and has no lines, an empty one has one. Rows with a null id are
    left out. Rows of equal id and text are one document that gives as many rows. All columns are kept; those named
    ``n_lines`` or ``n_removed`` are replaced. An empty table gives no rows.
    """
    docs, moved = aside(docs.drop("n_lines", "n_removed").where("doc_id IS NOT NULL"), "gone_", "body_")
    docs = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    gone = removed_lines(docs.select("doc_id", "text"), min_words).groupBy("doc_id").agg(F.collect_list("line").alias("gone_"))
    kept = StructType([*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_removed", LongType())])
    joined = packed(docs).join(gone, "doc_id", "left").select(*(c if c != "text" else "body_" for c in docs.columns), "gone_")
    rebuilt = joined.mapInArrow(lambda batches: _rebuild(unpack(batches)), kept)
    return put_back(rebuilt, moved, [*(moved.get(c, c) for c in docs.columns), "n_lines", "n_removed"])
