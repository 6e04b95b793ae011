"""Benchmark passages in documents, also with other numbers, names and units.

Texts become template tokens: words without outer punctuation, A-Z lower-cased; a number becomes a typed placeholder,
so does a unit after a number, and so does a name: a word with a capital first and no second one that doesn't begin a
sentence or line. Windows of ``WINDOW`` tokens of both sides meet in a hash join; the values behind the placeholders come along. Windows of a
document and an item with the same distance belong to one occurrence. It counts if it has ``ENOUGH`` windows (which
together span 13 tokens), or all of a shorter item, and if its slots are consistent: an item's value always meets the
same document value. So a re-parameterised question is found and a chance meeting of placeholders isn't.
Windows with more placeholders than plain tokens meet by the tokens themselves: tables of figures and lists of names
are found where they are copied verbatim. An item of fewer than ``WINDOW`` tokens is one window of its own length: by its
tokens it is found anywhere, by its template in a document that is nothing else.

Before the join, document windows are held against a bitmap of fixed size that holds the items' hashes. It only
spares rows: as the benchmark grows it lets more through, and the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logweir.llm.scan import U, Rolling, Words, flat, mix, slices
from logweir.llm.tables import cut

WINDOW = 8
ENOUGH = 6
BITS = 20

# Units of measure and money that may follow a number.
UNITS = """
mm cm m km inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres kilometer kilometers
mg g kg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml l litre litres liter liters gallon gallons
second seconds minute minutes hour hours day days week weeks month months year years s min h
dollar dollars cent cents euro euros usd eur percent degrees degree watt watts volt volts joule joules newton newtons mph kmh
""".split()
# Numbers in words.
NUMBERS = """
one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
""".split()

Tokens = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]

_NUMBER, _NAME, _UNIT = (int(x) for x in mix(np.arange(1, 4, dtype=U)))
_TOKEN = np.zeros(256, bool)
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 46, 58, 63]] = True
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = _TOKEN[128:] = True


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(Words(pa.array(words)).hash)


_UNIT_HASHES, _NUMBER_HASHES = _hashes(UNITS), _hashes(NUMBERS)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def template(texts: pa.Array) -> Tokens:
    """(row, template hash, value hash, whether a placeholder) of each token of the texts."""
    words = Words(texts)
    raw, _ = flat(texts, " ")
    inner = np.flatnonzero(_TOKEN[raw])
    if not len(inner):
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(U), empty.astype(U), empty.astype(bool)
    a, b = np.searchsorted(inner, words.start), np.searchsorted(inner, words.end) - 1
    some = b >= a
    start, end, row = inner[a[some]], inner[b[some]] + 1, words.row[some]
    digit = (raw >= 48) & (raw <= 57)
    starts_number = digit[start]
    # Letters matter only in tokens that begin with a digit.
    letters = np.zeros(len(start), bool)
    some = np.flatnonzero(starts_number)
    count = np.append(0, np.cumsum((_TOKEN[raw] & ~digit).astype(np.int32)))
    letters[some] = count[end[some]] > count[start[some]]
    # Lower case also for the Latin letters of two bytes, so that shouted texts match.
    capital = np.append(False, (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97))
    value = Rolling(words.bytes + np.where(capital, 32, 0).astype(np.uint8)).hash(start, end)
    number = starts_number & ~letters | _among(value, _NUMBER_HASHES)
    after = np.append(False, number[:-1] & (row[1:] == row[:-1]))
    unit = after & _among(value, _UNIT_HASHES)
    # Glued values as 5km are a number and a unit in one token: the number's placeholder stands for both.
    glued = starts_number & ~number
    # A token begins a sentence if a full stop, question or exclamation mark, colon or line break lies before it.
    stops = np.append(0, np.cumsum(_STOP[raw].astype(np.int32)))
    first = np.ones(len(start), bool)
    first[1:] = (row[1:] != row[:-1]) | (stops[start[1:]] > stops[end[:-1]])
    upper = (raw >= 65) & (raw <= 90)
    initial = np.where(upper[start], start + 1, start + 2)  # what follows the first letter
    shouted = upper[np.minimum(initial, len(raw) - 1)] | (initial >= end)
    name = (upper[start] | capital[np.minimum(start + 1, len(raw) - 1)]) & ~shouted & ~first & ~number
    hashed = np.where(number | glued, U(_NUMBER), np.where(unit, U(_UNIT), np.where(name, U(_NAME), value)))
    return row, hashed, value, number | glued | unit | name


def windows(tokens: Tokens, n_texts: int, sizes: list[int]) -> Iterator[tuple[np.ndarray, ...]]:
    """For each size: (row, place of the window in its text, hash, index of its first token, tokens of its text, whether
    the hash is that of a template); each window by its tokens, and by its template unless that is mostly placeholders."""
    row, hashed, value, slot = tokens
    begin = np.searchsorted(row, np.arange(n_texts + 1))
    size = np.diff(begin)
    rolling, exact = Rolling(hashed), Rolling(value)
    plain = np.append(0, np.cumsum(~slot))
    for w in sizes:
        first = np.flatnonzero(np.arange(len(row)) + w <= begin[row + 1]) if len(row) else np.zeros(0, np.int64)
        alike = first[plain[first + w] - plain[first] >= (w + 1) // 2]  # half of it must be no placeholders
        by_value = mix(exact.hash(first, first + w) ^ U(w | 1 << 8))
        own = np.append(rolling.hash(alike, alike + w) ^ U(w), by_value)
        template = np.arange(len(own)) < len(alike)
        first = np.append(alike, first)
        yield row[first], first - begin[row[first]], own, first, size[row[first]], template


def _slots(tokens: Tokens, first: np.ndarray, w: int, template: np.ndarray) -> pa.Array:
    """Values behind the placeholders of windows, in order; none of those that meet by their tokens."""
    _, _, value, slot = tokens
    index = first[:, None] + np.arange(w)
    is_slot = slot[index] & template[:, None]
    offsets = np.append(0, np.cumsum(is_slot.sum(axis=1))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[index][is_slot].view(np.int64)))


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            tokens = template(batch.column("text"))
            for w, (row, at, hashed, first, size, template_) in zip(range(1, WINDOW + 1), windows(tokens, len(batch), list(range(1, WINDOW + 1)))):
                # Short items are one window of their own length.
                use = size >= w if w == WINDOW else size == w
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(row[use])), pa.array(at[use]), pa.array(hashed[use].view(np.int64)), pa.array(np.full(use.sum(), w)), pa.array(template_[use]), _slots(tokens, first[use], w, template_[use])],
                    ["item_id", "i", "hash", "w", "template", "item_slots"],
                )


def _doc_windows(batches: Iterator[pa.RecordBatch], sizes: list[int], bitmap: np.ndarray, inside: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            tokens = template(batch.column("text"))
            for w, (row, at, hashed, first, size, template_) in zip(sizes, windows(tokens, len(batch), sizes)):
                hit = bitmap[(hashed & U((1 << BITS) - 1)).astype(np.int64)] & ((size == w) | (w == WINDOW) | ~template_ & (w >= inside))
                if hit.any():
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(row[hit])), pa.array(at[hit]), pa.array(hashed[hit].view(np.int64)), _slots(tokens, first[hit], w, template_[hit])],
                        ["doc_id", "at", "hash", "doc_slots"],
                    )


def leaks(docs: DataFrame, items: DataFrame, inside: int = 3) -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, verbatim`` for each document and each benchmark item found in it.

    ``n_windows`` counts the item's windows in the best occurrence, of ``item_windows``; ``verbatim`` says that all
    its slots hold the item's own values. An item of fewer than ``WINDOW`` tokens is found inside a document where all of
    its tokens stand in order, and with other values only in a document that is nothing else. One of fewer than
    ``inside`` tokens needs such a document in both cases, since a word or two turn up anywhere. Null, empty and wordless texts match nothing; items of placeholders
    only match verbatim. Rows with a null id are left out; repeated documents and repeated items give a pair once. Other columns
    aren't read. An empty side gives no rows.
    """
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    questions = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    wanted = cut(questions.mapInArrow(_item_windows, "item_id long, i long, hash long, w long, template boolean, item_slots array<long>").distinct(), "windows")
    # At most 2**BITS marks and WINDOW sizes, however many items there are.
    marks = wanted.select(F.col("hash").bitwiseAND((1 << BITS) - 1).alias("mark")).distinct().toArrow()["mark"].to_numpy()
    sizes = sorted(r.w for r in wanted.select("w").distinct().collect())
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[marks] = True
    found = texts.mapInArrow(
        lambda batches: _doc_windows(batches, sizes, bitmap, inside), "doc_id long, at long, hash long, doc_slots array<long>"
    )
    like = F.countDistinct(F.when(F.col("template"), F.col("i")))
    totals = wanted.groupBy("item_id").agg(F.countDistinct("i").alias("item_windows"), like.alias("item_like"))
    met = found.join(wanted, "hash").select(
        "doc_id", "item_id", "i", "template", (F.col("at") - F.col("i")).alias("shift"), F.arrays_zip("item_slots", "doc_slots").alias("slots")
    )
    met = cut(met, "met")  # read three times below, the texts only once
    occurrence = ["doc_id", "item_id", "shift"]
    counted = met.groupBy(*occurrence).agg(
        F.countDistinct("i").alias("n_windows"), like.alias("n_like"), F.countDistinct(F.when(~F.col("template"), F.col("i"))).alias("n_exact")
    )
    values = met.select(*occurrence, F.explode("slots").alias("s")).select(*occurrence, "s.item_slots", "s.doc_slots").distinct()
    slots = values.groupBy(*occurrence, "item_slots").agg(F.count("*").alias("k"), F.bool_and(F.col("item_slots") == F.col("doc_slots")).alias("same"))
    checked = slots.groupBy(*occurrence).agg(F.max("k").alias("most"), F.bool_and("same").alias("same"))
    kept = (
        counted.join(totals, "item_id")
        .join(checked, occurrence, "left")
        .withColumn("consistent", F.expr("coalesce(most, 1) = 1"))
        .where(
            F.col("consistent") & (F.col("n_like") > 0) & (F.col("n_like") >= F.least(F.lit(ENOUGH), "item_like"))
            | F.col("consistent") & (F.col("n_windows") >= F.least(F.lit(ENOUGH), "item_windows"))
            | (F.col("n_exact") >= F.least(F.lit(ENOUGH), "item_windows"))
        )
    )
    return kept.groupBy("doc_id", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"), F.max(F.coalesce("same", F.lit(True))).alias("verbatim")
    )
