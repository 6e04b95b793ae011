"""Removal of byte strings that start earlier too, by a parse at rolling-hash triggers.

Method. A rolling hash of every 32 bytes picks triggers: in each string of ``length`` bytes the least hash (the
leftmost of equals) is its trigger, so equal strings have equal triggers at equal places. Consecutive strings of one
trigger form a phrase; a phrase is written with the bytes its last string needs, so the parse is prefix-free: what
follows never changes what a phrase says. Equal phrases of the parse are ranked in corpus order, and every one but
the first is removed whole. What is left is the dictionary of distinct phrases. Only where a trigger stands in
several of them can their suffixes agree, so only those phrases are opened: their suffixes are ordered to the depth
of ``length`` bytes (by hash, as only equality counts) and within equal ones by corpus order. The first stays.

Everything is grouped over the cluster by trigger or by suffix. A task first drops what its own rows decide (all but
the first of equal phrases), so a group of copies reaches the shuffle as a row for each slice of a task, not for each
copy. The suffix arrays are never built as one array; the shuffle's sort does their work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logweir.llm.scan import U, Rolling, flat, mix, slices, unpack
from logweir.llm.tables import cut, packed

GRAM = 32
_STEP = 1 << 22
_LOW = U((1 << 24) - 1)
# A removed or opened phrase is packed as start * SPAN + number of strings; a phrase has fewer strings than SPAN.
SPAN = 128

_PHRASE = "doc_id long, at long, trigger int, content long, before int, behind int"


def phrases(raw: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of all phrases, in pieces of bounded size: row, start within its text, strings, hashes of the trigger, of the
    content, and of the trigger with half a string's other bytes before or behind it (0: the phrase lacks them).
    """
    places = length - GRAM + 1
    half = (length - GRAM) // 2
    for a in range(0, len(raw) - length + 1, _STEP):
        part = raw[a : a + _STEP + length - 1]
        rolling = Rolling(part)
        at = np.arange(len(part) - GRAM + 1)
        grams = rolling.hash(at, at + GRAM)
        least = (grams & ~_LOW) | at.astype(U)
        width = 1
        while width * 2 <= places:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if places > width:
            least = np.minimum(least[: len(least) - (places - width)], least[places - width :])
        row = np.searchsorted(offsets, a + np.arange(len(least)), "right") - 1
        whole = a + np.arange(len(least)) + length <= offsets[row + 1]
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | ~whole[:-1]
        first = np.flatnonzero(change & whole)
        if not len(first):
            continue
        stop = np.flatnonzero(np.append(change[1:] | ~whole[1:], True) & whole) + 1
        mark, last = (least[first] & _LOW).astype(np.int64), stop + length - 1
        left, right = mark - half >= first, mark + GRAM + half <= last
        before, behind = np.zeros(len(first), U), np.zeros(len(first), U)
        # Never 0, also when cut to the upper half.
        before[left] = rolling.hash(mark[left] - half, mark[left] + GRAM) | U(1 << 32)
        behind[right] = rolling.hash(mark[right], mark[right] + GRAM + half) | U(1 << 32)
        yield row[first], a + first - offsets[row[first]], stop - first, grams[mark], rolling.hash(first, last), before, behind


def _after_first(doc: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which rows have a key that another row has at an earlier (doc, at)."""
    order = np.lexsort((at, doc, key))
    new = np.append(True, key[order][1:] != key[order][:-1])
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = np.zeros(len(key), bool)
    later[order] = (doc[first] != doc[order]) | (at[first] != at[order])
    return later


def _parse(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The phrases of a slice; later equal ones have null content, as removed, and a trigger that spreads them."""
    short = lambda x: pa.array((x >> U(32)).astype(np.uint32).view(np.int32))
    for whole in batches:
        for batch in slices(whole, "text"):
            raw, offsets = flat(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            for row, start, n, trigger, content, before, behind in phrases(raw, offsets, length):
                later = _after_first(ids[row], start, content)
                spread = mix(ids[row].view(U) * U(0x9E3779B97F4A7C15) + start.astype(U))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row]),
                        pa.array(start * SPAN + n),
                        short(np.where(later, spread, trigger)),
                        pa.array(content.view(np.int64), mask=later),
                        short(before),
                        short(behind),
                    ],
                    ["doc_id", "at", "trigger", "content", "before", "behind"],
                )


def _open(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Hash and start of every string of the opened phrases; later equal ones of a slice come with a null hash."""
    for whole in batches:
        for batch in slices(whole, "text"):
            raw, offsets = flat(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            lists = batch.column("opened")
            counts = np.diff(lists.offsets.to_numpy())
            at = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(ids)), counts)
            order = np.lexsort((at, ids[row]))
            for k in range(0, len(order), 20_000):
                take = order[k : k + 20_000]
                start, n, r = at[take] // SPAN, at[take] % SPAN, row[take]
                size = n + length - 1
                local = np.cumsum(size) - size
                index = np.arange(size.sum()) + np.repeat(offsets[r] + start - local, size)
                rolling = Rolling(raw[index])
                lead = np.cumsum(n) - n
                step = np.arange(n.sum()) - np.repeat(lead, n)
                begin = np.repeat(local, n) + step
                hashes = rolling.hash(begin, begin + length)
                doc, where = np.repeat(ids[r], n), np.repeat(start, n) + step
                later = _after_first(doc, where, hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(where * SPAN + 1), pa.array(hashes.view(np.int64), mask=later)],
                    ["doc_id", "at", "string"],
                )


def spans(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that the packed phrases cover."""
    start = np.sort(at) // SPAN
    end = np.maximum.accumulate(start + np.sort(at) % SPAN + length - 1)
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def _remove(batches: Iterator[pa.RecordBatch], length: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            n_bytes, n_removed, n_spans, digests, texts = [], [], [], [], []
            raw, offsets = flat(batch.column("text"))
            for i, removed in enumerate(batch.column("removed")):
                body = raw[offsets[i] : offsets[i + 1]]
                kept, count = body, 0
                if removed.is_valid:
                    start, end = spans(removed.values.to_numpy(), length)
                    count = len(start)
                    edge = np.zeros(len(body) + 1, np.int8)
                    edge[start] += 1
                    edge[end] -= 1
                    kept = body[np.cumsum(edge[:-1]) == 0]
                n_bytes.append(len(body))
                n_removed.append(len(body) - len(kept))
                n_spans.append(count)
                digests.append(hashlib.sha256(kept.tobytes()).hexdigest())
                if with_text:
                    texts.append(kept.tobytes().decode("utf-8", "ignore"))
            columns = [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)


def removed_strings(docs: DataFrame, length: int = 100) -> DataFrame:
    """``(doc_id, at)``: places whose strings of ``length`` bytes start earlier too; ``at`` is start * SPAN + count."""
    if not GRAM < length < GRAM + SPAN - 1:
        raise ValueError(f"length must lie between {GRAM + 1} and {GRAM + SPAN - 2}")
    parsed = docs.mapInArrow(lambda batches: _parse(batches, length), _PHRASE)
    # One exchange by trigger serves all windows, since equal content has an equal trigger. 32 bits of the trigger's
    # hash will do: where two meet by chance, phrases are opened for nothing.
    differ = lambda key: (F.col(key) != 0) & (F.min("content").over(Window.partitionBy("trigger", key)) != F.max("content").over(Window.partitionBy("trigger", key)))
    early = Window.partitionBy("trigger", "content").orderBy("doc_id", "at")
    settled = cut(
        parsed.repartition("trigger")
        .withColumn("several", differ("before") | differ("behind"))
        .withColumn("rank", F.rank().over(early))
        .withColumn("removed", F.col("content").isNull() | (F.col("rank") > 1))
        .where("removed OR several")
        .select("doc_id", "at", "removed"),
        "phrases",
    )
    opened = settled.where("NOT removed").groupBy("doc_id").agg(F.collect_list("at").alias("opened"))
    strings = cut(
        packed(docs).join(opened, "doc_id").select("doc_id", "body_", "opened").mapInArrow(
            lambda batches: _open(unpack(batches), length), "doc_id long, at long, string long"
        ),
        "strings",
    )
    later = Window.partitionBy("string").orderBy("doc_id", "at")
    again = strings.where("string IS NOT NULL").withColumn("rank", F.rank().over(later)).where("rank > 1")
    return (
        settled.where("removed").select("doc_id", "at")
        .union(again.select("doc_id", "at"))
        .union(strings.where("string IS NULL").select("doc_id", "at"))
    )


def remove_repeats(docs: DataFrame, length: int = 100, with_text: bool = False) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept_text``) without repeated strings.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a smaller doc_id, or earlier
    in the same document, overlaps included. Strings never cross documents and are judged on the input. A null text
    is empty. Rows with a null id are left out. Rows of equal id and text are one document that gives as many rows. An empty table gives no rows. ``kept_text`` leaves out a character
    of which a byte was removed.
    """
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = removed_strings(texts, length).groupBy("doc_id").agg(F.collect_list("at").alias("removed"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    return packed(texts).join(found, "doc_id", "left").select("doc_id", "body_", "removed").mapInArrow(
        lambda batches: _remove(unpack(batches), length, with_text), schema
    )
