"""Ranked lexical search by two trees: all items against all documents, exact.

An item is a vector of its terms' counts, a document one of its terms' impacts, whole numbers from global statistics; a
score is their product. Items and documents are each arranged in a binary tree by the terms they have or lack, and
a node holds the largest value of each term below it. The product of two nodes' vectors bounds every score of a pair
below them, so a pair of nodes is left out with all its items and documents if its bound is less than the weakest of
its items' k-th best scores so far. Pairs come by falling bound; pairs of leaves are scored by one matrix product.

Items are cut in batches of about ``BATCH_TERMS`` terms by a hash of the id, so what is sent to tasks has a bounded size.
For each batch one pass over the texts writes an index of the documents' item terms and another its statistics. The
index is searched in two rounds, each in shards of ``SHARD_DOCS`` documents: the first takes about the root of the
number of shards, by a hash; its k-th best scores are the least that the second has to exceed, so each item's
results grow with the root of the number of documents. Documents that none of the items' terms occur in are only counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heapify, heappop, heappush
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from logweir.llm.scan import Words, slices
from logweir.llm.tables import cut

# Words are ASCII letters and digits and everything beyond ASCII.
_GAPS = np.ones(256, bool)
_GAPS[0x30:0x3A] = _GAPS[0x41:0x5B] = _GAPS[0x61:0x7B] = _GAPS[0x80:] = False

BATCH_TERMS = 1 << 16
SHARD_DOCS = 4096
DOC_LEAF, ITEM_LEAF = 32, 8
INDEX = "doc_id long, size long, terms array<int>, times array<int>, docs long"


def _counts(batch: pa.RecordBatch, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the distinct terms of each text, by row and term, and all terms' number by row.

    With sorted hashes ``places`` only these terms are given, each as its place among them.
    """
    words = Words(batch.column("text"), gaps=_GAPS)
    row, term = words.row, words.hash
    if places is not None:
        at = np.minimum(np.searchsorted(places, term), max(0, len(places) - 1))
        known = places[at] == term if len(places) else np.zeros(len(term), bool)
        row, term = row[known], at[known]
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    first = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (term[1:] != term[:-1]))[: len(row)])
    return row[first], term[first], np.diff(np.append(first, len(row))), np.diff(words.offsets)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            row, term, times, _ = _counts(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(row)), pa.array(term.view(np.int64)), pa.array(times.astype(np.int64))], ["item_id", "term", "times"]
            )


def _index(batches: Iterator[pa.RecordBatch], places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each document with some of the terms; a row without id and terms counts all documents and terms."""
    docs = total = 0
    for whole in batches:
        for batch in slices(whole, "text"):
            row, term, times, size = _counts(batch, places)
            docs, total = docs + int((size > 0).sum()), total + int(size.sum())
            some, begin = np.unique(row, return_index=True)
            ends = pa.array(np.append(begin, len(row)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(some)), pa.array(size[some].astype(np.int64)), *lists, pa.nulls(len(some), pa.int64())],
                ["doc_id", "size", "terms", "times", "docs"],
            )
    none = pa.nulls(1, pa.list_(pa.int32()))
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(1, pa.int64()), pa.array([total]), none, none, pa.array([docs])], ["doc_id", "size", "terms", "times", "docs"]
    )


@dataclass
class Sparse:
    """Rows of (column, value): entries of row ``i`` lie from ``begin[i]`` to ``begin[i + 1]``."""

    begin: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of ``rows``, and which of ``rows`` each belongs to."""
        n = self.begin[rows + 1] - self.begin[rows]
        of = np.repeat(np.arange(len(rows)), n)
        return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.begin[rows][of], of

    def dense(self, rows: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(rows), width), self.value.dtype)
        at, of = self.entries(rows)
        out[of, self.column[at]] = self.value[at]
        return out


class Tree:
    """Rows in an order such that each node is a run of them; ``tops`` has each node's largest value by column."""

    def __init__(self, rows: Sparse, width: int, leaf: int):
        self.rows, self.width = rows, width
        n = len(rows.begin) - 1
        self.order = np.arange(n)
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        stack: list[tuple[int, int, int]] = [(0, n, -1)]
        while stack:
            a, b, parent = stack.pop()
            node = len(self.spans)
            self.spans.append((a, b))
            self.children.append(None)
            if parent >= 0:
                other = self.children[parent]
                self.children[parent] = (node, node) if other is None else (other[0], node)
            if b - a > leaf:
                middle = self._split(a, b, max(leaf // 2, (b - a) // 64))
                stack += [(a, middle, node), (middle, b, node)]
        self.tops = np.zeros((len(self.spans), width), rows.value.dtype)
        for node in range(len(self.spans) - 1, -1, -1):  # children come behind their parents
            pair = self.children[node]
            if pair:
                np.maximum(self.tops[pair[0]], self.tops[pair[1]], out=self.tops[node])
            else:
                at, _ = rows.entries(self.order[slice(*self.spans[node])])
                np.maximum.at(self.tops[node], rows.column[at], rows.value[at])

    def _split(self, a: int, b: int, least: int) -> int:
        """Rows of a run with the column that tells them apart best first, then the others; where the latter begin.

        Without a column that ``least`` rows have and as many lack, the run is halved as it is.
        """
        own = self.order[a:b]
        at, of = self.rows.entries(own)
        column = self.rows.column[at]
        holders = np.bincount(column, minlength=self.width)
        weight = np.bincount(column, self.rows.value[at], self.width)
        worth = weight * (b - a - holders)  # mass that the other half is free of
        worth[np.minimum(holders, b - a - holders) < least] = 0
        best = int(worth.argmax()) if self.width else 0
        if not self.width or not worth[best] > 0:
            return (a + b) // 2
        has = np.zeros(b - a, bool)
        has[of[column == best]] = True
        self.order[a:b] = np.concatenate([own[has], own[~has]])
        return a + int(has.sum())

    def members(self, node: int) -> np.ndarray:
        return self.order[slice(*self.spans[node])]


def search(items: Tree, docs: Tree, ids: np.ndarray, k: int, least: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Scores and ids of each item's best ``k`` documents, best first, and how many pairs of leaves were scored.

    Scores below ``least`` of an item may be left out, others are exact; equal scores rank by id, none is 0 or less.
    """
    n = len(items.order)
    kind = items.rows.value.dtype
    scores = [np.zeros(0, kind)] * n
    found = [np.zeros(0, np.int64)] * n
    weakest = np.maximum(least, 1).astype(kind)
    bounds = items.tops @ docs.tops.T
    queue = [(-bounds[0, 0], 0, 0)] if len(ids) and n else []
    heapify(queue)
    scored = 0
    dense = {}
    while queue:
        bound, i, d = heappop(queue)
        own = items.members(i)
        if -bound < weakest[own].min():
            continue
        if items.children[i] is None and docs.children[d] is None:
            scored += 1
            if i not in dense:
                dense[i] = items.rows.dense(own, items.width)
            rows = docs.members(d)
            product = dense[i] @ docs.rows.dense(rows, docs.width).T
            for r in np.flatnonzero((product >= weakest[own][:, None]).any(axis=1)):
                item, good = own[r], product[r] >= weakest[own[r]]
                s, x = np.append(scores[item], product[r][good]), np.append(found[item], ids[rows[good]])
                best = np.lexsort((x, -s))[:k]
                scores[item], found[item] = s[best], x[best]
                if len(best) == k:
                    weakest[item] = max(weakest[item], s[best[-1]])
            continue
        for ci in items.children[i] or (i,):
            for cd in docs.children[d] or (d,):
                heappush(queue, (-bounds[ci, cd], ci, cd))
    return scores, found, scored


@dataclass
class Statistics:
    """Weights by term, and the numbers of documents and terms."""

    weight: np.ndarray
    docs: int
    total: int

    def kind(self, items: Sparse) -> type:
        """Type in which all sums are exact: doubles, whose products are fast, while these stay below 2**53."""
        row = np.repeat(np.arange(len(items.begin) - 1), np.diff(items.begin))
        most = np.bincount(row, items.value * self.weight[items.column] * 1e6)
        return float if most.max(initial=0) < 1 << 52 else np.int64

    def impacts(self, term: np.ndarray, times: np.ndarray, size: np.ndarray) -> np.ndarray:
        m = 75 + 25 * size * self.docs // self.total
        return self.weight[term] * (1_000_000_000 * times // (1000 * times + 12 * m))


def _doc_tree(tables: list[pa.Table], statistics: Statistics, items: Tree) -> tuple[Tree, np.ndarray]:
    docs = pa.concat_tables(tables).combine_chunks()
    lists = docs["terms"].combine_chunks()
    begin = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    term, times = (docs[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "times"))
    size = np.repeat(docs["size"].to_numpy(), np.diff(begin))
    value = statistics.impacts(term, times, size).astype(items.rows.value.dtype)
    return Tree(Sparse(begin, term, value), items.width, DOC_LEAF), docs["doc_id"].to_numpy()


def _searched(batches: Iterator[pa.RecordBatch], items: Tree, statistics: Statistics, k: int, least: np.ndarray, shard_docs: int) -> Iterator[pa.RecordBatch]:
    """The best of each shard of consecutive rows; later shards of a task start at the bounds that earlier ones found."""
    least = least.copy()

    def best(tables: list[pa.Table]) -> pa.RecordBatch:
        tree, ids = _doc_tree(tables, statistics, items)
        scores, found, _ = search(items, tree, ids, k, least)
        for i, s in enumerate(scores):
            if len(s) == k:
                least[i] = max(least[i], s[-1])
        item = np.repeat(np.arange(len(scores)), [len(s) for s in scores])
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in ((item, pa.int32()), (np.concatenate(found), pa.int64()), (np.concatenate(scores).astype(np.int64), pa.int64()))],
            ["item", "doc_id", "score"],
        )

    held, n = [], 0
    for whole in batches:
        for at in range(0, len(whole), 512):
            part = pa.Table.from_batches([whole.slice(at, 512)])
            held, n = [*held, part], n + len(part)
            if n >= shard_docs:
                yield best(held)
                held, n = [], 0
    if n:
        yield best(held)


def _batch(texts: DataFrame, items: list[Row], k: int, shard_docs: int) -> DataFrame | None:
    """``item_id, doc_id, score`` of one batch of items, some rows beyond the best ``k``; None if there are none."""
    spark = texts.sparkSession
    # Null ids have no rows, so names are the ids in order; terms are places among the sorted hashes.
    names = sorted({r.item_id for r in items})
    places = np.unique(np.array([r.term for r in items], np.int64).view(np.uint64))
    at = {x: i for i, x in enumerate(names)}
    row = np.array([at[r.item_id] for r in items])
    column = np.searchsorted(places, np.array([r.term for r in items], np.int64).view(np.uint64))
    order = np.lexsort((column, row))
    begin = np.searchsorted(row[order], np.arange(len(names) + 1))
    vectors = Sparse(begin, column[order], np.array([r.times for r in items], np.int64)[order])

    index = cut(texts.mapInArrow(lambda batches: _index(batches, places), INDEX), "index")
    totals = index.where("doc_id IS NULL").agg(F.sum("docs").alias("docs"), F.sum("size").alias("total")).first()
    if not totals.total:
        return None
    weights = np.zeros(len(places), np.int64)
    by_term = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * totals.docs + 2) / (2 * F.col("df") + 1)))
    for r in by_term.select("term", weight.alias("w")).collect():  # a row for each of the batch's terms at most
        weights[r.term] = r.w
    statistics = Statistics(weights, totals.docs, totals.total)
    vectors.value = vectors.value.astype(statistics.kind(vectors))
    tree = Tree(vectors, len(places), ITEM_LEAF)

    index = index.where("doc_id IS NOT NULL")
    shards = totals.docs // shard_docs + 1
    rounds = max(1, isqrt(shards))
    first = F.pmod(F.xxhash64("doc_id", "size"), F.lit(rounds)) == 0
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")

    def found(rows: DataFrame, n: int, least: np.ndarray) -> DataFrame:
        spread = rows.select("doc_id", "size", "terms", "times").repartition(n)
        out = spread.mapInArrow(lambda batches: _searched(batches, tree, statistics, k, least, shard_docs), "item int, doc_id long, score long")
        return cut(out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "found")

    least = np.zeros(len(names), np.int64)
    parts = [found(index.where(first), shards // rounds + 1, least)]
    if rounds > 1:
        for r in parts[0].where(F.col("rank") == k).collect():  # a row for each item of the batch at most
            least[r.item] = r.score
        parts.append(found(index.where(~first), shards, least))
    ids = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return reduce(DataFrame.union, parts).join(F.broadcast(ids), "item").select("item_id", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, batch_terms: int = BATCH_TERMS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``k`` of ``docs (doc_id, text)`` for each of ``items (item_id, text)``.

    Terms are runs of ASCII letters, digits and signs beyond ASCII, A-Z lower-cased. Scores are whole numbers; equal
    ones rank by doc_id; documents without a term of the item, and those whose terms weigh nothing, don't rank.

    Null, empty and wordless texts find nothing and aren't counted as documents. Rows with a null id are left out on
    both sides. Repeated rows of a document are documents each and rank one behind the other. Rows of one item id are
    one item with the terms of all of them, equal rows once. Further columns aren't read; an empty side gives no rows.
    """
    plain = lambda df, key: df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))
    texts, asked = plain(docs, "doc_id"), plain(items, "item_id").distinct()
    terms = asked.mapInArrow(_item_terms, "item_id long, term long, times long")
    terms = cut(terms.groupBy("item_id", "term").agg(F.sum("times").alias("times")), "items")
    n = -(-terms.count() // batch_terms)
    found = [
        _batch(texts, terms.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).collect(), k, shard_docs)  # about batch_terms rows
        for b in range(n)
    ]
    found = [x for x in found if x is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    rows = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(best))
    return rows.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
