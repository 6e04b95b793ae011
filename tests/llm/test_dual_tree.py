"""Dual-tree search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from logweir.llm.dual_tree import Sparse, Statistics, Tree, ranked, search

from tests.llm.rows import ODD, clashing, corpus, documents, sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=20):
    count = lambda t: Counter(TERM.findall((t or "").translate(FOLD)))
    rows = [(d, c) for d, c in ((d, count(t)) for d, t, *_ in docs if d is not None) if c]
    n, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    asked = {}
    for i, t in {x[:2] for x in items if x[0] is not None}:
        asked[i] = asked.get(i, Counter()) + count(t)
    out = []
    for i, terms in asked.items():
        found = []
        for d, c in rows:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in terms.items() if c[t])
            found += [(-s, d)] * (s > 0)
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def rows_of(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


ITEMS = [(1, "Lamp1 river2, river2; the ÉTÉ"), (2, None), (3, ""), (4, "... --"), (5, "zzz"), (6, "word"), (None, "lamp1"),
         (7, "stone5 garden3"), (7, "stone5 garden3"), (7, "window1"), (8, "x" * 70_000 + " one")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size", [{}, {"batch_terms": 4, "shard_docs": 7}])
def test_against_brute_force(spark, seed, size):
    rng = random.Random(seed)
    rows = corpus(seed, 80) + ODD
    items = ITEMS + [(100 + i, sentence(rng, rng.choice([1, 5, 40]))) for i in range(12)]
    items.append((200, rows[3][1]))
    assert rows_of(ranked(documents(spark, rows), table(spark, items), 5, **size)) == brute(rows, items, 5)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, "same words here" if i % 3 else "other words", "en", "s", 1) for i in range(90)]
    items = [(1, "same here"), (2, "words other")]
    assert rows_of(ranked(documents(spark, rows), table(spark, items), shard_docs=8)) == brute(rows, items)


def test_clashing_columns_and_empty_tables(spark):
    rows, items = corpus(3, 20), ITEMS
    wanted = brute(rows, items)
    docs = clashing(documents(spark, rows), "terms", "size", "times", "item_id", "score", "docs")
    assert rows_of(ranked(docs, clashing(table(spark, items), "term", "doc_id", "times"))) == wanted
    none = ranked(documents(spark, []), table(spark, items))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked(documents(spark, rows), table(spark, [])).count() == 0


def sparse(rng, rows, width, kind=float):
    held = [np.sort(rng.choice(width, rng.integers(0, 6), replace=False)) for _ in range(rows)]
    column = np.concatenate([*held, np.zeros(0, np.int64)])
    return Sparse(np.append(0, np.cumsum([len(h) for h in held])), column, rng.integers(1, 9, len(column)).astype(kind))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("kind", [float, np.int64])
def test_trees_lose_nothing(seed, kind):
    rng = np.random.default_rng(seed)
    width, k = 30, 4
    items, docs = sparse(rng, 37, width, kind), sparse(rng, 150, width, kind)
    ids = rng.permutation(1000)[:150]
    item_tree, doc_tree = Tree(items, width, 4), Tree(docs, width, 8)
    assert sorted(item_tree.order) == list(range(37)) and sorted(doc_tree.order) == list(range(150))
    scores, found, _ = search(item_tree, doc_tree, ids, k, np.zeros(37, np.int64))
    all_scores = items.dense(np.arange(37), width) @ docs.dense(np.arange(150), width).T
    for i in range(37):
        order = [x for x in np.lexsort((ids, -all_scores[i])) if all_scores[i, x] > 0][:k]
        assert found[i].tolist() == ids[order].tolist() and scores[i].tolist() == all_scores[i, order].tolist()


def test_bounds_prune_whole_batches():
    rng = np.random.default_rng(1)
    # Documents of one subject each, items of one subject each.
    subject = np.arange(2048) % 64
    docs = Sparse(np.arange(0, 2048 * 4 + 1, 4), (subject[:, None] * 4 + np.arange(4)).ravel(), rng.integers(1, 9, 2048 * 4).astype(float))
    items = Sparse(np.arange(0, 64 * 4 + 1, 4), np.arange(256), np.ones(256))
    item_tree, doc_tree = Tree(items, 256, 8), Tree(docs, 256, 32)
    leaves = lambda t: sum(c is None for c in t.children)
    _, _, scored = search(item_tree, doc_tree, np.arange(2048), 5, np.zeros(64, np.int64))
    assert scored < leaves(item_tree) * leaves(doc_tree) / 4


def test_sums_beyond_doubles_are_whole_numbers():
    items = Sparse(np.array([0, 1]), np.array([0]), np.array([10**7]))
    assert Statistics(np.array([28_000]), 10, 10).kind(items) is np.int64
    assert Statistics(np.array([7]), 10, 10).kind(items) is float
