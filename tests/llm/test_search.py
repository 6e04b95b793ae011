"""Top-k search against scoring every document."""

import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from logweir.llm import search
from logweir.llm.search import Shard, top_k

from tests.llm.rows import ODD, clashing, corpus, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, queries, k=10):
    rows = [(d, Counter(WORD.findall((t or "").translate(FOLD)))) for d, t, *_ in docs if d is not None]
    n, df = len(rows), Counter(w for _, c in rows for w in c)
    average = max(1.0, sum(sum(c.values()) for _, c in rows) / max(1, n))
    weight = lambda w, c: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / average))
    tf = dict(rows)
    out = set()
    for q, text in {x[:2] for x in queries if x[0] is not None}:
        c = Counter(WORD.findall((text or "").translate(FOLD)))
        score = defaultdict(float)
        for w in sorted(c):
            for d in tf:
                if tf[d][w]:
                    score[d] += weight(w, tf[d])
        out |= {(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted((-round(s, 6), d) for d, s in score.items())[:k])}
    return out


def result(docs, queries, **options):
    got = [tuple(r) for r in top_k(docs, queries, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def agree(got, want):
    """Equal but for the last digit of scores, which the order of a sum may change."""
    assert {r[:3] for r in got} == {r[:3] for r in want}
    scores = {r[:3]: r[3] for r in want}
    assert all(abs(r[3] - scores[r[:3]]) < 2e-6 for r in got)


@pytest.mark.parametrize("k", [10, 3, 1])
def test_all_documents(spark, k):
    docs = [*corpus(12, 90), *[r for r in ODD if r[0] != 905], (905, "word " * 30_000, "", "", 0)]
    df = documents(spark, docs)
    agree(result(df, df, k=k), brute(docs, docs, k))


def test_rounds_of_shards(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 8)
    monkeypatch.setattr(search, "BATCH", 7)
    monkeypatch.setattr(search, "GROWTH", 2)
    docs = corpus(5, 100)
    df = documents(spark, docs)
    agree(result(df, df), brute(docs, docs))


def test_many_copies_tie_by_id(spark):
    docs = [(i, f"same rare words {i % 2}", "", "", 0) for i in range(400)]
    df = documents(spark, docs)
    agree(result(df, df.where("doc_id % 50 = 0"), k=5), brute(docs, docs[::50], 5))


def test_odd_rows(spark):
    df = documents(spark, [*ODD, (1, "word here", "", "", 0)])
    clash = clashing(df, "term", "score", "rank", "shard", "query")
    got = result(clash, clash)
    assert {(q, d) for q, _, d, _ in got} == {(1, 1), (1, 905), (905, 1), (905, 905), (903, 903), (904, 904), (906, 906)}
    empty = documents(spark, [])
    assert result(empty, df) == result(df, empty) == set()


def test_blocks_prune_and_stay_exact(monkeypatch):
    rng = np.random.default_rng(4)
    for dense in (0, 3, 256):
        monkeypatch.setattr(search, "DENSE", dense)
        for _ in range(10):
            n = int(rng.integers(1, 900))
            sizes = rng.integers(1, 12, n)
            term = np.concatenate([np.sort(rng.choice(40, s, replace=False)) for s in sizes]).astype(np.int64)
            tf, dl = rng.integers(1, 4, len(term)), rng.integers(10, 14, n)
            doc = rng.permutation(n) * 3
            shard = Shard(doc, dl, sizes, term, tf, 12.0)
            queries = [(np.sort(rng.choice(45, 9, replace=False)), rng.choice([0.5, 1.25, 2.0], 9)) for _ in range(6)]
            total = np.zeros((6, n))
            for q, (terms, weights) in enumerate(queries):
                w = np.zeros(45)
                w[terms] = weights
                part = tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * np.repeat(dl, sizes) / 12.0)) * w[term]
                total[q] = np.round(np.bincount(np.repeat(np.arange(n), sizes), part, n), 6)
            for k in (1, 7, 5000):
                got = {q: list(zip(d.tolist(), s.tolist())) for q, d, s in shard.search(queries, k, np.zeros(6))}
                for q in range(6):
                    order = [i for i in np.lexsort((doc, -total[q])) if total[q][i] > 0][:k]
                    assert got.get(q, []) == [(int(doc[i]), total[q][i]) for i in order]


def test_shard_takes_little_more_than_its_postings():
    rng = np.random.default_rng(3)
    docs, each = 4_000, 250
    term = rng.integers(0, 2**62, 2_000)[rng.random((docs, 2_000)).argsort(1)[:, :each].ravel()]
    doc, dl, sizes = np.arange(docs) * 7, rng.integers(250, 900, docs), np.full(docs, each)
    tf = rng.integers(1, 9, docs * each).astype(np.int32)
    tracemalloc.start()
    shard = Shard(doc, dl, sizes, [term[:300_000], term[300_000:]], tf, 500.0)
    assert tracemalloc.get_traced_memory()[1] - shard.columns.nbytes < 22 * len(term)  # 25 before
    tracemalloc.stop()
    place = np.searchsorted(shard.terms, term)
    order = np.lexsort((np.repeat(np.arange(docs), each), place))
    assert (shard.at == np.repeat(np.arange(docs), each)[order]).all() and (shard.size == np.bincount(place)).all()
    norm = 1.2 * (0.25 + 0.75 * dl / 500.0)
    assert np.array_equal(shard.part, (tf * 2.2 / (np.repeat(norm, each) + tf))[order])
    wide = Shard(doc, dl, sizes, term, np.where(np.arange(len(tf)) == 5, 2**40, tf), 500.0)  # too wide for one number
    same = order != 5
    assert np.array_equal(wide.at, shard.at) and np.array_equal(wide.part[same], shard.part[same])


def test_index_names_terms_once(monkeypatch):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.2, 400) % 3_000) for _ in range(900)]
    shards = np.arange(900) % 3
    batch = pa.RecordBatch.from_arrays([pa.array(shards), pa.array(np.arange(900) * 5), pa.array(texts)], ["shard", "doc_id", "text"])
    every = np.full(1 << search.BITS - 6, 2**64 - 1, np.uint64)
    whole = {d * 5: Counter(t.split()) for d, t in enumerate(texts)}
    n = sum(map(len, whole.values()))
    rows = pa.Table.from_batches([*search._index(iter([batch]), every)])
    assert rows.nbytes < 6 * n  # 12 bytes a posting and 8 a document before
    for chunk, held in ((1 << 16, 1 << 21), (700, 10_000), (1, 1)):  # rows of any size hold the same
        monkeypatch.setattr(search, "CHUNK", chunk)
        monkeypatch.setattr(search, "HELD", held)
        rows = pa.Table.from_batches([*search._index(iter([batch.slice(0, 500), batch.slice(500)]), every)])
        seen = []
        for shard in range(3):
            some = rows.filter(pa.array(rows.column("shard").to_numpy() == shard))
            doc, dl, sizes, terms, times = search._postings(some)
            assert (doc // 5 % 3 == shard).all() and (dl == 400).all()
            flat = np.concatenate([known[place] for known, place in terms])
            for d, term, times in zip(doc, np.split(flat, np.cumsum(sizes)[:-1]), np.split(times, np.cumsum(sizes)[:-1])):
                assert sorted(times) == sorted(whole[d].values()) and len(set(term)) == len(term)
                seen.append(d)
        assert sorted(seen) == sorted(whole)


def test_search_holds_sums_of_some_queries_only():
    rng = np.random.default_rng(8)
    docs, each = 8_000, 20
    term = rng.integers(0, 2_000, (docs, each)) + np.arange(each) * 2_000
    shard = Shard(np.arange(docs), np.full(docs, 40), np.full(docs, each), term.ravel(), np.ones(docs * each, np.uint8), 40.0)
    queries = [(np.sort(term[q * 7]), np.full(each, 1.0)) for q in range(256)]
    tracemalloc.start()
    found = shard.search(queries, 3, np.zeros(256))
    assert tracemalloc.get_traced_memory()[1] < 4 * 256 * docs  # more than 8 bytes a query and document before
    tracemalloc.stop()
    assert [(q, int(doc[0])) for q, doc, _ in found] == [(q, q * 7) for q in range(256)]


def test_documents_that_cannot_reach_the_need_are_not_scored(monkeypatch):
    """Only the documents that four-byte sums find near the k-th score are scored in eight; all of a live block were before."""
    rng = np.random.default_rng(9)
    docs, each = 4_096, 60
    term = np.sort(rng.random((docs, 400)).argsort(1)[:, :each] ** 2 // 400, 1)
    term += np.arange(each) * 1_000
    tf = rng.integers(1, 5, docs * each)
    shard = Shard(np.arange(docs), np.full(docs, 80), np.full(docs, each), term.ravel(), tf, 80.0)
    queries = [(term[q * 11], rng.random(each) + 0.5) for q in range(64)]
    total = np.zeros((64, docs))
    part = (tf * 2.2 / (tf + 1.2)).reshape(docs, each)
    for q, (terms, weights) in enumerate(queries):
        total[q] = np.round(((term == terms) * part * weights).sum(1), 6)
    seen, exact = [], np.einsum
    monkeypatch.setattr(search.np, "einsum", lambda how, x, *more: seen.append(len(x)) or exact(how, x, *more))
    for need in (np.zeros(64), np.sort(total, 1)[:, -10]):
        seen.clear()
        for q, doc, score in shard.search(queries, 10, need):
            order = np.lexsort((np.arange(docs), -total[q]))[:10]
            assert doc.tolist() == order.tolist() and np.abs(score - total[q][order]).max() < 2e-6
    assert 0 < sum(seen) <= 64 * 40


def test_four_byte_sums_lose_no_document():
    """Scores that differ by less than four bytes can tell rank as those in eight do, ties at the need stay."""
    rng = np.random.default_rng(10)
    docs, each = 2_048, 200
    tf = rng.integers(40, 60, docs * each)
    shard = Shard(np.arange(docs)[::-1] * 3, np.full(docs, 9_000), np.full(docs, each), np.tile(np.arange(each), docs), tf, 9_000.0)
    queries = [(np.arange(each), rng.random(each) * 9 + 1) for _ in range(8)]
    part = (tf * 2.2 / (tf + 1.2)).reshape(docs, each)
    for need in (0.0, None):
        for q, (_, weights) in enumerate(queries):
            total = np.round(part @ weights, 6)
            order = np.lexsort((np.arange(docs)[::-1], -total))[:10]
            (_, doc, score), = shard.search([queries[q]], 10, np.array([total[order[-1]] - 1e-6 if need is None else need]))
            assert doc.tolist() == (np.arange(docs)[::-1][order] * 3).tolist() and np.abs(score - total[order]).max() < 2e-6
