"""Exact top-k search by BM25 over an inverted index, pruned by block maxima.

A query is every word of its whole text; equal queries are answered once. Statistics come first: the number of
documents and words, and the document frequency of every term that some query holds, over all rows. The index holds the
postings of the queried terms, cut in shards of documents by a hash of the id.

In a shard documents are numbered in order and fall into blocks; every list of postings has the greatest score of each
block. Queries come in batches. As in block-max WAND, the sum of a query's block maxima bounds every document of a block,
and a block is scored for a query only if that bound reaches the k-th best score so far. What differs is the order: a
query of a whole text has lists that stand in every block, so instead of moving pointers from document to document all
blocks are bounded at once, the most promising ones scored first, unless earlier shards gave a k-th score, and then
those whose bound still reaches the k-th score. The longest lists are dense columns, of which blocks and batches are
matrix products; the others are summed list by list, and their sums' own block maxima make the bound tight. The products
are of four-byte numbers and find the documents that can reach the k-th score; these are scored again in eight bytes.

Shards are searched in rounds, one shard and then ``GROWTH`` times as many as before, each round starting from the k-th
scores of the rounds before. A shard gives only documents that reach them, so the results of a query grow with the
logarithm of the number of shards. Scores use the global statistics, so the best k of all results are exact.

Passes over the texts skip terms by a bitmap of fixed size; it only spares rows, the search decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logweir.llm.scan import U, Words, release, slices
from logweir.llm.tables import cut

K1, B = 1.2, 0.75
DIGITS = 6
BLOCK = 64
BITS = 23
SHARD_DOCS = 32_768
SHARD_WORDS = 8_000_000
DENSE = 256  # longest lists of a shard, kept as columns
BATCH = 256  # queries scored together
FIRST = 4  # blocks of greatest bound, scored before the others by queries without a k-th score yet
LONG = 128  # postings from which a list is copied as a whole
STRIP = 16  # of the other blocks, those scored together
PAIRS = 4_096  # documents and queries scored exactly at once
GROWTH = 8
STEP = 1 << 18  # postings worked on at once
CHUNK = 1 << 16  # postings of one shard in a row of the index
TOGETHER = 64  # queries of a batch whose sums over all documents of a shard are held at once
HELD = 1 << 20  # postings that a task of the index gathers before it makes rows of them
SLACK = 2 * 10**-DIGITS  # scores are rounded, equal ones rank by document
_KINDS = (np.uint8, np.uint16, np.int32, np.int64)


def _counted(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the distinct terms of each row, in order."""
    unique, dense = np.unique(term, return_inverse=True)
    key = np.sort(row * len(unique) + dense)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first] // max(1, len(unique)), unique[key[first] % max(1, len(unique))], np.diff(np.append(first, len(key)))


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"))
            row, term, _ = _counted(words.row, words.hash)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(term.view(np.int64))], ["query_id", "term"])


def _marked(term: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    low = (term & U((1 << BITS) - 1)).astype(np.int64)
    return (bitmap[low >> 6] >> (term & U(63))) & U(1) == 1


def _frequencies(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Documents with each marked term; a null term carries the number of documents and of words."""
    docs = size = 0
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"))
            docs, size = docs + len(batch), size + len(words.hash)
            keep = _marked(words.hash, bitmap)
            _, term, _ = _counted(words.row[keep], words.hash[keep])
            term, n = np.unique(term, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n), pa.nulls(len(n), pa.int64())], ["term", "df", "words"])
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([docs]), pa.array([size])], ["term", "df", "words"])


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Marks of terms, 64 in each number: at most 2**BITS bits to collect and send, however many terms there are."""
    place = F.shiftright(F.col("term").bitwiseAND((1 << BITS) - 1), 6).alias("place")
    words = terms.groupBy(place).agg(F.bit_or(F.expr("shiftleft(1L, int(term & 63))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << BITS - 6, U)
    bitmap[words["place"].to_numpy()] = words["bits"].to_numpy().view(U)
    return bitmap


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in as few bytes as the largest needs."""
    return values.astype(next(kind for kind in _KINDS if values.max(initial=0) <= np.iinfo(kind).max))


def _wide(values: bytes | pa.Buffer, n: int) -> np.ndarray:
    """``n`` numbers packed by ``_narrow``, in place."""
    return np.frombuffer(values, next(kind for kind in _KINDS if np.dtype(kind).itemsize * n == len(memoryview(values))))


def _index(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The marked terms of documents and their times, a row for about ``CHUNK`` postings of one shard.

    A row names its distinct terms once and its postings by their places among these, so a posting takes three bytes
    and its share of the terms instead of the twelve of a term and its times.
    """
    held: list[tuple[np.ndarray, ...]] = []
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"))
            keep = _marked(words.hash, bitmap)
            row, term, times = _counted(words.row[keep], words.hash[keep])
            here, size = np.unique(row, return_counts=True)
            shard, doc = (batch.column(c).to_numpy()[here] for c in ("shard", "doc_id"))
            held.append((shard, doc, np.diff(words.offsets)[here], size, term, _narrow(times)))
            if sum(len(x[4]) for x in held) >= HELD:
                yield from _chunks(held)
                held = []
    yield from _chunks(held)


def _chunks(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    shard, doc, dl, size, term, times = (np.concatenate(x) for x in zip(*held))
    start = np.cumsum(size) - size
    order = np.argsort(shard, kind="stable")
    first = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for rows in np.split(order, first[1:]) if len(order) else ():
        upto = np.cumsum(size[rows])
        for some in np.split(rows, np.flatnonzero(np.diff(upto // CHUNK)) + 1):
            at = _ranges(start[some], size[some])
            known, place = np.unique(term[at], return_inverse=True)
            packed = [doc[some], dl[some].astype(np.int64), _narrow(size[some]), known, _narrow(place), _narrow(times[at])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[some[:1]]), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                ["shard", "docs", "dls", "sizes", "terms", "places", "times"],
            )


def _place_kind(terms: int) -> type:
    return np.uint16 if terms <= 1 << 16 else np.int32


def _batched(rows: pa.Table) -> pa.Table:
    """The queries of one batch in a row: their distinct terms with frequencies, and the places of each one's terms."""
    lists = rows.column("terms").combine_chunks()
    pairs = lists.flatten()
    term, df = pairs.field("term").to_numpy(), pairs.field("df").to_numpy()
    known, first, place = np.unique(term, return_index=True, return_inverse=True)
    sizes = np.diff(lists.offsets.to_numpy())
    packed = [known, _narrow(df[first]), rows.column("query").to_numpy(), sizes.astype(np.int32), place.astype(_place_kind(len(known)))]
    return pa.table({"batch": rows.column("batch").slice(0, 1), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(["terms", "dfs", "queries", "sizes", "places"], packed)}})


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    out = np.repeat(start - np.cumsum(size) + size, size)
    out += np.arange(len(out))
    return out


def _placed(term: list[np.ndarray | tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of some arrays, and the place among them of each array's, one array after the other.

    A pair is the array of its first at the places of its second.
    """
    terms = np.unique(np.concatenate([np.zeros(0, np.int64), *(x[0] if isinstance(x, tuple) else np.unique(x) for x in term)]))
    which = np.empty(sum(len(x[1]) if isinstance(x, tuple) else len(x) for x in term), np.int64)
    at = 0
    for x in term:
        known, place = x if isinstance(x, tuple) else (x, None)
        for k in range(0, len(x if place is None else place), STEP):
            if place is None:
                part = np.searchsorted(terms, known[k : k + STEP])
            else:
                part = np.searchsorted(terms, known)[place[k : k + STEP]]
            which[at : at + len(part)] = part
            at += len(part)
    return terms, which


class Shard:
    """Postings of some documents by term, with block maxima.

    ``term`` is one array or a list of them or of pairs of terms and places, of which no copy is made. Postings are
    sorted as one number each: its term, document and times.
    """

    def __init__(self, doc: np.ndarray, dl: np.ndarray, sizes: np.ndarray, term: np.ndarray | list, tf: np.ndarray, average: float):
        order = np.lexsort((dl, doc))
        order = order[np.append(True, np.diff(doc[order]) != 0)[: len(order)]]
        place = np.full(len(doc), -1, np.int32)
        place[order] = np.arange(len(order))
        self.doc = doc[order]
        self.blocks = -(-len(order) // BLOCK)
        self.terms, which = _placed(term if isinstance(term, list) else [term])
        at = np.repeat(place, sizes)
        if len(order) < len(doc):
            held = at >= 0
            which, tf, at = which[held], tf[held], at[held]
        self.size = np.bincount(which, minlength=len(self.terms))
        self.start = np.cumsum(self.size) - self.size
        at_bits, tf_bits = len(order).bit_length(), int(tf.max(initial=0)).bit_length()
        if len(self.terms).bit_length() + at_bits + tf_bits < 64:
            code = which
            code <<= at_bits
            code |= at
            code <<= tf_bits
            code |= tf
            del at, tf
            code.sort()
        else:  # a text of millions of equal words
            key = np.lexsort((at, which))
            at, tf, code = at[key], tf[key], None
            del key
        del which
        # Each number gives way to its part of a score.
        self.at = np.empty(int(self.size.sum()), np.int32)
        self.part = np.empty(len(self.at)) if code is None else code.view(np.float64)
        norm = K1 * (1 - B + B * dl[order] / average)
        for k in range(0, len(self.at), STEP):
            here = slice(k, k + STEP)
            times = tf[here] if code is None else code[here] & ((1 << tf_bits) - 1)
            self.at[here] = at[here] if code is None else (code[here] >> tf_bits) & ((1 << at_bits) - 1)
            self.part[here] = times * (K1 + 1) / (norm[self.at[here]] + times)
        # The longest lists as columns, with their maxima by block; the others keep only their postings.
        longest = np.argsort(-self.size, kind="stable")[:DENSE]
        self.column = np.full(len(self.terms), -1)
        self.column[longest] = np.arange(len(longest))
        self.columns = np.zeros((self.blocks * BLOCK, len(longest)))
        for c, t in enumerate(longest):
            here = slice(self.start[t], self.start[t] + self.size[t])
            self.columns[self.at[here], c] = self.part[here]
        self.tops = self.columns.reshape(self.blocks, BLOCK, -1).max(1)

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, need: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(query, documents, scores) of the best ``k`` that reach ``need``; a query is its terms and their weights."""
        return [
            (q + at, doc, score)
            for at in range(0, len(queries), TOGETHER)
            for q, doc, score in self._together(queries[at : at + TOGETHER], k, need[at : at + TOGETHER])
        ]

    def _together(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, need: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        weights = np.zeros((self.columns.shape[1], len(queries)))
        rest = np.zeros((len(queries), self.blocks * BLOCK))
        # Places of all terms at once, then the sums of each query.
        which = np.repeat(np.arange(len(queries)), [len(term) for term, _ in queries])
        term, weight = (np.concatenate([np.zeros(0, kind), *(x[i] for x in queries)]) for i, kind in enumerate([np.int64, np.float64]))
        place = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = self.terms[place] == term
        which, place, weight = which[known], place[known], weight[known]
        column = self.column[place]
        dense = column >= 0
        weights[column[dense], which[dense]] = weight[dense]
        which, place, weight = which[~dense], place[~dense], weight[~dense]
        long = self.size[place] > LONG
        order = np.lexsort((~long, which))
        place, weight, long = place[order], weight[order], long[order]
        cuts = np.searchsorted(which, np.arange(len(queries) + 1)).tolist()
        for q, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])):
            at, part = self._lists(place[a:z], int(long[a:z].sum()))
            part *= np.repeat(weight[a:z], self.size[place[a:z]])
            rest[q] = np.bincount(at, part, self.blocks * BLOCK)
        bound = (self.tops @ weights).T + rest.reshape(len(queries), self.blocks, BLOCK).max(2)
        need = need.copy()
        first = np.zeros(bound.shape, bool)
        new = np.flatnonzero(need <= 0)  # the others start from the k-th scores of earlier shards
        if len(new):
            first[new[:, None], np.argpartition(-bound[new], min(FIRST, self.blocks) - 1, 1)[:, :FIRST]] = True
        few = np.zeros(0, np.int64)
        q, at, score = few, few, few.astype(float)
        for chosen, step in ((first, 1), (~first, STRIP)):
            found = [(q, at, score)]
            live = chosen & (bound >= need[:, None] - SLACK) & (bound > 0)
            for block in range(0, self.blocks, step):
                some = np.flatnonzero(live[:, block : block + step].any(1))
                if len(some):
                    found.append(self._reaching(block, min(block + step, self.blocks), some, weights, rest, need, chosen))
            q, at, score = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((at, -score, q))
            q, at, score = q[order], at[order], score[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            need[q[rank == k - 1]] = np.maximum(need[q[rank == k - 1]], score[rank == k - 1])
            q, at, score = q[rank < k], at[rank < k], score[rank < k]
        cuts = np.flatnonzero(np.diff(q, prepend=-1))
        return [(int(x[0]), self.doc[y], z) for x, y, z in zip(*(np.split(x, cuts[1:]) for x in (q, at, score)))] if len(q) else []

    def _lists(self, place: np.ndarray, long: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and parts of some terms' postings, term by term: the first ``long`` lists are copied, the others gathered."""
        start, size = self.start[place], self.size[place]
        whole = [slice(a, z) for a, z in zip(start[:long].tolist(), (start[:long] + size[:long]).tolist())]
        hit = _ranges(start[long:], size[long:])
        return np.concatenate([*(self.at[x] for x in whole), self.at[hit]]), np.concatenate([*(self.part[x] for x in whole), self.part[hit]])

    def _reaching(self, block: int, end: int, live: np.ndarray, weights: np.ndarray, rest: np.ndarray, need: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, place, score) of the documents of some blocks whose scores reach ``need``, of the blocks chosen for each query.

        Sums in four bytes tell which ones can, only these are scored in eight. Nothing is negative, so such a sum is
        off by a share of itself that grows with its number of terms.
        """
        here = slice(block * BLOCK, end * BLOCK)
        near = weights[:, live].T.astype(np.float32) @ self.columns[here].astype(np.float32).T
        near += rest[live, here]
        least = (need[live] - SLACK) * (1 - (len(weights) + 9) * 2.0**-23)
        hit = np.flatnonzero((near >= np.maximum(least, SLACK / 8).astype(np.float32)[:, None]).ravel())
        q, at = live[hit // near.shape[1]], hit % near.shape[1] + here.start
        own = chosen[q, at // BLOCK]
        at, q = at[own], q[own]
        score = rest[q, at]
        for j in range(0, len(q), PAIRS):
            x = slice(j, j + PAIRS)
            score[x] += np.einsum("ij,ji->i", self.columns[at[x]], weights[:, q[x]])
        score = np.round(score, DIGITS)
        good = (score >= need[q]) & (score > 0)
        return q[good], at[good], score[good]


def _postings(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Documents, their words, their numbers of terms, the terms of each row in place, and the times of each posting."""
    docs, dls, sizes, terms, places, times = ([x.as_buffer() for x in rows.column(c)] for c in ("docs", "dls", "sizes", "terms", "places", "times"))
    sizes = [_wide(x, d.size // 8) for x, d in zip(sizes, docs)]
    n = [int(x.sum()) for x in sizes]
    doc, dl = (np.concatenate([np.frombuffer(x, np.int64) for x in column]) for column in (docs, dls))
    terms = [(np.frombuffer(x, np.int64), _wide(p, m)) for x, p, m in zip(terms, places, n)]
    return doc, dl, np.concatenate(sizes), terms, np.concatenate([_wide(x, m) for x, m in zip(times, n)])


def _search(postings: pa.Table, batches: pa.Table, k: int, n: int, average: float) -> pa.Table:
    """Best documents of one shard for some batches."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(postings) and len(batches):
        release()
        doc, dl, sizes, terms, times = _postings(postings)
        shard = Shard(doc, dl, sizes, terms, times, average)
        del terms, times
        for b in range(len(batches)):  # one batch at a time as Python values
            batch = batches.slice(b, 1).select(["terms", "dfs", "queries", "sizes", "places", "needs"]).to_pylist()[0]
            known, ids = (np.frombuffer(batch[c], np.int64) for c in ("terms", "queries"))
            df = _wide(batch["dfs"], len(known)).astype(np.int64)
            length, place = np.frombuffer(batch["sizes"], np.int32), np.frombuffer(batch["places"], _place_kind(len(known)))
            idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
            cuts = np.cumsum(length)[:-1]
            queries = [(known[x], idf[x]) for x in np.split(place, cuts)]
            needs = {x["query"]: x["need"] for x in batch["needs"] or []}
            for q, doc, score in shard.search(queries, k, np.array([needs.get(int(x), 0.0) for x in ids])):
                out.append((np.full(len(doc), ids[q]), doc, score))
    columns = [np.concatenate([np.zeros(0, kind), *(x[i] for x in out)]) for i, kind in enumerate([np.int64, np.int64, np.float64])]
    return pa.table(columns, names=["query", "doc_id", "score"])


def _rounds(shards: int) -> Iterator[tuple[int, int]]:
    """First and last shard of each round."""
    first, count = 0, 1
    while first < shards:
        yield first, min(first + count, shards) - 1
        first, count = first + count, count * GROWTH


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, doc_id, score``: the best ``k`` of ``docs (doc_id, text)`` for each of ``queries``, alike.

    Words are runs of other than space and ``\\t`` to ``\\r``, A-Z lower-cased. A query is the set of the words of its
    whole text. Scores are rounded to six digits; equal scores rank by doc_id; documents without a term of the query
    don't rank. Null, empty and wordless texts count as documents and find nothing. Rows with a null id are left out.
    Repeated rows count in the statistics and rank once, by the shortest of differing texts; a query of several rows is
    the words of all. An empty side gives no rows. Other columns aren't read.
    """
    plain = lambda df: df.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs, queries = plain(docs), plain(queries)
    asked = cut(queries.mapInArrow(_query_terms, "query_id long, term long").distinct(), "asked")
    marks = _bitmap(asked)
    counts = docs.mapInArrow(lambda batches: _frequencies(batches, marks), "term long, df long, words long")
    counts = cut(counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words")), "frequencies")
    totals = counts.where("term IS NULL").first()
    n, words = (totals.df, totals.words) if totals else (0, 0)
    average = max(1.0, words / max(1, n))
    # A query's terms in order; queries of the same terms are one.
    whole = asked.join(counts.where("term IS NOT NULL").select("term", "df"), "term").groupBy("query_id")
    whole = whole.agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("terms"))
    whole = cut(whole.withColumn("query", F.xxhash64("terms.term")), "queries")
    same = whole.select("query_id", "query")
    once = whole.groupBy("query").agg(F.min_by("terms", "query_id").alias("terms"))
    n_batches = same.select("query").distinct().count() // BATCH + 1
    once = once.withColumn("batch", F.pmod(F.xxhash64("query", F.lit(1)), F.lit(n_batches)))
    blobs = "terms binary, dfs binary, queries binary, sizes binary, places binary"
    batches = cut(once.groupBy("batch").applyInArrow(_batched, f"batch long, {blobs}"), "batches")
    shards = max(n // SHARD_DOCS, words // SHARD_WORDS) + 1
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard")
    packed = "shard long, docs binary, dls binary, sizes binary, terms binary, places binary, times binary"
    index = cut(docs.select(shard, "*").mapInArrow(lambda batches: _index(batches, marks), packed), "index")
    best = None
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    for first, last in _rounds(shards):
        # A task takes one shard and some of the batches; the first rounds have few shards, so they are dealt finer.
        parts = n_batches // (4 if first == 0 else 32 if first == 1 else 256) + 1
        part = F.pmod("batch", F.lit(parts))
        if best is None:
            needs = batches.withColumn("needs", F.expr("CAST(NULL AS array<struct<query: bigint, need: double>>)"))
        else:
            kth = best.where(F.col("rank") == k).withColumn("batch", F.pmod(F.xxhash64("query", F.lit(1)), F.lit(n_batches)))
            kth = kth.groupBy("batch").agg(F.collect_list(F.struct("query", F.col("score").alias("need"))).alias("needs"))
            needs = batches.join(kth, "batch", "left")
        routed = needs.select(F.explode(F.expr(f"sequence({first}L, {last}L)")).alias("home"), part.cast("long").alias("slice"), "*")
        held = index.where(F.col("shard").between(first, last)).select("*", F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("part"))
        found = held.groupBy("shard", "part").cogroup(routed.groupBy("home", "slice")).applyInArrow(
            lambda p, q: _search(p, q, k, n, average), "query long, doc_id long, score double"
        )
        found = found if best is None else found.union(best.drop("rank"))
        best = cut(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    return same.join(best, "query").select("query_id", "rank", "doc_id", "score")
