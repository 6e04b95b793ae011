"""Near-duplicate documents by one-permutation MinHash.

A document's distinct word shingles are hashed once; the hash range is cut in bins and each bin keeps its least
value. Empty bins copy a filled bin, chosen by a fixed random order of the bins that belongs to the empty one, which
is the optimal densification: every filled bin is equally likely and two sets choose alike. Rows of bins form bands.
Equal sets collapse to one representative first. In each band bucket every representative is joined to the smallest
only (a star); stars are confirmed on full sets and tied to components. Buckets that still hold several components
are tried again with another centre, the member with most shingles that other components have too, and in the end get
the pairs between components that an exact bound on the intersection doesn't rule out. So a star whose centre is alike
to nobody loses no link, and a passage that thousands share doesn't give thousands squared pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logweir.llm.graph import components
from logweir.llm.scan import U, Words, mix, shingles, slices
from logweir.llm.tables import cut

BANDS, ROWS = 32, 4
CLASSES = 64
_BINS = BANDS * ROWS
_EMPTY = U(0xFFFFFFFFFFFFFFFF)
# For each bin, the order in which it looks for a filled one.
_ORDER = np.argsort(mix(np.arange(_BINS * _BINS, dtype=U) + U(0x5851F42D4C957F2D)).reshape(_BINS, _BINS), axis=1)
_ROW_KEYS = mix(np.arange(1, ROWS + 1, dtype=U)) | U(1)
_BAND_KEYS = mix(np.arange(1000, 1000 + BANDS, dtype=U))

_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One bucket key for each band, from the sorted distinct hashes of a set that isn't empty."""
    bins = ((hashes >> U(32)) * U(_BINS)) >> U(32)
    first = np.flatnonzero(np.diff(bins, prepend=U(_BINS)))
    least = np.full(_BINS, _EMPTY)
    least[bins[first].astype(np.int64)] = hashes[first]
    filled = least != _EMPTY
    if len(first) < _BINS:
        donor = _ORDER[np.arange(_BINS), filled[_ORDER].argmax(axis=1)]
        least = np.where(filled, least, least[donor])
    return mix((least.reshape(BANDS, ROWS) * _ROW_KEYS).sum(axis=1, dtype=U) + _BAND_KEYS)


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            n, a, b, bands = [], [], [], []
            for s in shingles(Words(batch.column("text")), size):
                n.append(len(s))
                a.append(mix(s).sum(dtype=U))
                b.append(mix(s ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U))
                bands.append(band_keys(s).view(np.int64) if len(s) else None)
            as_long = lambda x: pa.array(np.array(x, U).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), as_long(a), as_long(b), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )


def _confirm(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those whose full sets are alike enough."""
    for whole in batches:
        for batch in slices(whole, "text_b"):
            keep, last, left = [], None, None
            ids, texts = batch.column("a").to_pylist(), batch.column("text_a")
            for i, right in enumerate(shingles(Words(batch.column("text_b")), size)):
                if last != ids[i]:
                    last, left = ids[i], next(shingles(Words(texts.slice(i, 1)), size))
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` among candidate pairs, each pair with both whole texts."""
    right = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        lambda batches: _confirm(batches, size, percent), "a long, b long"
    )


def _spread(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = list(shingles(Words(batch.column("text")), size))
            n = [len(s) for s in sets]
            ids, c = (pa.array(np.repeat(batch.column(x).to_numpy(), n)) for x in ("doc_id", "c"))
            yield pa.RecordBatch.from_arrays([ids, c, pa.array(np.concatenate(sets).view(np.int64))], ["doc_id", "c", "shingle"])


def _bounds(unsure: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``(doc_id, slack, shared)`` of open documents: what bounds the intersection of two of different components.

    Only shingles that another component has too can be in both sets. ``shared`` counts these in ``CLASSES`` classes
    by hash: the intersection is at most the sum of the lesser counts, and a link needs
    (100 + percent) * intersection >= percent * (n + m). ``slack`` is what is left of that for one document alone.
    """
    docs = unsure.select("doc_id", "n", "c").distinct()
    own = texts.join(docs.select("doc_id", "c"), "doc_id").mapInArrow(
        lambda batches: _spread(batches, size), "doc_id long, c long, shingle long"
    )
    common = own.groupBy("shingle").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    shared = own.join(common.select("shingle"), "shingle", "left_semi")
    counts = [F.sum(F.when(F.col("shingle").bitwiseAND(CLASSES - 1) == k, 1).otherwise(0)) for k in range(CLASSES)]
    counts = shared.groupBy("doc_id").agg(F.array(*counts).cast("array<int>").alias("shared"), F.count("*").alias("total"))
    return docs.join(counts, "doc_id").select("doc_id", (F.col("total") * (100 + percent) - F.col("n") * percent).alias("slack"), "shared")


def _linkable(unsure: DataFrame, percent: int) -> DataFrame:
    """Rows that may link to some other component of their bucket, with the member of one with most slack."""
    entry = F.struct("slack", "c", "doc_id", "n")
    best = unsure.groupBy("key").agg(F.max(entry).alias("best"))
    ranked = unsure.join(best, "key")
    second = ranked.where("c <> best.c").groupBy("key").agg(F.max(entry).alias("second"))
    other = F.when(F.col("c") != F.col("best.c"), F.col("best")).otherwise(F.col("second"))
    possible = f"slack * 100 >= n * {percent * percent} AND other.slack >= n * {percent}"
    return ranked.join(second, "key").withColumn("other", other).where(possible).drop("best", "second")


def _pairs(alive: DataFrame, percent: int) -> DataFrame:
    """The pairs of a bucket's components that the bounds don't rule out."""
    left = alive.select("key", F.col("doc_id").alias("a"), "n", "c", "slack", "shared")
    right = alive.select("key", F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("c").alias("d"), F.col("slack").alias("room"), F.col("shared").alias("others"))
    most = "aggregate(zip_with(shared, others, (x, y) -> least(x, y)), 0L, (s, x) -> s + x)"
    return left.join(right, "key").where(
        f"a < b AND c <> d AND slack >= m * {percent} AND room >= n * {percent} AND {most} * {100 + percent} >= (n + m) * {percent}"
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``.

    Words are lower-cased in A-Z only; fewer than ``size`` words make one shingle. Documents are linked when
    100 * intersection >= ``percent`` * union of their shingle sets; ``component_id`` is the smallest document
    reachable and ``kept`` marks it. A null, empty or blank text has no shingles and no links. Rows with a null id
    are left out, repeated rows give a row each. Other columns of ``docs`` aren't read. An empty table gives no rows.
    """
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut(texts.mapInArrow(lambda batches: _sign(batches, size), _SIGNED), "signed")
    content = ["n_shingles", "set_a", "set_b"]
    sets = signed.where("n_shingles > 0").groupBy(*content).agg(F.min("doc_id").alias("rep"))
    member = signed.drop("bands").join(sets, content, "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")
    )
    reps = signed.where("n_shingles > 0").join(
        sets.select(*content, F.col("rep").alias("doc_id")), [*content, "doc_id"], "left_semi"
    )
    buckets = reps.select("doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z")
    crowded = cut(buckets.join(shared.select("key", "a"), "key"), "buckets")
    sizes = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    centre = crowded.where("doc_id = a").select("key", F.col("n").alias("m"))
    stars = crowded.where("doc_id > a").join(centre, "key").where(sizes)
    tried = cut(stars.select("a", F.col("doc_id").alias("b")).distinct(), "stars")
    links = cut(confirmed(tried, texts, size, percent), "links")
    tied = cut(components(links), "tied")
    # What the stars left open: buckets with several components.
    placed = crowded.drop("a").join(tied, F.col("doc_id") == F.col("node"), "left").select(
        "key", "doc_id", "n", F.coalesce("component", "doc_id").alias("c")
    )
    mixed = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    unsure = cut(placed.join(mixed.select("key"), "key", "left_semi"), "open")
    if not unsure.isEmpty():
        bounds = cut(_bounds(unsure, texts, size, percent), "bounds")
        unsure = cut(unsure.join(bounds.select("doc_id", "slack"), "doc_id"), "open")
        for every in (False, True):
            alive = _linkable(unsure, percent)
            pairs = _pairs(alive.drop("other").join(bounds.select("doc_id", "shared"), "doc_id"), percent) if every else alive.select("key", F.col("doc_id").alias("a"), F.col("other.doc_id").alias("b"), "n", F.col("other.n").alias("m")).where(sizes)
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            fresh = cut(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
            more = cut(confirmed(fresh, texts, size, percent), "links")
            if not more.isEmpty():
                tried = tried.union(fresh)
                tied = cut(components(more, tied), "tied")
                unsure = unsure.join(tied, F.col("doc_id") == F.col("node"), "left").withColumn("c", F.coalesce("component", "doc_id")).drop("node", "component")
    return (
        member.join(tied, F.col("rep") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
