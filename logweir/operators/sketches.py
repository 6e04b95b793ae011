"""Exact results with the help of small mergeable sketches: thinned joins, pruned top-N, frequent items."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, FractionalType, IntegralType

from logweir.operators.joins import broadcast_if_small, is_small, join_on
from logweir.operators.ranking import top_n
from logweir.session import materialise

BLOOM_BITS = 1 << 23
HASHES = 4

RANKS = [0.0, *(1 - 2.0**-j for j in range(1, 10))]
SKETCH_K = 4096
SKETCH_ERROR = 0.002  # of a group's rows; the sketch's own error is about a third of it


# ---- Bloom filter ----


def _comparable(col: Column, own: DataType, other: DataType) -> Column:
    """Values that hash alike where the join would call them equal."""
    if isinstance(own, FractionalType) or isinstance(other, FractionalType):
        return col.cast("double") + F.lit(0.0)
    if isinstance(own, IntegralType) and isinstance(other, IntegralType):
        return col.cast("bigint")
    if own != other:
        raise ValueError(f"keys of types {own.simpleString()} and {other.simpleString()}")
    return col


def _positions(keys: Sequence[Column], bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(bits)) for i in range(hashes)]


def bloom_words(df: DataFrame, keys: Sequence[Column], bits: int = BLOOM_BITS, hashes: int = HASHES) -> DataFrame:
    """One row with the filter of the keys as ``bits / 64`` words in an array.

    Words merge by ``or`` in each task, so at most ``bits / 64`` rows leave it, however many keys there are.
    """
    spark, n = df.sparkSession, bits // 64
    set_bits = df.where(reduce(Column.__and__, (k.isNotNull() for k in keys))).select(F.explode(F.array(*_positions(keys, bits, hashes))).alias("at"))
    mask = F.expr("shiftleft(1L, int(at & 63))")
    words = set_bits.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(mask).alias("mask"))
    zeros = spark.range(0, n, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    whole = zeros.union(words).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"]).alias("words"))


def maybe_in(words: Column, keys: Sequence[Column], bits: int = BLOOM_BITS, hashes: int = HASHES) -> Column:
    """Whether a key can be in the filter; NULL keys aren't."""
    held = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(63).cast("int")) == 1 for p in _positions(keys, bits, hashes)]
    return reduce(Column.__and__, [*(k.isNotNull() for k in keys), *held])


def bloom_join(
    big: DataFrame, small: DataFrame, keys: Sequence[tuple[str, str]], how: str = "inner", bits: int = BLOOM_BITS, hashes: int = HASHES
) -> DataFrame:
    """Join of two large sides; rows of ``big`` that surely have no partner go before they are shuffled.

    For inner and semi joins on pairs of (big, small) columns, where ``small`` has few of the keys of ``big`` but is too
    large to broadcast. A Bloom filter of ``bits`` bits, sent to the tasks that read ``big``, is built from the keys of
    ``small``, whose plan runs twice: cut it first if it is dear. With more keys than bits it lets most rows pass, the
    result is the same. Keys must be of one type, or both numbers.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("a filter needs an inner or left_semi join")
    if bits < 64 or bits % 64:
        raise ValueError("bits must be a multiple of 64")
    types = [(big.schema[a].dataType, small.schema[b].dataType) for a, b in keys]
    left = [_comparable(big[a], x, y) for (a, _), (x, y) in zip(keys, types)]
    right = [_comparable(small[b], y, x) for (_, b), (x, y) in zip(keys, types)]
    words = bloom_words(small, right, bits, hashes).scalar()
    return join_on(big.where(maybe_in(words, left, bits, hashes)), small, keys, how)


# ---- top N by a cutoff ----


def cutoffs(df: DataFrame, by: Sequence[str], value: str, n: int) -> DataFrame:
    """``by``, ``_cut``, ``_total``: a value that about ``2 n`` or more rows of each group reach, NULL for all of it.

    One pass: quantile sketches of bounded size merge in each task and after the shuffle.
    """
    number = F.col(value).cast("double")
    sketch = df.groupBy(*by).agg(F.kll_sketch_agg_double(number, F.lit(SKETCH_K)).alias("_s"), F.count(value).alias("_n"), F.count("*").alias("_total"))
    quantiles = F.kll_sketch_get_quantile_double("_s", F.array(*map(F.lit, RANKS)))
    enough = lambda rank: F.col("_n") * (1 - rank) >= 2 * n + F.col("_n") * SKETCH_ERROR
    place = reduce(lambda rest, j: F.when(enough(RANKS[j]), j).otherwise(rest), range(1, len(RANKS)), F.lit(0))
    # ``place`` is the last rank that leaves enough rows: later ones are tried first.
    return sketch.select(*by, F.when(F.col("_n") > 0, quantiles).alias("_q"), place.alias("_j"), "_total").select(
        *by, F.when(F.col("_j") > 0, F.get("_q", F.col("_j"))).alias("_cut"), "_total"
    )


def pruned_top_n(df: DataFrame, by: Sequence[str], value: str, n: int, then: Sequence[Column] = (), rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows of each group by falling ``value``, ties by ``then``, with their position; for any ``n``.

    A first pass finds a cutoff for each group; rows below it are dropped where they lie, so no task shuffles
    or sorts a whole group. Groups left with fewer rows than they should have are done again in full. Where there
    are too many groups to send their cutoffs to all tasks, none is hot and ``top_n`` does it. NULLs come last.
    """
    order = [F.desc_nulls_last(value), *then]
    cuts = materialise(cutoffs(df, by, value, n), "cutoffs")
    if not is_small(cuts):
        return top_n(df, by, order, n, rank_col)
    names = {c: f"_by_{i}" for i, c in enumerate(by)}
    given = F.broadcast(cuts.select(*(F.col(c).alias(a) for c, a in names.items()), "_cut"))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(a)) for c, a in names.items()))
    above = df.join(given, same).where(F.col("_cut").isNull() | (F.col(value).cast("double") >= F.col("_cut"))).select(*df.columns)
    position = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    first = materialise(above.withColumn(rank_col, position).where(F.col(rank_col) <= n), "top")
    counts = first.groupBy(*(F.col(c).alias(a) for c, a in names.items())).agg(F.count("*").alias("_have"))
    wanted = cuts.join(counts, same, "left").where(F.coalesce("_have", F.lit(0)) < F.least(F.lit(n), "_total"))
    short = materialise(wanted.select(*(F.col(c).alias(a) for c, a in names.items())), "short")
    if short.isEmpty():
        return first
    short = broadcast_if_small(short)
    again = top_n(df.join(short, same, "left_semi"), by, order, n, rank_col)
    return first.join(short, same, "left_anti").unionByName(again)


# ---- frequent items ----


def settled(found: int, least: int | None, k: int, total: int, tracked: int) -> bool:
    """Whether ``found`` candidates, the rarest with ``least`` rows, are surely the best ``k`` of ``total`` rows."""
    return found >= k and least > 7 * total / tracked


def frequent_items(df: DataFrame, col: str, k: int, tracked: int = 10_000) -> DataFrame:
    """The ``k`` most frequent values of ``col`` with their exact ``count``, ties by value; NULLs don't count.

    One pass keeps a sketch of ``tracked`` values in each task, which merge into the candidates; a second one counts
    these alone, so no more than that many rows leave a task. A value that is no candidate has at most
    ``7 / tracked`` of all rows: twice the error of a sketch, 3.5 / tracked, as a value is reported only if it
    surely exceeds the error. If the k-th candidate isn't above that, all values are counted.
    """
    items = df.where(F.col(col).isNotNull()).select(F.col(col).alias("item"))
    sketch = F.expr(f"approx_top_k_accumulate(item, {tracked})").alias("sketch")
    top = F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("top")
    found = materialise(items.agg(F.count("*").alias("total"), sketch).select("total", top), "sketch")
    total = found.first().total
    candidates = found.select(F.explode("top").alias("t")).select(F.col("t.item").alias("item"))
    counts = lambda rows: rows.groupBy("item").agg(F.count("*").alias("count"))
    best = counts(items.join(F.broadcast(candidates), "item", "left_semi")).orderBy(F.desc("count"), "item").limit(k)  # tracked rows at most
    best = materialise(best, "frequent")
    least = best.agg(F.count("*").alias("n"), F.min("count").alias("least")).first()
    if not settled(least.n, least.least, k, total, tracked):
        best = counts(items).orderBy(F.desc("count"), "item").limit(k)
    return best.select(F.col("item").alias(col), "count").orderBy(F.desc("count"), col)
