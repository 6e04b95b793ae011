"""Mixing sources to target weights, in DataFrame functions only.

Each source's documents are packed head to tail and cut in blocks of ``block`` words. The output is a row of shards
of ``shard`` slots. A shard draws how many of its slots each source gets: the whole part of its expected number for
sure, the remaining slots by a multinomial draw over the fractions left. The slots of a source are numbered through
all shards; number j takes, in the source's pass j div n over its n blocks, the block that a pseudorandom
permutation of that pass gives for j mod n. So a block is taken again only when all have been, and slots meet blocks
by an equi-join on (source, block).

The permutation is a swap-or-not shuffle: in each round an index and its mirror about a round key change places, or
not, by one bit that both share. It needs no table and no sort, at any n. All numbers come from a multiplicative
generator on whole numbers, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from logweir.llm.tables import cut

WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 8
FEW = 5_000  # sources at most whose cells are broadcast
_M = 2147483647
_UNIT = 1_000_000_000


def number(*parts: str) -> str:
    """SQL for a pseudorandom whole number below 2**31 - 1 from whole numbers that aren't negative."""
    out = "1"
    for part in parts:
        out = f"(({out} * 48271 + ({part}) % {_M} + 11) % {_M})"
    return f"(({out} * 69621) % {_M} * 16807 % {_M})"


def permuted(index: str, n: str, key: str, turn: str) -> str:
    """SQL for the place of ``index`` in a permutation of 0 to n-1 that ``key`` and ``turn`` pick."""
    centre = f"((({number(key, turn, 'r', '1')} * 2147483648 + {number(key, turn, 'r', '2')}) % {n} + {n} - acc) % {n})"
    swapped = f"CASE WHEN {number(key, turn, 'r', f'greatest(acc, {centre})')} div 64 % 2 = 1 THEN {centre} ELSE acc END"
    return f"aggregate(sequence(0L, {ROUNDS - 1}L), {index}, (acc, r) -> {swapped})"


def earlier_sum(df: DataFrame, key: str, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of ``key`` before each, by ``group`` and then ``order``.

    Windows run inside (key, group) and over the sums of the groups, so a key with most rows is no single task.
    """
    rows = Window.partitionBy(key, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    groups = Window.partitionBy(key).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(key, group).agg(F.sum(value).alias("_sum"))
    sums = sums.select(key, group, F.coalesce(F.sum("_sum").over(groups), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum(value).over(rows), F.lit(0))
    return df.withColumn(name, inside).join(sums, [key, group]).withColumn(name, F.col(name) + F.col("_before")).drop("_before")


def words(text: str = "text") -> Column:
    """Number of words of a text, null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3) -> DataFrame:
    """Target words of each source, from rows ``(source, size)``: ``rank, source, source_size, n_docs, target``.

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes; a target stops
    at ``limit`` times the source's size and the excess goes to the others by weight, until none is above. Every
    source has one row here, so this table grows with the number of sources only.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("long")
    ranked = sources.withColumn("rank", rank)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("double")).withColumn("top", F.col("source_size") * F.lit(float(limit)))
    # In the order in which targets reach their limit; once one keeps below it, all later ones do.
    by = Window.orderBy(F.col("top") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    filled = (
        ranked.withColumn("order", F.row_number().over(by))
        .withColumn("left", left)
        .withColumn("rest", F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("below", F.col("left") * F.col("weight") <= F.col("top") * F.col("rest"))
        .withColumn("cut", F.min(F.when(F.col("below"), F.struct("order", "left", "rest"))).over(everything))
    )
    share = F.col("cut.left") * F.col("weight") / F.col("cut.rest")
    target = F.when(F.col("order") >= F.col("cut.order"), share).otherwise(F.col("top"))
    return filled.select("rank", "source", "source_size", "n_docs", target.alias("target"))


@dataclass
class Mixture:
    """``sources``; ``docs``: rows of the documents with place in their source; ``slots``: (shard, slot, rank, block)."""

    sources: DataFrame
    docs: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """The part of each document in each block it touches; a document without words has one row without block."""
        b = self.block
        last = F.expr(f"(start + size - 1) div {b}")
        spread = self.docs.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(F.expr(f"start div {b}"), last))))
        return spread.withColumn("skip", F.greatest(F.lit(0), F.col("block") * b - F.col("start"))).withColumn(
            "n", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b) - F.col("start") - F.col("skip")
        )

    def taken(self) -> DataFrame:
        """Every document with ``source_size, target, taken``.

        The slots come out of few counts, by whose size Spark would take the blocks for a side to broadcast: they never are.
        """
        times = self.slots.groupBy("rank", "block").agg(F.count("*").alias("times")).hint("merge")
        counted = self.pieces().select("rank", "bucket", "pos", "doc_id", "size", "block", "n").join(times, ["rank", "block"], "left")
        per_doc = counted.groupBy("rank", "bucket", "pos", "doc_id", "size").agg(
            F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0)).alias("taken")
        )
        return per_doc.join(self.sources.select("rank", "source", "source_size", "target"), "rank").select(
            "doc_id", "source", "size", "source_size", "target", "taken"
        )

    def texts(self) -> DataFrame:
        """The mix itself, a row for each slot: ``shard, slot, source, block, doc_ids, n_words, text``.

        The slots are drawn by a plan of their own: adaptive execution plans all of a plan anew after each stage, so
        one plan of both would keep the driver busy with the drawing while texts are joined.
        """
        piece = F.struct("start", "skip", "doc_id", "n", F.expr("array_join(slice(words, int(skip) + 1, int(n)), ' ')").alias("part"))
        pieces = self.pieces().where("block IS NOT NULL").select("rank", "block", piece.alias("piece"))
        packed = pieces.groupBy("rank", "block").agg(F.sort_array(F.collect_list("piece")).alias("piece"))
        return (
            packed.join(cut(self.slots, "slots"), ["rank", "block"])
            .join(self.sources.select("rank", "source"), "rank")
            .select(
                "shard", "slot", "source", "block", F.col("piece.doc_id").alias("doc_ids"),
                F.expr("aggregate(piece.n, 0L, (a, x) -> a + x)").alias("n_words"), F.array_join("piece.part", " ").alias("text"),
            )
        )


def draw_slots(sources: DataFrame, block: int, shard: int, limit: int) -> DataFrame:
    """``(shard, slot, rank, block)`` of the mix."""
    everything = Window.partitionBy()
    wanted = (
        sources.where("source_size > 0")
        .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
        .withColumn("want", F.col("target") * F.col("blocks") / F.col("source_size"))
        .withColumn("all", F.sum("want").over(everything))
        .withColumn("slots", F.greatest(F.lit(1), F.round("all")).cast("long"))
        .withColumn("shards", F.expr(f"(slots + {shard - 1}) div {shard}"))
        .withColumn("m", F.count("*").over(everything))
    )
    # Shards before the last are full and share their expected numbers; kind 1 is the last one.
    full = f"struct(0L AS kind, 0L AS low, shards - 1 AS high, {shard}L AS width)"
    final = f"struct(1L AS kind, shards - 1 AS low, shards AS high, slots - (shards - 1) * {shard} AS width)"
    kinds = wanted.withColumn("k", F.explode(F.expr(f"array({full}, {final})"))).select("rank", "blocks", "want", "all", "m", "k.*")
    kind = Window.partitionBy("kind")
    expected = F.col("want") / F.col("all") * F.col("width")
    kinds = (
        kinds.where("high > low")
        .withColumn("base", F.floor(expected))
        .withColumn("part", F.floor((expected - F.col("base")) * _UNIT) + 1)
        .withColumn("draws", F.greatest(F.lit(0), F.col("width") - F.sum("base").over(kind)))
        .withColumn("to", F.sum("part").over(kind.orderBy("rank")))
        .withColumn("from", F.col("to") - F.col("part"))
        .withColumn("parts", F.sum("part").over(kind))
        .withColumn("least", F.col("rank") == F.min("rank").over(kind))
    )
    kinds = cut(kinds, "kinds")
    sure = kinds.withColumn("shard", F.explode(F.expr("sequence(low, high - 1)"))).select("rank", "shard", F.col("base").alias("c"), "blocks")
    # A draw looks up its source in intervals kept by m equal cells, so each draw meets about two intervals.
    cells = kinds.withColumn("cell", F.explode(F.expr("sequence(from * m div parts, (to - 1) * m div parts)")))
    draws = kinds.where("least AND draws > 0").withColumn("shard", F.explode(F.expr("sequence(low, high - 1)")))
    draws = draws.withColumn("draw", F.explode(F.expr("sequence(0L, draws - 1)")))
    u = f"({number('shard', 'draw', '3')} * 2147483648 + {number('shard', 'draw', '4')}) % parts"
    draws = draws.withColumn("u", F.expr(u)).select("kind", "shard", "u", F.expr("u * m div parts").alias("cell"))
    # Cells grow with the sources only; draws, which look smaller to Spark, with the shards.
    wanted_words, m = sources.agg(F.sum("target"), F.count("*")).first()
    cells = cells.select("kind", "cell", "rank", "from", "to", "blocks").hint("broadcast" if m <= FEW else "merge")
    drawn = draws.join(cells, ["kind", "cell"]).where("u >= from AND u < to")
    counts = sure.union(drawn.select("rank", "shard", F.lit(1).cast("long").alias("c"), "blocks"))
    counts = counts.groupBy("rank", "shard").agg(F.sum("c").alias("c"), F.min("blocks").alias("blocks"))
    counts = counts.where("c > 0").withColumn("run", F.expr("shard div 1024"))
    counts = earlier_sum(counts, "rank", "run", ["shard"], "c", "first")
    # The counts are few but each becomes many slots: spread them by what they become, not by what they are.
    tasks = int(wanted_words or 0) // (block * 50_000) + 1
    counts = counts.repartition(tasks, "shard")
    in_shard = Window.partitionBy("shard").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("lead", F.coalesce(F.sum("c").over(in_shard), F.lit(0)))
    counts = counts.withColumn("width", F.sum("c").over(Window.partitionBy("shard")))
    slots = counts.withColumn("i", F.explode(F.expr("sequence(0L, c - 1)"))).withColumn("j", F.col("first") + F.col("i"))
    slots = slots.where(F.col("j") < F.col("blocks") * limit)
    return slots.select(
        "shard",
        F.expr(permuted("lead + i", "width", "shard", "5")).alias("slot"),
        "rank",
        F.expr(permuted("j % blocks", "blocks", "rank", "j div blocks")).alias("block"),
    )


def mix(docs: DataFrame, block: int = 64, shard: int = 4096, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, with_text: bool = False) -> Mixture:
    """The mixture of ``docs (doc_id, source, text)``.

    Null sources are one source, the last. Null, empty and blank texts have no words and are never taken. Repeated
    rows are rows of their own; null ids are kept. No document is taken more than ``limit`` times. Without any word
    there are no slots and all targets are 0. Other columns aren't read. An empty table gives empty tables.
    """
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    sized = rows.select("doc_id", "source", words().alias("size"))
    if not with_text:
        sized = cut(sized, "sized")
    sources = cut(targets(sized, weights, limit), "sources")
    if with_text:
        split = F.coalesce(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
        sized = rows.select("doc_id", "source", split.alias("words")).withColumn("size", F.size("words").cast("long"))
    ranked = sized.join(sources.select("rank", "n_docs", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    # Packing order: hashed groups of about 4096 documents, by id inside a group.
    ranked = ranked.withColumn("bucket", F.expr(f"{number('coalesce(doc_id & 9223372036854775807, 0L)')} % (n_docs div 4096 + 1)")).drop("n_docs")
    order = ["doc_id", "size"]
    placed = earlier_sum(ranked, "rank", "bucket", order, "size", "start")
    placed = placed.withColumn("pos", F.row_number().over(Window.partitionBy("rank", "bucket").orderBy(*order)))
    return Mixture(sources, placed, draw_slots(sources, block, shard, limit), block)
