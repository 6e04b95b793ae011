"""Operators that are exact with the help of sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logweir.functions.text import WHITESPACE
from logweir.operators import bloom_join, explode_tokens, frequent_items, pruned_top_n
from logweir.queries.registry import Tables, query


@query(
    """
    SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderpriority = '1-URGENT' AND o_custkey % 10 = 0
    """
)
def join_bloom(t: Tables) -> DataFrame:
    few = t.orders.where("o_orderpriority = '1-URGENT' AND o_custkey % 10 = 0").select("o_orderkey", "o_totalprice")
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    return bloom_join(lines, few, [("l_orderkey", "o_orderkey")], bits=1 << 20).drop("o_orderkey")


@query(
    """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS rank
      FROM lineitem) WHERE rank <= 1500
    """
)
def topn_pruned(t: Tables) -> DataFrame:
    """Beyond what Spark limits in each task by itself."""
    lines = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return pruned_top_n(lines, ["l_returnflag"], "l_extendedprice", 1500, [F.asc("l_orderkey"), F.asc("l_linenumber")])


@query(
    r"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest(string_split_regex(rtrim(text, E' \t\n\r\f\x0B'), '\s+')) AS word FROM documents)
    GROUP BY word ORDER BY 2 DESC, 1 LIMIT 20
    """
)
def frequent_words(t: Tables) -> DataFrame:
    return frequent_items(explode_tokens(t.documents.select("text"), "text", WHITESPACE), "word", 20)


@query(
    """
    SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50
    """
)
def frequent_parts(t: Tables) -> DataFrame:
    """Parts are ordered alike often, so the sketch decides nothing and all are counted."""
    return frequent_items(t.lineitem.select("l_partkey"), "l_partkey", 50, tracked=512)
