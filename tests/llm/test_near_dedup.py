"""Near-duplicate documents against all pairs."""

import re

import pytest
from logweir.llm.graph import components
from logweir.llm.near_dedup import near_duplicates

from tests.llm.rows import ODD, clashing, corpus, documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = {d: shingles(t) for d, t, *_ in rows if d is not None}
    low = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return {d: (len(sets[d]), low[d], low[d] == d) for d in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()}


def test_all_pairs(spark):
    rows = [*corpus(3, 80), *ODD]
    assert result(documents(spark, rows)) == brute(rows)


def test_chain_and_family(spark):
    """Copies that drift apart are linked through those between; heavily edited ones only to light ones."""
    import random

    rng = random.Random(5)
    words = sentence(rng, 60).split(" ")
    rows = [(1000, " ".join(words), "", "", 0)]
    drift = list(words)
    for i in range(1, 9):
        drift[i * 6] = f"new{i}"
        rows.append((1000 - i, " ".join(drift), "", "", 0))
    for i in range(40):
        other = list(words)
        for k in rng.sample(range(60), rng.randrange(1, 5)):
            other[k] = f"own{i}x{k}"
        rows.append((2000 + i, " ".join(other), "", "", 0))
    assert result(documents(spark, rows)) == brute(rows)


def test_repeated_rows_and_extra_columns(spark):
    rows = [(5, "a b c d e f", "", "", 0)] * 3 + [(4, "A b  c d e F", "", "", 0)]
    df = clashing(documents(spark, rows), "key", "n", "c", "rep", "component_id", "set_a")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == [(4, 2, 4, True)] + [(5, 2, 4, False)] * 3


def test_empty(spark):
    assert result(documents(spark, [])) == {}


@pytest.mark.parametrize("n", [1, 2, 37])
def test_components_of_chains(spark, n):
    edges = [(i + 1, i) for i in range(n)] + [(100, 100), (None, 3), (200, 201), (201, 200)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(n + 1)} | {(200, 200), (201, 200)}


def test_rounds_run_few_jobs(spark):
    """Every stage of a job takes a block of four MB of the driver: a round has one job for its writing, no broadcasts."""
    spark.sparkContext.setJobGroup("rounds", "components of a chain")
    try:
        edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long")
        assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(41)}
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")) <= 50  # 62 with marks apart and broadcasts
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
