"""Targets against the rule worked out by hand, the mix against its promises."""

from collections import Counter, defaultdict

import pytest
from logweir.llm.mixing import mix, permuted
from pyspark.sql import functions as F

from tests.llm.rows import ODD, clashing, corpus, documents


def targets(sizes, weights=(5, 2, 1), limit=3):
    """The rule as stated: share by weight, stop at the limit, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, done = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in done]
        rest = total - sum(done.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > limit * sizes[s]]
        if not above:
            return {**done, **share}
        done.update({s: float(limit * sizes[s]) for s in above})


def check(spark, rows, near, **options):
    taken = mix(documents(spark, rows), **options).taken().collect()
    assert Counter((r.doc_id, r.size) for r in taken) == Counter((d, len((t or "").split())) for d, t, *_ in rows)
    sizes, took = defaultdict(int), defaultdict(int)
    for r in taken:
        sizes[r.source] += r.size
        took[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = targets(sizes)
    for r in taken:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for source, target in want.items():
        assert abs(took[source] - target) <= near * target + 2 * options.get("block", 64)
    return sorted((r.doc_id is not None, r.doc_id, r.taken) for r in taken)


def test_targets_and_taken(spark):
    rows = [*corpus(7, 90), *ODD]
    first = check(spark, rows, 0.1, block=8, shard=64)
    assert first == check(spark, rows[::-1], 0.1, block=8, shard=64)


def test_limit_and_excess(spark):
    """A small heavy source stops at three times its size, and so does the next one then."""
    rows = [(1, "a " * 40, "", "a", 0), (2, "b " * 90, "", "b", 0), (3, "c " * 3000, "", "c", 0), (4, "d " * 60, "", None, 0), (5, "", "", "e", 0), (6, None, "", "e", 0)]
    check(spark, rows, 0.05, block=4, shard=32)


def test_texts_are_the_taken_words(spark):
    rows = corpus(8, 50)
    mixture = mix(documents(spark, rows), block=8, shard=64, with_text=True)
    slots = mixture.texts().collect()
    assert len({(r.shard, r.slot) for r in slots}) == len(slots) == max(r.shard for r in slots) * 64 + max(r.slot for r in slots if r.shard == max(x.shard for x in slots)) + 1
    assert all(len(r.text.split()) == r.n_words <= 8 for r in slots)
    words = Counter(w for _, t, *_ in rows for w in t.split())
    mixed = Counter(w for r in slots for w in r.text.split())
    assert all(n <= 3 * words[w] for w, n in mixed.items())
    assert sum(mixed.values()) == sum(r.taken for r in mixture.taken().collect())


def test_blocks_are_repeated_only_after_all_were_taken(spark):
    slots = mix(documents(spark, corpus(9, 60)), block=8, shard=64).slots
    for times in slots.groupBy("rank", "block").count().groupBy("rank").agg((F.max("count") - F.min("count")).alias("d")).collect():
        assert times.d <= 1 or times.d is None


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1000])
def test_permutation(spark, n):
    for turn in (0, 1):
        got = spark.range(n).select(F.expr(permuted("id", f"{n}L", "3L", f"{turn}L")).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_empty_repeated_and_clashing(spark):
    assert mix(documents(spark, [])).taken().collect() == []
    assert mix(documents(spark, [(1, None, "", "a", 0)])).taken().collect()[0].asDict() == {
        "doc_id": 1, "source": "a", "size": 0, "source_size": 0, "target": 0.0, "taken": 0,
    }
    df = clashing(documents(spark, [(1, "a b c", "", "s", 0)] * 3), "rank", "start", "size", "pos", "bucket", "target")
    assert [r.size for r in mix(df).taken().collect()] == [3, 3, 3]


def test_no_python_in_the_plan(spark):
    plan = mix(documents(spark, corpus(1, 5))).taken()._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_slots_are_drawn_by_a_plan_of_their_own(spark):
    files = mix(documents(spark, corpus(1, 5)), with_text=True).texts().inputFiles()
    assert any("/slots-" in f for f in files) and not any("/kinds-" in f for f in files)


def test_slots_are_never_broadcast(spark):
    """They come out of few counts, which alone made them look small; nor are the draws, which grow with the shards."""
    taken = mix(documents(spark, [*corpus(11, 90), *ODD]), block=4, shard=32).taken()
    taken.collect()
    plan = taken._jdf.queryExecution().executedPlan().toString()
    joins = [line.split("Join", 1)[1] for line in plan.splitlines() if "Join " in line]
    assert "isFinalPlan=true" in plan and any("block#" in x for x in joins) and any("cell#" in x for x in joins)
    assert not any("Join" in line and "Broadcast" in line and "block#" in line for line in plan.splitlines())
    assert all("BuildRight" in x for x in joins if "cell#" in x)
