"""Toxicity on held-out documents, altered insults, and the kernel against its definition."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from logweir.llm.toxicity import _CODE, DECAY, Model, _matrix, toxicity, train, without_toxic

from tests.llm.rows import ODD, clashing, documents, sentence

INSULTS = ["zorgbat", "plimfool", "crudnik"]


def labelled(seed=1, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randrange(5, 60)).split(" ")
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_and_altered_words(spark):
    rows, labels = labelled()
    altered = ["z.o.r.g.b.a.t", "zor-gbat", "plimxfool", "c r u d n i k", "CRUDNIK!!", "»plimfool«"]
    rng = random.Random(9)
    probes = [(1000 + i, f"{sentence(rng, 20)} {w} {sentence(rng, 20)}", "en", "s", 0) for i, w in enumerate(altered)]
    clean = [(2000 + i, sentence(rng, 40), "en", "s", 0) for i in range(40)]
    got = {r.doc_id: r for r in toxicity(documents(spark, [*rows, *probes, *clean]), frame(spark, labels)).collect()}
    held = [(d, t) for d, _, t in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(got[d].held_out for d, _ in held) and sum(r.held_out for r in got.values()) >= len(held)
    assert sum(got[d].predicted == t for d, t in held) / len(held) > 0.97
    assert [got[p[0]].predicted for p in probes] == [1] * len(probes)
    assert sum(got[c[0]].predicted for c in clean) == 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_and_other_columns_are_not_inputs(spark):
    rows, labels = labelled(2, 200)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    moved = [(d, t, "xx", None, -1) for d, t, *_ in rows]
    a, b = (sorted(map(tuple, toxicity(documents(spark, r), frame(spark, x)).collect())) for r, x in ((rows, labels), (moved, flipped)))
    assert a == b


def test_odd_rows_and_labels(spark):
    rows, labels = labelled(3, 200)
    odd = [(None, 1, 1), (5, 1, None), (6, 1, 7), (99999, 1, 1)]
    got = toxicity(clashing(documents(spark, [*rows, *ODD]), "score", "largest", "held_out"), frame(spark, [*labels, *odd])).collect()
    assert len(got) == len(rows) + len(ODD)
    assert {r.predicted for r in got if r.doc_id is None or r.doc_id >= 900} == {0}
    assert [r.held_out for r in got if r.doc_id is None] == [False]


def test_insults_of_a_rarer_language(spark):
    """Few documents in other letters have insults of their own; one common insult must not hide them."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        rare = i % 5 == 0
        words = (sentence(rng, 30).translate(str.maketrans("aeo", "äéö")) if rare else sentence(rng, 30)).split(" ")
        toxic = int(rng.random() < 0.4)
        words += [rng.choice(["grüßwöl", "mérçané"]) if rare else "zorgbat"] * toxic
        rows.append((i, " ".join(words), "xx" if rare else "en", "s", 0))
        labels.append((i, 1, toxic))
    probes = [(1000, f"{sentence(rng, 20)} GRÜSSWÖL grüßwöl", "xx", "s", 0), (1001, f"{sentence(rng, 20)} MÉRÇANÉ", "xx", "s", 0), (1002, f"{sentence(rng, 20)} mâräâné", "xx", "s", 0)]
    got = {r.doc_id: r.predicted for r in toxicity(documents(spark, [*rows, *probes]), frame(spark, labels)).collect()}
    held = [(d, t) for d, _, t in labels if zlib.crc32(str(d).encode()) % 5 == 0 and d % 5 == 0]
    assert {got[d] for d, t in held if t} == {1} and {got[d] for d, t in held if not t} == {0}
    assert [got[d] for d in (1000, 1001, 1002)] == [1, 1, 0]


def test_rare_insults_are_not_cut_by_frequency(spark):
    """Insults in fewer documents than the most frequent words."""
    rows, labels = labelled(6, 300)
    rows = [(d, f"{text} {sentence(random.Random(d), 400)}", *rest) for d, text, *rest in rows]
    model = train(documents(spark, rows).select("doc_id", "text"), frame(spark, labels).select("doc_id", "toxic"), vocabulary=10)
    assert isinstance(model, Model)
    assert min(model.words(_CODE[np.frombuffer(w.encode(), np.uint8)][None, :])[0] for w in INSULTS) > 0.5


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1), (3, 1, 1)]])
def test_one_class_or_none(spark, labels):
    docs = documents(spark, [(i, "some words here", "", "", 0) for i in range(4)])
    got = {r.score for r in toxicity(docs, frame(spark, labels)).collect()}
    assert got == {1.0 if labels and labels[0][2] else 0.0}
    assert toxicity(documents(spark, []), frame(spark, labels)).collect() == []


def test_filter_keeps_columns(spark):
    rows, labels = labelled(4, 300)
    docs = clashing(documents(spark, [*rows, *ODD]), "above", "score")
    kept = without_toxic(docs, frame(spark, labels))
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in toxicity(docs, frame(spark, labels)).where("predicted = 1").collect()}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in [*rows, *ODD] if r[0] not in bad)


def test_kernel_by_definition():
    def value(a, b):
        total = 0.0
        for i in combinations(range(len(a)), 3):
            for j in combinations(range(len(b)), 3):
                if all(a[x] == b[y] for x, y in zip(i, j)) and all(a[x].isalpha() for x in i):
                    total += DECAY ** (i[2] - i[0] + 1 + j[2] - j[0] + 1)
        return total

    for a, b in (("idiot", "i.d.iot"), ("banana", "bandana"), ("abc", "cba"), ("stupid", "stupxid")):
        z = _matrix([a, b])
        assert float(z[0] @ z[1]) == pytest.approx(value(a, b) / np.sqrt(value(a, a) * value(b, b)), abs=1e-5)
