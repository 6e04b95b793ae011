"""Language identification: kernels against sets, folded weights against the kernel form, held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest
from logweir.llm import languages
from logweir.llm.languages import Landmarks, Model, language, products, ridge, spectra, spectrum
from logweir.llm.queries import QUERIES

from tests.llm.rows import ODD, clashing, documents

FOLDER = "/root/testdata/sf0.01"
SYLLABLES = {"aa": "ka lo mi tu re".split(), "bb": "scht eng ung ber lich".split(), "cc": "oix eau ment ère ç".split()}


def grams(text):
    text = f" {' '.join(re.findall(r'[^\W\d_]+', text.lower()))} "
    return {text[i : i + n] for n in range(1, 5) for i in range(len(text) - n + 1)}


def text_of(rng, name, n):
    return " ".join("".join(rng.choices(SYLLABLES[name], k=rng.randrange(1, 4))) for _ in range(n))


def labelled(n=240, seed=1):
    rng = random.Random(seed)
    names = sorted(SYLLABLES)
    return [(i, text_of(rng, names[i % 3], rng.choice([4, 30, 200])), names[i % 3], "s", 1) for i in range(n)]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_spectra_are_the_sets_of_n_grams():
    texts = ["", "a", "Ab, ab!", "Größe 12 GRÖSSE_x", "  x  ", "één été", None, "12"]
    for text, own in zip(texts, spectra(pa.array(texts))):
        assert len(own) == len(grams(text or ""))


def test_kernel_counts_shared_n_grams():
    rng = random.Random(3)
    texts = [text_of(rng, n, 20) for n in "aa bb cc aa".split()]
    own = list(spectra(pa.array(texts)))
    vocabulary = np.unique(np.concatenate(own[:2]))
    marks = np.stack([np.isin(vocabulary, o) / np.sqrt(len(o)) for o in own[:2]]).astype(np.float32)
    found = products(pa.array(texts), vocabulary, marks.T)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:2]):
            assert found[i, j] == pytest.approx(len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b))), rel=1e-5)


def test_pieces_and_batches_change_nothing(monkeypatch):
    text = text_of(random.Random(5), "cc", 300)
    whole = spectrum(text)
    vocabulary, weights = whole[::2], np.random.default_rng(1).random((len(whole[::2]), 3))
    texts = pa.array([text, "eau", "", text * 2])
    scores = products(texts, vocabulary, weights)
    monkeypatch.setattr(languages, "PIECE", 7)
    monkeypatch.setattr(languages, "CELLS", 1)
    assert np.array_equal(spectrum(text), whole)
    assert products(texts, vocabulary, weights) == pytest.approx(scores)


def test_folded_weights_are_the_kernel_machine():
    rng = random.Random(7)
    names = ["aa", "bb", "cc"] * 20
    texts = pa.array([text_of(rng, n, 30) for n in names])
    own = list(spectra(texts))
    landmarks = Landmarks.of(own[:12])
    kernel = lambda a, b: len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b))
    features = np.array([[kernel(a, b) for b in own[:12]] for a in own]) @ landmarks.root
    # Nyström features of the landmarks themselves give their kernel back.
    assert features[:12] @ features[:12].T == pytest.approx(np.array([[kernel(a, b) for b in own[:12]] for a in own[:12]]), abs=1e-4)
    of = np.array([sorted(SYLLABLES).index(n) for n in names])
    w, bias = ridge(features, of, 3, 0.1)
    model = Model(sorted(SYLLABLES), landmarks.vocabulary, landmarks.matrix.T @ (landmarks.root @ w), bias)
    folded = products(texts, model.vocabulary, model.weights) + bias
    assert folded == pytest.approx(features @ w + bias, abs=1e-4)
    assert (model.predict(texts)[0] == of).all()


def test_held_out_accuracy_of_the_whole_table(spark):
    out = {r.doc_id: r for r in QUERIES["op12_language_id"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()
    assert len(out) == len(rows) and all(out[d].held_out == held_out(d) for d, _ in rows)
    for name in {x for _, x in rows}:
        own = [out[d].lang_pred == name for d, x in rows if x == name and held_out(d)]
        assert np.mean(own) >= 0.95
    assert all(0 <= r.score <= 1 for r in out.values())


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = labelled()
    wrong = [(i, t, "zz" if held_out(i) else x, s, n) for i, t, x, s, n in rows]
    read = lambda rows: sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in language(documents(spark, rows)).collect())
    found = read(rows)
    assert found == read(wrong)
    truth = {r[0]: r[2] for r in rows}
    assert np.mean([truth[i] == x for i, x, _ in found if held_out(i)]) == 1


def test_bounds_of_the_sample(spark):
    rows = labelled(600)
    small = language(documents(spark, rows), rows_per_language=20, max_rows=45, max_landmarks=6).collect()
    truth = {r[0]: r[2] for r in rows}
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in small if r.held_out]) > 0.95


def test_odd_rows(spark):
    rows = labelled() + ODD + [(950, "12 + 13 = 25 !", "aa", "s", 1), (951, text_of(random.Random(2), "bb", 9), None, "s", 1)]
    out = language(clashing(documents(spark, rows), "rank", "known", "grams", "lang_pred", "score", "place", "kernel")).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    for i in (900, 901, 902, 950):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[951].lang_pred == "bb" and by_id[904].lang_pred != "und"
    assert by_id[None].held_out is False
    assert {r.held_out for r in out if r.doc_id == 905} == {held_out(905)}


@pytest.mark.parametrize("lang", [None, "aa"])
def test_one_language_or_none(spark, lang):
    rows = [(i, "ka lo mi", lang, "s", 1) for i in range(1, 30)]
    out = {(r.lang_pred, r.score) for r in language(documents(spark, rows)).collect()}
    assert out == {("und", 0.0)} if lang is None else {("aa", 1.0)}


def test_empty(spark):
    out = language(documents(spark, []))
    assert out.count() == 0 and out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    letterless = spark.createDataFrame([(1, "12", "aa")], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language(letterless).select("doc_id", F.col("held_out"), "lang_pred", "score").collect()] == [("und", 0.0)]
