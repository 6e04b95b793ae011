"""Language of whole texts by a string kernel: blended-spectrum presence kernel, Nyström landmarks, kernel ridge.

A text is the set of its n-grams of one to four letters, everything that is no letter being one space. Two texts are
alike by the number of n-grams they share, over the root of the product of their numbers. Landmarks are texts of a
labelled sample; a text's features are its kernel values with them times the inverse root of the landmarks' own kernel
matrix (Nyström). One ridge regression for each language against the rest gives weights of the features, and as the
kernel is a product of sets, these fold into one weight for each n-gram of a landmark and language. So a batch of
texts is scored by one product of its presence matrix with these weights.

Training takes at most ``rows_per_language`` labelled documents of a language and ``max_rows`` in all, evenly by
language, in an order by hash of the id; at most ``max_landmarks`` of them are landmarks. Every row is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from logweir.llm.scan import U, mix, slices
from logweir.llm.tables import cut
from logweir.operators.joins import broadcast_if_small

LONGEST = 4
UNKNOWN = "und"
PIECE = 200_000  # code points whose n-grams are made at once
CELLS = 4_000_000  # entries of a presence matrix
_STEPS = [U(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def spectrum(text: str) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of one to ``LONGEST`` code points."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(U)
    found = []
    for start in range(0, len(points), PIECE):
        part = points[start : start + PIECE + LONGEST - 1]
        hashed = np.zeros(len(part), U)
        grams = []
        for n in range(min(LONGEST, len(part))):
            size = len(part) - n
            hashed = mix(hashed[:size] + (part[n:] + U(1)) * _STEPS[n])
            grams.append(hashed)
        found.append(np.unique(np.concatenate(grams)))
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0] if found else np.zeros(0, U)


def spectra(texts: pa.Array) -> Iterator[np.ndarray]:
    """Spectrum of each text, lower-cased, with one space for all that lies between letters and at its ends."""
    texts = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}]+", " ")
    for text in texts:
        yield spectrum(f" {text.as_py().strip()} ")


def presence(grams: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    """A row for each set, a column for each of the sorted ``vocabulary``: 1 where the set holds it."""
    out = np.zeros((len(grams), len(vocabulary)), np.float32)
    for row, own in enumerate(grams if len(vocabulary) else ()):
        at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
        out[row, at[vocabulary[at] == own]] = 1
    return out


def products(texts: pa.Array, vocabulary: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Presence of each text times ``weights``, over the root of the number of its n-grams, in batches of bounded size."""
    rows = max(1, CELLS // max(1, len(vocabulary)))
    out, held = [], []

    def batch() -> None:
        norm = np.sqrt([max(1, len(g)) for g in held])
        out.append(presence(held, vocabulary) @ weights / norm[:, None])
        held.clear()

    for grams in spectra(texts):
        held.append(grams)
        if len(held) == rows:
            batch()
    if held:
        batch()
    return np.concatenate([*out, np.zeros((0, weights.shape[1]))])


@dataclass
class Model:
    languages: list[str]
    vocabulary: np.ndarray
    weights: np.ndarray  # by n-gram and language
    bias: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Place of the best language of each text, and its share of the positive scores of all languages."""
        scores = products(texts, self.vocabulary, self.weights) + self.bias
        best = scores.argmax(axis=1)
        positive = np.maximum(scores, 0)
        top, total = positive[np.arange(len(scores)), best], positive.sum(axis=1)
        return best, np.where(total > 0, top / np.where(total > 0, total, 1), 1 / scores.shape[1])


@dataclass
class Landmarks:
    """Landmark sets as one normed matrix over their n-grams, and the inverse root of their kernel matrix."""

    vocabulary: np.ndarray
    matrix: np.ndarray
    root: np.ndarray

    @classmethod
    def of(cls, grams: list[np.ndarray]) -> Landmarks:
        vocabulary = np.unique(np.concatenate(grams))
        norm = np.sqrt([max(1, len(g)) for g in grams]).astype(np.float32)
        matrix = presence(grams, vocabulary) / norm[:, None]
        values, vectors = np.linalg.eigh((matrix @ matrix.T).astype(float))
        root = vectors * np.where(values > 1e-6, np.abs(values), np.inf) ** -0.5 @ vectors.T
        return cls(vocabulary, matrix, root)


def ridge(features: np.ndarray, of: np.ndarray, n_classes: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of one regression for each class against the rest, all classes weighing alike."""
    x = np.hstack([features, np.ones((len(features), 1))])
    y = np.eye(n_classes)[of]
    weight = (len(of) / n_classes / np.maximum(1, y.sum(axis=0)))[of, None]
    keep = penalty * np.eye(x.shape[1])
    keep[-1, -1] = 1e-9  # the bias is free
    w = np.linalg.solve(x.T @ (x * weight) + keep, x.T @ (y * weight))
    return w[:-1], w[-1]


def fit(docs: DataFrame, rows_per_language: int = 500, max_rows: int = 20_000, max_landmarks: int = 256, penalty: float = 0.1) -> Model | None:
    """Model from labelled ``docs (doc_id, text, lang)``; None without any labelled text that has a letter."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    # Only rows whose hash is low enough for some twice as many to be left are ranked, however frequent a language is.
    share = (2.0 * rows_per_language + 100) / F.col("n")
    counts = cut(known.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    order = F.xxhash64("doc_id")
    low = known.select("doc_id", "lang", order.alias("order")).join(broadcast_if_small(counts), "lang").where(F.col("order") / 2.0**64 + 0.5 < share)
    by_language = Window.partitionBy("lang").orderBy("order", "doc_id")
    chosen = low.select("doc_id", "lang", F.row_number().over(by_language).alias("rank")).where(F.col("rank") <= rows_per_language)
    chosen = chosen.orderBy("rank", "lang", "doc_id").limit(max_rows).dropDuplicates(["doc_id", "lang"])
    sample = known.where(has_letter()).join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", "rank", "text")
    sample = cut(sample, "sample")  # at most max_rows texts
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not languages:
        return None
    each = max(1, max_landmarks // len(languages))
    first = Window.partitionBy("lang").orderBy("rank", "doc_id")
    marks = sample.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each).orderBy("place", "lang").limit(max_landmarks)
    grams = marks.select("text").mapInArrow(_spectra, "grams array<long>").toArrow()["grams"]
    landmarks = Landmarks.of([np.sort(np.array(g.values.to_numpy(), np.int64).view(U)) for g in grams])
    project = landmarks.matrix.T
    rows = sample.mapInArrow(lambda batches: _kernel(batches, landmarks.vocabulary, project), "lang string, kernel array<double>").toArrow()
    features = np.array(rows["kernel"].combine_chunks().flatten().to_numpy()).reshape(len(rows), -1) @ landmarks.root
    place = {x: i for i, x in enumerate(languages)}
    of = np.array([place[x] for x in rows["lang"].to_pylist()])
    w, bias = ridge(features, of, len(languages), penalty)
    return Model(languages, landmarks.vocabulary, (project @ (landmarks.root @ w)).astype(np.float32), bias)


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            grams = [pa.array(g.view(np.int64)) for g in spectra(batch.column("text"))]
            ends = pa.array(np.cumsum([0, *map(len, grams)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.concat_arrays(grams))], ["grams"])


def _kernel(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray, project: np.ndarray) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            values = products(batch.column("text"), vocabulary, project).astype(float)
            ends = pa.array((np.arange(len(values) + 1) * values.shape[1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.ListArray.from_arrays(ends, pa.array(values.ravel()))], ["lang", "kernel"])


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    names = pa.array(model.languages, pa.string())
    for whole in batches:
        for batch in slices(whole, "text"):
            best, score = model.predict(batch.column("text"))
            keep = [batch.column(c) for c in ("doc_id", "held_out", "known")]
            yield pa.RecordBatch.from_arrays([*keep, names.take(pa.array(best)), pa.array(score.astype(float))], ["doc_id", "held_out", "known", "lang_pred", "score"])


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def language(docs: DataFrame, folds: int = 5, **training: int | float) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of ``docs (doc_id, text, lang)``; ``training`` as in ``fit``.

    Documents whose crc32 of the id as text is a multiple of ``folds`` are held out: their languages aren't read. A text
    that is null or has no letter, and every text if no language could be learned, gets ``und`` with score 0. Other
    scores are the language's share of the positive scores. Of equally good languages the first by name counts.
    Rows without language train nothing. A null id is not held out. Repeated rows give a row each, and train as one;
    other columns aren't read. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    model = fit(texts.where(~out), **training)
    rows = texts.select("doc_id", out.alias("held_out"), has_letter().alias("known"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(lambda batches: _predict(batches, model), f"doc_id {kind}, held_out boolean, known boolean, lang_pred string, score double")
    return scored.select(
        "doc_id", "held_out", F.when(F.col("known"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("known"), F.col("score")).otherwise(0.0).alias("score"),
    )
