"""Toxicity of whole texts by a subsequence string-kernel SVM with Nyström landmarks.

Two words are alike by the subsequences of three letters that they share, each weighed by ``DECAY`` to the power of
the span it takes in the word: ``i.d.i.o.t`` and ``idixot`` stay near ``idiot``. Signs that aren't letters only widen
spans. The SVM sees a word as its kernel with some landmark words (Nyström), learns a weight for each landmark, and
is folded into one weight for each triple of the letters that landmarks hold, so a word's score is a sum over its
triples divided by its norm. Letters beyond ASCII are the bytes of their UTF-8 form, each a letter of its own. A document's words are all scored; the largest score and the sum of the positive ones give the probability.

Training takes at most ``max_rows`` labelled documents of each class (in an order by hash of the id), and from these
the counts of words by class. The words of a toxic document aren't labelled one by one, so all words that toxic
documents have more often than chance allows are the positive examples, however rare their language is, together with
copies of them with a sign or letter put in; frequent words and the clean words most like a positive one are the negative examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from logweir.llm.scan import Rolling, Words, slices
from logweir.llm.tables import aside, cut, put_back

DECAY = 0.6
LETTERS = 155  # 0 a sign, 1-26 the letters, 27-154 the bytes of other letters
SURE = 24.0  # log-likelihood ratio that chance reaches for about one word in a million
WIDEST = 16  # longer words are scored by overlapping windows of this width
_CODE = np.zeros(256, np.int32)
_CODE[97:123] = np.arange(1, 27)
_CODE[0x80:] = np.arange(27, LETTERS)


@cache
def _triples(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weight of each subsequence of three in a word of ``width``."""
    places = np.array(list(combinations(range(width), 3)), np.int64).reshape(-1, 3)
    return places, DECAY ** (places[:, 2] - places[:, 0] + 1.0) if len(places) else np.zeros(0)


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words of one width: (word, triple, weight) of the triples without signs, one entry each."""
    places, weight = _triples(codes.shape[1])
    a, b, c = (codes[:, places[:, k]] for k in range(3))
    whole = (a > 0) & (b > 0) & (c > 0)
    key = (np.arange(len(codes))[:, None] * LETTERS**3 + a * LETTERS**2 + b * LETTERS + c)[whole]
    weight = np.broadcast_to(weight, whole.shape)[whole]
    unique, inverse = np.unique(key, return_inverse=True)
    return unique // LETTERS**3, unique % LETTERS**3, np.bincount(inverse, weight, len(unique))


def _norms(codes: np.ndarray) -> np.ndarray:
    word, _, weight = _features(codes)
    return np.sqrt(np.bincount(word, weight * weight, len(codes)))


@dataclass
class Model:
    weights: np.ndarray  # of each triple of the landmarks' letters
    place: np.ndarray  # of each letter among those of the landmarks; the last place is any other letter
    bias: float
    doc: np.ndarray  # of a document's (1, largest word score from 0, log of 1 + sum of scores cut to 0 to 1)

    def words(self, codes: np.ndarray) -> np.ndarray:
        """Scores of words of one width; those surely below the floor are given as the floor."""
        n, width = codes.shape
        floor = -1.0
        if width < 3 or not n:
            return np.full(n, floor)
        places, weight = _triples(width)
        letters = round(len(self.weights) ** (1 / 3))
        own = self.place[codes]
        first = own * letters**2
        second = own * letters
        total = np.zeros(n)
        for (i, j, k), w in zip(places, weight):
            total += w * self.weights[first[:, i] + second[:, j] + own[:, k]]
        # Equal triples only add to a norm, so this one is the least; signs leave out triples and need the true norm.
        top = total / np.sqrt((weight * weight).sum()) + self.bias
        score = np.full(n, floor)
        near = np.flatnonzero((top > floor) | (codes == 0).any(axis=1))
        if len(near):
            norm = _norms(codes[near])
            score[near] = np.maximum(floor, np.where(norm > 0, total[near] / np.where(norm > 0, norm, 1), 0) + self.bias)
        return score


def _letters(words: Words, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the words without leading and trailing signs."""
    letter = np.flatnonzero(codes > 0)
    if not len(letter):
        return (np.zeros(0, np.int64),) * 3
    a = np.searchsorted(letter, words.start)
    b = np.searchsorted(letter, words.end) - 1
    some = b >= a
    return words.row[some], letter[a[some]], letter[b[some]] + 1


def _spelled(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(row, places) of three or more words of one letter in a row: a word spelled letter by letter."""
    single = np.append((end - start == 1), False)
    single[:-1][1:] &= True
    found, i = [], 0
    at = np.flatnonzero(single)
    while i < len(at):
        j = i
        while j + 1 < len(at) and at[j + 1] == at[j] + 1 and row[at[j + 1]] == row[at[i]]:
            j += 1
        if j - i >= 2:
            found.append((int(row[at[i]]), start[at[i : j + 1]]))
        i = j + 1
    return found


def _windows(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word, or its windows where it is wider than ``WIDEST``: (word, start, end)."""
    n = np.maximum(1, -(-(end - start - WIDEST) // (WIDEST // 2)) + 1)
    word = np.repeat(np.arange(len(start)), n)
    step = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    a = start[word] + step * (WIDEST // 2)
    return word, a, np.minimum(a + WIDEST, end[word])


def doc_features(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the largest word score, and the sum of its words' scores each cut to 0 to 1."""
    words = Words(pc.utf8_lower(pc.fill_null(texts, "")))
    codes = _CODE[words.bytes]
    row, start, end = _letters(words, codes)
    spelled = _spelled(row, start, end)
    if spelled:  # spelled words are put behind the text
        extra = [codes[np.append(p, p[-1])] for _, p in spelled]
        size = np.array([len(p) for _, p in spelled])
        begin = len(codes) + np.cumsum(size + 1) - size - 1
        codes = np.concatenate([codes, *extra])
        row = np.append(row, [r for r, _ in spelled])
        start, end = np.append(start, begin), np.append(end, begin + size)
    word, a, b = _windows(start, end)
    largest, above = np.full(len(texts), -1.0), np.zeros(len(texts))
    if not len(a):
        return largest, above
    del words
    _, which, inverse = np.unique(Rolling(codes).hash(a, b), return_index=True, return_inverse=True)
    a, width, score = a[which], (b - a)[which], np.full(len(which), -1.0)
    for w in range(3, WIDEST + 1):
        of = np.flatnonzero(width == w)
        for k in range(0, len(of), 20_000):
            part = of[k : k + 20_000]
            score[part] = model.words(codes[a[part][:, None] + np.arange(w)])
    each = score[inverse]
    np.maximum.at(largest, row[word], each)
    above += np.bincount(row[word], np.clip(each, 0, 1), len(texts))
    return largest, above


def _code(word: str) -> np.ndarray:
    return _CODE[np.frombuffer(word.lower().encode("utf-8", "replace"), np.uint8)].astype(np.int64)[:WIDEST]


def _normed(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Triples of a word and their normed weights."""
    _, triple, weight = _features(_code(word)[None, :])
    return triple, weight / np.sqrt((weight * weight).sum()) if len(weight) else weight


def _triples_of(words: list[str]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.int64), *(_normed(w)[0] for w in words)]))


def _matrix(words: list[str], columns: np.ndarray | None = None) -> np.ndarray:
    """Normed triple weights, a row for each word, of the triples in ``columns`` or all that occur."""
    columns = _triples_of(words) if columns is None else columns
    out = np.zeros((len(words), len(columns)), np.float32)
    for i, word in enumerate(words if len(columns) else ()):
        triple, weight = _normed(word)
        at = np.minimum(np.searchsorted(columns, triple), len(columns) - 1)
        same = columns[at] == triple
        out[i, at[same]] = weight[same]
    return out


def _kernel(words: list[str], marks: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Kernel values of words with landmarks, a few words at a time."""
    parts = [_matrix(words[k : k + 50], columns) @ marks.T for k in range(0, len(words), 50)]
    return np.vstack(parts).astype(float) if parts else np.zeros((0, len(marks)))


def _likeness(words: list[str], others: list[str]) -> np.ndarray:
    """Largest kernel value of each word with any of ``others``, a few of these at a time."""
    most = np.zeros(len(words))
    for k in range(0, len(others), 64):
        columns = _triples_of(others[k : k + 64])
        most = np.maximum(most, _kernel(words, _matrix(others[k : k + 64], columns), columns).max(axis=1, initial=0))
    return most


def _distinct(words: list[str], n: int) -> list[str]:
    """``n`` of the words, each the least like those before it, so that rare kinds have landmarks too."""
    chosen, most = words[:1], np.zeros(len(words))
    while len(chosen) < min(n, len(words)):
        most = np.maximum(most, _likeness(words, chosen[-1:]))
        most[words.index(chosen[-1])] = np.inf
        chosen.append(words[int(most.argmin())])
    return chosen


def _varied(word: str) -> list[str]:
    """The word, with a sign between all letters, and with one sign or letter put in at each inner place."""
    inner = range(1, len(word))
    return [word, ".".join(word), *(word[:i] + x + word[i:] for i in inner for x in ("-", "x"))]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.01) -> np.ndarray:
    """Weights of a linear SVM of squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        inside = y * (x @ w) < 1
        xi = x[inside] * weight[inside, None]
        new = np.linalg.solve(xi.T @ x[inside] + penalty * np.eye(x.shape[1]), xi.T @ y[inside])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def fit_words(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int, landmarks: int = 256) -> Model | None:
    """SVM over words from (word, toxic documents, clean documents); None if no word tells the classes apart."""
    if not counts or not n_toxic or not n_clean:
        return None
    t = np.array([c[1] for c in counts], float)
    c = np.array([c[2] for c in counts], float)
    # Log-likelihood ratio of the word's share of toxic documents against that of all documents.
    share = n_toxic / (n_toxic + n_clean)
    part = lambda k, expected: k * np.log(np.where(k > 0, k, 1) / expected)
    ratio = 2 * (part(t, (t + c) * share) + part(c, (t + c) * (1 - share)))
    ratio[(t < 3) | (t / n_toxic < 3 * c / n_clean)] = 0
    order = np.lexsort(([w for w, _, _ in counts], -ratio))
    good = [counts[i][0] for i in order if ratio[i] >= SURE]
    if not good:
        return None
    clean = sorted((w for w in counts if w[1] * n_clean <= 1.5 * w[2] * n_toxic), key=lambda w: (-w[2], w[0]))
    names = [w for w, _, _ in clean]
    near = [(-float(likeness), w) for likeness, w in zip(_likeness(names, good), names)]
    hard = [w for _, w in sorted(near)[:3_000]]
    bad = list(dict.fromkeys([*[w for w, _, _ in clean[:400]], *hard]))
    marks = list(dict.fromkeys([*_distinct(good, landmarks), *bad[: landmarks // 2], *hard[: landmarks // 2]]))
    columns = _triples_of(marks)
    z = _matrix(marks, columns)
    values, vectors = np.linalg.eigh((z @ z.T).astype(float))
    root = vectors @ np.diag(np.where(values > 1e-6, values, np.inf) ** -0.5) @ vectors.T
    up = [v for w in good for v in _varied(w)]
    x = _kernel([*up, *bad], z, columns) @ root
    y = np.array([1.0] * len(up) + [-1.0] * len(bad))
    weight = np.where(y > 0, len(y) / 2 / len(up), len(y) / 2 / max(1, len(bad)))
    w = _svm(x, y, weight)
    parts = np.stack([columns // LETTERS**2, columns // LETTERS % LETTERS, columns % LETTERS])
    used = np.unique(parts)
    place = np.full(LETTERS, len(used) + 1)
    place[0], place[used] = 0, np.arange(1, len(used) + 1)
    a, b, c = place[parts]
    weights = np.zeros((len(used) + 2) ** 3)
    weights[(a * (len(used) + 2) + b) * (len(used) + 2) + c] = z.T @ (root @ w[:-1])
    return Model(weights, place, float(w[-1]), np.array([0.0, 1.0, 0.0]))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - 0.05 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 2000, vocabulary: int = 20_000) -> Model | float:
    """Model from labelled documents, or their toxic share (0 without any) where no word tells the classes apart.

    ``docs (doc_id, text)`` and ``labels (doc_id, toxic)`` must already be free of held-out rows. At most
    ``max_rows`` documents of each class count; of their words all that toxic documents have surely more often are
    positive examples, the ``vocabulary`` most frequent words give the negative ones.
    """
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = None
    for toxic in (1, 0):
        part = marked.where(F.col("toxic") == toxic).orderBy(order, "doc_id").limit(max_rows)
        chosen = part if chosen is None else chosen.union(part)
    sample = cut(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"), "sample")
    # Copies of one text count once.
    texts = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    words = texts.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))).alias("word"))
    letters = F.regexp_replace("word", r"^\P{L}+|\P{L}+$", "").alias("word")
    words = words.select("toxic", letters).where("length(word) BETWEEN 3 AND 40")
    counts = words.groupBy("word").agg(F.sum("toxic").cast("long").alias("t"), F.sum(1 - F.col("toxic")).cast("long").alias("c"))
    counts = cut(counts, "counts")
    # Every word that may be surely toxic, however rare, and the most frequent ones for the negative examples.
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    part = lambda k, of: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / ((F.col("t") + F.col("c")) * of))).otherwise(0)
    suspect = counts.where((F.col("t") >= 3) & (2 * (part("t", F.lit(share)) + part("c", F.lit(1 - share))) > SURE - 1))
    frequent = counts.orderBy(F.desc(F.col("t") + F.col("c")), "word").limit(vocabulary)
    rows = suspect.union(frequent).distinct().collect()
    model = fit_words([tuple(r) for r in rows], sizes.get(1, 0), sizes.get(0, 0))
    if model is None:
        return share
    scored = sample.mapInArrow(lambda batches: _score(batches, model, ["toxic"]), "toxic int, largest double, above double")
    rows = scored.collect()
    y = np.array([r.toxic for r in rows], float)
    x = np.array([(1.0, max(0.0, r.largest), np.log1p(r.above)) for r in rows])
    model.doc = _logistic(x, y)
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Model, keep: list[str], names: tuple[str, str] = ("largest", "above")) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            largest, above = doc_features(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(largest), pa.array(above)], [*keep, *names]
            )


def _probability(model: Model, largest: str, above: str) -> Column:
    a, b, c = (F.lit(float(x)) for x in model.doc)
    return 1 / (1 + F.exp(-(a + b * F.greatest(F.lit(0.0), F.col(largest)) + c * F.log1p(above))))


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5, max_rows: int = 2000) -> DataFrame:
    """The documents with all their columns, without those that ``toxicity`` predicts toxic. Row order is kept."""
    named = docs.columns
    docs, moved = aside(docs, "largest_", "above_")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    model = train(docs.select("doc_id", "text").where(~out), labels.select("doc_id", "toxic").where(~out), max_rows)
    if not isinstance(model, Model):
        return put_back(docs if model < 0.5 else docs.limit(0), moved, named)
    schema = StructType([*docs.schema.fields, StructField("largest_", DoubleType()), StructField("above_", DoubleType())])
    columns = docs.columns
    scored = docs.mapInArrow(lambda batches: _score(batches, model, columns, ("largest_", "above_")), schema)
    return put_back(scored.where(_probability(model, "largest_", "above_") < 0.5), moved, named)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, max_rows: int = 2000) -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``, and ``largest``, ``above`` of its words.

    Documents whose crc32 of the id as text is a multiple of ``folds`` are held out: their labels aren't read. Null,
    empty and wordless texts get the score of a text without any suspect word. Labels other than 0 and 1 and labels
    without a document don't count; of several labels of one document the toxic one does. Without labels of both
    classes, or if no word tells them apart, every score is the toxic share of the training rows. A null id is not
    held out. Repeated rows give a row each; other columns aren't read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    model = train(texts.where(~out), labels.select("doc_id", "toxic").where(~out), max_rows)
    if not isinstance(model, Model):
        scored = texts.select("doc_id", F.lit(-1.0).alias("largest"), F.lit(0.0).alias("above"), F.lit(float(model)).alias("score"))
    else:
        scored = texts.mapInArrow(lambda batches: _score(batches, model, ["doc_id"]), "doc_id long, largest double, above double")
        scored = scored.withColumn("score", _probability(model, "largest", "above"))
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "largest", "above"
    )
