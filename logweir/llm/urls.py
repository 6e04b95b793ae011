"""Verdicts on URLs by rules, and else by segmented words and naive Bayes.

Host labels and path parts are split into words: a unigram model of word counts gives each split a probability and
Viterbi finds the best, so that ``cheappillsonline`` becomes three words. Unknown words cost more with each letter.
The counts come from the path parts and the hyphened host labels of all rows; ``vocabulary`` bounds the model to the
most frequent words. Multinomial naive Bayes with add-one smoothing then scores the words; it is trained on the
labelled phrases below. Words it has not seen say nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# The rules of the query, (rule, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

# Labelled phrases to train on.
BLOCK = """
online casino bonus / casino win jackpot / poker slots betting / sports bet odds / roulette blackjack gamble / lottery winner prize
cheap pills online / viagra cialis pharmacy / buy cheap meds / weight loss pills / no prescription drugs / steroids for sale
ads track click / ad tracker banner / popup ads server / click tracking pixel / adserver sponsor / affiliate promo clicks
xxx adult porn / free sex cams / nude girls video / escort dating hot / erotic adult videos
payday loan fast cash / easy money now / get rich quick / crypto giveaway double / free bitcoin / forex profit signals
cracked software warez / torrent pirate download / serial keygen crack / free movie stream hd
account verify login update / secure bank confirm / password reset urgent / phishing wallet claim / malware virus download
replica watches cheap / fake designer bags / discount luxury outlet / cheap followers likes / seo backlinks buy / essay writing cheap
"""
ALLOW = """
news world politics / local news weather / science research journal / university library archive / school lesson course / history museum
blog post about / travel blog photos / food recipes kitchen / garden home family / health medicine doctor / hospital care guide
software docs manual / developer api reference / open source project / code tutorial help / wiki article page / forum question answer
music concert review / book author reading / film festival / art gallery design / sports team league / football match report
city council public / government law court / police fire service / community church events / contact about team / privacy terms
product support store / shop cart order / company careers press / market business economy / bank finance report / energy climate nature
mail calendar login / search index list / video lecture talk / picture gallery / map route train / data statistics table
"""


def _phrases(text: str) -> list[list[str]]:
    return [phrase.split() for phrase in re.split(r"[/\n]", text) if phrase.strip()]


class Bayes:
    """Multinomial naive Bayes over words, with add-one smoothing; ``share`` of the rows is thought to be bad."""

    def __init__(self, block: list[list[str]], allow: list[list[str]], share: float = 0.3):
        counts = [Counter(w for phrase in side for w in phrase) for side in (block, allow)]
        words = set(counts[0]) | set(counts[1])
        total = [sum(c.values()) + len(words) for c in counts]
        self.prior = log(share) - log(1 - share)
        self.weight = {w: log((counts[0][w] + 1) / total[0]) - log((counts[1][w] + 1) / total[1]) for w in words}

    def score(self, words: list[str]) -> float:
        """Log odds of block."""
        return self.prior + sum(self.weight.get(w, 0.0) for w in words)


class Splitter:
    """Most probable split of a string of letters under a unigram model."""

    def __init__(self, counts: dict[str, int], longest: int = 24):
        self.total = log(max(2, sum(counts.values())))
        self.cost = {w: self.total - log(n) for w, n in counts.items() if w and n > 0}
        self.longest = longest
        self.split = lru_cache(200_000)(self._split)

    def _split(self, text: str) -> tuple[str, ...]:
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            options = []
            for start in range(max(0, end - self.longest), end):
                cost = self.cost.get(text[start:end])
                options.append((best[start] + (self.total + 2.3 * (end - start) if cost is None else cost), start))
            cost, start = min(options)
            best.append(cost)
            back.append(start)
        words, end = [], len(text)
        while end:
            words.append(text[back[end] : end])
            end = back[end]
        return tuple(reversed(words))


def url_words(host: str, path: str, splitter: Splitter) -> list[str]:
    """Words of the host labels and of the path."""
    parts = re.findall(r"[^\W\d_]+", f"{host} {path.lower()}")
    return [word for part in parts for word in splitter.split(part)]


def _judge(batches: Iterator[pa.RecordBatch], counts: dict[str, int]) -> Iterator[pa.RecordBatch]:
    splitter, bayes = Splitter(counts), Bayes(_phrases(BLOCK), _phrases(ALLOW))
    for batch in batches:
        rows = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())
        scores = [bayes.score(url_words(host, path, splitter)) for host, path in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "odds"])


def url_parts(pages: DataFrame) -> DataFrame:
    """``page_id, host, path``; both empty for a null url or one without ``://``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", host.alias("host"), F.regexp_extract(url, pattern, 2).alias("path"))


def word_counts(parts: DataFrame, vocabulary: int) -> dict[str, int]:
    """Counts of the most frequent words of paths and hyphened host labels; every row counts."""
    labels = F.filter(F.split("host", r"\."), lambda x: x.contains("-"))
    pieces = F.concat(F.array("path"), labels)
    words = parts.select(F.explode(pieces).alias("p")).select(F.explode(F.regexp_extract_all(F.lower("p"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    counts = words.where("length(w) BETWEEN 2 AND 24").groupBy("w").agg(F.count("*").alias("n"))
    return {r.w: r.n for r in counts.orderBy(F.desc("n"), "w").limit(vocabulary).collect()}


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str]], vocabulary: int = 20_000) -> DataFrame:
    """Per row ``page_id, host, path, rule, verdict``, and ``odds``, the log odds of block by the words.

    The host runs from the first ``://`` to the next ``/``, ``?`` or ``#``, A-Z lower-cased; the path from there to
    ``?`` or ``#``. A rule ``host/path`` fits its host and all subdomains where the path starts with the rule's; the
    longest wins, then the first in code point order. Without a rule the words decide: block if the odds exceed 0. A
    null url, or one without ``://``, has an empty host and path and is allowed, as has any url without a known word.
    Repeated rows and null ids are kept; other columns aren't read. An empty table gives no rows.
    """
    parts = url_parts(pages)
    known = Counter(word_counts(parts, vocabulary))
    known.update(w for side in (BLOCK, ALLOW) for phrase in _phrases(side) for w in phrase)
    counts = dict(known)
    judged = parts.mapInArrow(lambda batches: _judge(batches, counts), StructType([*parts.schema.fields, StructField("odds", DoubleType())]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    by_words = F.when(F.col("odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_words).alias("verdict"), "odds")
