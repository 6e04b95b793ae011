"""Small tables with the cases every operator must take."""

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = "the and of lamp river stone garden window quiet yellow seven tables winter orchard copper mirror".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents of several lines with exact and near copies, shared lines, blanks and nulls."""
    rng = random.Random(seed)
    shared = sentence(rng, 30)
    rows = []
    for i in range(n):
        lines = [sentence(rng, rng.choice([1, 3, 8, 12, 40])) for _ in range(rng.randrange(1, 6))]
        if i % 4 == 1:
            lines.insert(rng.randrange(len(lines) + 1), shared)
        if i % 5 == 2 and rows:
            lines = rng.choice(rows)[1].split("\n")
            if i % 2:
                k = rng.randrange(len(lines))
                words = lines[k].split(" ")
                words[rng.randrange(len(words))] = "changed"
                lines[k] = " ".join(words)
        rows.append((i * 3 + 1, "\n".join(lines), "en", f"s{i % 3}", None))
    return rows


ODD = [
    (900, None, None, None, None),
    (901, "", "en", "s0", 0),
    (902, " \t\n ", "en", None, 3),
    (903, "one", "en", "s1", 3),
    (904, "é ñ ü \U0001f600 ﷽", "xx", "s1", 9),
    (905, "word " * 30_000, "en", "s0", 150_000),
    (905, "word " * 30_000, "en", "s0", 150_000),
    (906, "x" * 70_000, None, "s2", 70_000),
    (None, "a text without an id that is long enough to have some lines", "en", "s0", 1),
]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, DOCS)


def clashing(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with further columns of these names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(7) for n in names})
