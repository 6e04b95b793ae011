"""The pipeline stage by stage, its columns and decisions, and the queries over the given tables."""

import __spark_entry__
import corpus_pipeline
import pytest
from logweir.llm.queries import ORACLES, QUERIES
from logweir.llm.scan import unpack
from logweir.llm.tables import packed
from pyspark.sql import functions as F

from tests.llm.rows import ODD, clashing, corpus, documents
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.cut(stage(spark, before, FOLDER), name)
        seen.append((name, docs.count()))
        if name != "mixing":
            assert docs.columns == columns and docs.dtypes == before.dtypes
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert [n for n, _ in seen] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    counts = [n for _, n in seen[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100
    mixed = docs.select(F.explode("doc_ids").alias("doc_id")).distinct()
    assert mixed.join(before, "doc_id", "left_anti").count() == 0
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, run.drop("doc_ids").collect())) == sorted(map(tuple, docs.drop("doc_ids").collect()))


def test_stages_take_odd_and_empty_tables(spark):
    for rows in (ODD, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.cut(stage(spark, docs, FOLDER), name)
        assert docs.where("n_words > 64").count() == 0


def test_stages_keep_clashing_columns(spark):
    names = ["body_", "gone_", "largest_", "Above_", "n_lines", "n_removed", "n_words", "kept", "hash", "key", "aside_0", "toxic"]
    docs = clashing(documents(spark, [*corpus(31, 30), *ODD]), *names)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        assert docs.select(*names).distinct().collect() == [(7,) * len(names)]
    assert corpus_pipeline.mixing(spark, docs, FOLDER).count() > 0


def test_line_dedup_stage_drops_what_it_empties(spark):
    line = "one two three four five six seven eight nine"
    rows = [(1, line, "", "", 1), (2, f"{line}\n ", "", "", 1), (3, f"{line}\nmore", "", "", 1), (4, "", "", "", 0), (5, None, "", "", None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, documents(spark, rows), FOLDER).collect()}
    assert got == {1: (line, 1), 3: ("more", 4), 4: ("", 0), 5: (None, None)}


def test_entry_points_name_all():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op") and n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert names["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(QUERIES) and set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_packed_texts_come_back(spark):
    docs = documents(spark, ODD).where("doc_id IS NOT NULL").select("doc_id", "text")
    back = packed(docs).mapInArrow(unpack, "doc_id long, text string")
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
