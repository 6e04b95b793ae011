import pytest

from logweir.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__streaming__stateStore__providerClass=(
            "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
        ),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def column(spark):
    """Value of a column expression over each text, NULL included."""

    def evaluate(fn, texts):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, s string")
        return [row.v for row in rows.select("i", fn(F.col("s")).alias("v")).orderBy("i").collect()]

    return evaluate
