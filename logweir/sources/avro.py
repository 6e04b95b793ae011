"""Avro container files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from logweir.sources.files import list_files


def read_avro(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Avro files, whatever their suffix, through Spark's ``avro`` format.

    Where that module is not on the class path, Hadoop's Avro input format gives each record as
    JSON text, which is parsed with ``schema``. That format passes over files not named ``.avro``,
    so such files are refused there instead of being left out.
    """
    try:
        return spark.read.format("avro").option("ignoreExtension", True).schema(schema).load(path)
    except AnalysisException as error:
        if "Failed to find data source" not in str(error):
            raise
    skipped = list_files(spark, path).filter(~F.endswith("path", F.lit(".avro"))).select("path").first()
    if skipped:
        raise ValueError(f"{skipped.path} needs the spark-avro module, being named without .avro")
    records = spark.sparkContext.hadoopFile(
        path,
        "org.apache.avro.mapred.AvroAsTextInputFormat",
        "org.apache.hadoop.io.Text",
        "org.apache.hadoop.io.Text",
    )
    return spark.read.schema(schema).json(records.keys())
