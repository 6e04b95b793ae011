"""Whitening of embeddings by distributed block matrices.

Entries become whole numbers, so sums and deviations are exact. Rows get consecutive numbers from counts of the written
table's parts, are centred and dealt into blocks (``IndexedRowMatrix`` to ``BlockMatrix``). The scatter matrix is the
transpose times the blocks, cut in many parts along the rows, so that no task gets the blocks of all rows. Its
eigenvectors are found on the driver, as it has one row and column for each dimension. Blocks times the whitening matrix
give the projections. All of it stays in the JVM.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.llm.tables import cut

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
PLACES = 33  # low bits of monotonically_increasing_id: the row's place in its partition


def whole(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, x`` with ``x = floor(scale * c) + shift``, of the rows whose vector is whole.

    Left out are vectors that are null or empty or hold a null, an entry that isn't finite or one of 2**40 or more.
    """
    rows = embeddings.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    fits = F.forall("c", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))  # NaN is the largest double
    rows = rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & fits)
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(scale * c) + shift).alias("x"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with consecutive numbers from 0 in the column ``index``.

    Each row's partition and place are written with it; the first number of a partition is the count of rows before it.
    """
    spark = rows.sparkSession
    rows = cut(rows.withColumn("at", F.monotonically_increasing_id()), "rows")
    part = F.shiftright("at", PLACES).alias("part")
    counts = sorted((r.part, r.n) for r in rows.groupBy(part).agg(F.count("*").alias("n")).collect())
    begin = np.cumsum([0, *(n for _, n in counts)]).tolist()
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, begin)], "part long, begin long")
    joined = rows.withColumn("part", part).join(F.broadcast(starts), "part")  # a row for each input partition
    return joined.withColumn("index", F.col("begin") + F.col("at").bitwiseAND((1 << PLACES) - 1)).drop("part", "begin", "at")


def _sums(rows: DataFrame, width: int) -> list[int]:
    """Exact sums by dimension."""
    total = [F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    return [int(s) for s in rows.agg(*total).first()]


def blocks(rows: DataFrame, rows_per_block: int, width: int) -> BlockMatrix:
    """``rows (index, v array<double>)`` as distributed blocks of all columns."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("v").alias("vector")), "vector")
    return IndexedRowMatrix(vectors).toBlockMatrix(rows_per_block, width)


def scatter(matrix: BlockMatrix, parts: int) -> np.ndarray:
    """Transpose times ``matrix``, its rows cut in ``parts`` that are multiplied apart and summed."""
    up = matrix.transpose()
    right = matrix._java_matrix_wrapper._java_model
    product = up._java_matrix_wrapper.call("multiply", right, parts)  # Python's multiply lacks the number of parts
    return BlockMatrix(product, up.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit eigenvectors as columns; the largest entry of each is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    vectors = vectors[:, order]
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return np.maximum(values[order], 0.0), vectors * np.where(top < 0, -1.0, 1.0)


def _projected(matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """``index, w``: rows of ``matrix`` times the whitening matrix."""
    spark = SparkSession.getActiveSession()
    local = DenseMatrix(*whitening.shape, whitening.ravel(order="F").tolist())
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), local)], 1), *whitening.shape)
    found = matrix.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", found._java_matrix_wrapper._java_model)  # ``rows`` would pass through Python
    return rows.select("index", vector_to_array("vector").alias("w"))


def _identity_error(projected: DataFrame, n: int) -> float:
    pairs = list(combinations_with_replacement(range(n), 2))
    found = projected.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(embeddings: DataFrame, most: int = 8, rows_per_block: int = 1024) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of ``embeddings (vec_id, embedding)``.

    A row for each whole vector and component from 1 to ``most``, or to the number of dimensions. ``deviation`` is the
    sum over dimensions of ``(n * x - S)**2`` where S are the sums of x, null where that is beyond a long. ``whitened``
    is the centred vector on the component over the root of its eigenvalue; ``explained`` that eigenvalue's share of
    the variance; ``identity_error`` the largest entry of the covariance of ``whitened`` less the identity.

    Vectors that are null, empty or not finite are left out, and so are those of another length than most (of equally
    common lengths the larger counts). Without any vector there are no rows. A direction without variance gives 0 for
    ``whitened`` and ``explained``, and ``identity_error`` is then 1. Repeated rows count each and give rows each, a
    null ``vec_id`` is a value as any other, further columns aren't read.
    """
    spark = embeddings.sparkSession
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = cut(whole(embeddings), "whole")
    lengths = sorted((r.n, r.width) for r in rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).collect())
    if not lengths:
        return empty.withColumn("vec_id", F.col("vec_id").cast(embeddings.schema["vec_id"].dataType))
    n, width = lengths[-1]
    sums = _sums(rows.where(F.size("x") == width), width)
    rows = rows.where(F.size("x") == width)
    # x - S/n with one rounding of the fraction and one of the difference.
    least = F.array(*(F.lit(s // n) for s in sums))
    rest = F.array(*(F.lit(float(s % n) / n) for s in sums))
    centred = F.zip_with(F.zip_with("x", least, lambda x, q: (x - q).cast("double")), rest, lambda x, r: x - r)
    if max(map(abs, sums)) < 1 << 63:
        apart = F.zip_with("x", F.array(*(F.lit(s) for s in sums)), lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(n)), s))
        deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))
    else:
        deviation = F.lit(None).cast("long")
    rows = cut(numbered(rows.select("vec_id", deviation.alias("deviation"), centred.alias("v"))), "centred")
    matrix = blocks(rows, rows_per_block, width)
    count = -(-n // rows_per_block)
    covariance = scatter(matrix, count) / n
    values, vectors = components(covariance, most)
    trace = float(np.trace(covariance))
    alive = values > 1e-13 * max(trace, 0.0)
    whitening = vectors * np.where(alive, 1 / np.sqrt(np.where(alive, values, 1.0)), 0.0)
    projected = cut(_projected(matrix, whitening), "projected")
    error = _identity_error(projected, len(values))
    explained = [float(v / trace) if live else 0.0 for v, live in zip(values, alive)]
    share = F.array(*(F.lit(e) for e in explained))
    out = rows.select("index", "vec_id", "deviation").join(projected, "index")
    out = out.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
