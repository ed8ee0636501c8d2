"""Embedding whitening with MLlib's BlockMatrix.

The centred rows, numbered densely, are indexed into distributed blocks. The transposed
blocks times the blocks give the scatter matrix; its middle dimension is split, so that
tasks multiply a few blocks each and only square matrices of the dimension are added up.
A local ``eigh`` of that matrix gives the whitening matrix, and the blocks times it
project every row.

Entries become integers first, so sums and centres are exact: x = floor(1024 * c) +
100000, and a row is centred as (n * x - S) / n from the integer n * x - S, of which
nothing is lost to the offset.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm.common import met, stored

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Rows of a block at least, blocks of rows at most (the driver holds their coordinates), columns of a block, blocks that a task multiplies.
BLOCK_ROWS, MOST_BLOCKS, BLOCK_COLS, BLOCKS_A_TASK = 1024, 1 << 16, 1024, 8
#: Entries beyond leave no room for exact integers; eigenvalues below this share of the trace count as zero.
LARGEST, ZERO = float(1 << 40), 1e-12


def integer_rows(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows whose vector is whole, as integers."""
    entries = F.col(column).cast("array<double>")
    whole = entries.isNotNull() & ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    # A vector of nulls isn't looked into.
    x = F.transform(F.when(whole, entries), lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    rows = vectors.select("vec_id", x.alias("x")).where("x is not null and size(x) > 0")
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("x") == (common["dim"] if common else 0))


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` as a table with a dense number ``row`` from 0 on, and how many they are."""
    spark = rows.sparkSession
    table = stored(rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted(table.groupBy(part.alias("_part")).count().collect())  # one row for each task that wrote
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    starts = spark.createDataFrame(before, "_part long, _before long")
    low = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return met(table.withColumn("_part", part), starts, "_part").select(*rows.columns, (F.col("_before") + low).alias("row")), total


def blocks(rows: DataFrame, n: int, dim: int) -> BlockMatrix:
    """``rows`` (row, vector) as a matrix of blocks."""
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "vector"), n, dim)
    return matrix.toBlockMatrix(max(BLOCK_ROWS, -(-n // MOST_BLOCKS)), BLOCK_COLS)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transposed matrix times the matrix, of which only the sum reaches the driver."""
    other = matrix.transpose()
    splits = max(1, -(-matrix.numRows() // (matrix.rowsPerBlock * BLOCKS_A_TASK)))
    product = other._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def project(matrix: BlockMatrix, by: np.ndarray) -> DataFrame:
    """(row, y): the rows of ``matrix`` times ``by``."""
    sc, size = SparkContext.getOrCreate(), matrix.colsPerBlock
    cut = [((i // size, 0), Matrices.dense(len(part), by.shape[1], part.ravel(order="F"))) for i in range(0, len(by), size) if len(part := by[i : i + size])]
    product = matrix.multiply(BlockMatrix(sc.parallelize(cut, len(cut)), size, by.shape[1], *by.shape)).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model).toDF("row", "vector")
    return rows.select("row", vector_to_array("vector").alias("y"))


def identity_error(projected: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of ``y`` minus the identity."""
    y = [F.col("y")[i] for i in range(k)]
    mean = list(projected.agg(*(F.avg(c) for c in y)).first())
    pairs = list(combinations_with_replacement(range(k), 2))
    sums = projected.agg(*(F.sum((y[i] - mean[i]) * (y[j] - mean[j])) for i, j in pairs)).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs, strict=True))


def whiten(vectors: DataFrame, *, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """Whitened coordinates of every embedding.

    ``vectors``: vec_id, the array ``column`` and any other columns, whose names don't
    matter. Returns for each row and component, numbered from 1 by falling variance:
    vec_id, component, n, deviation (the exact sum of (n * x - S)**2 over the dimensions;
    null beyond a long), whitened, explained, identity_error.

    Rows are dropped whose vector is null, empty, of another length than most (of lengths
    that are as common the greatest counts), or holds null, NaN, an infinity or an entry
    beyond 2**40. Repeated rows each count, and rows of a null vec_id too. Equal
    eigenvalues come in the order of ``eigh``, and of an eigenvector its largest entry is
    made positive. Components without variance don't exist: fewer than ``components`` are
    returned if the rank is lower, none for an empty table, one row or equal rows.
    """
    spark = vectors.sparkSession
    rows, n = numbered(integer_rows(vectors, column))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = schema.replace("vec_id long", f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}")
    if not n:
        return spark.createDataFrame([], schema)
    sums = [s for _, s in sorted(rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).collect())]  # one for each dimension
    dim = len(sums)
    off = F.zip_with("x", F.array(*(F.lit(s).cast("long") for s in sums)), lambda x, s: x * F.lit(n).cast("long") - s)
    squares = F.aggregate("off", F.lit(0).cast("decimal(38,0)"), lambda total, d: (total + d.cast("decimal(19,0)") * d.cast("decimal(19,0)")).cast("decimal(38,0)"))
    centre = array_to_vector(F.transform("off", lambda d: d / F.lit(n))).alias("vector")
    exact = rows.withColumn("off", off).withColumn("total", squares)
    centred = stored(exact.select("row", "vec_id", F.expr("try_cast(total AS long)").alias("deviation"), centre))
    matrix = blocks(centred.select("row", "vector"), n, dim)
    values, axes = np.linalg.eigh(scatter(matrix) / n)
    trace = float(values.sum())
    order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > ZERO * trace]
    if not order:
        return spark.createDataFrame([], schema)
    values, axes = values[order], axes[:, order]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), range(len(order))])
    projected = stored(project(matrix, axes / np.sqrt(values)))
    error = identity_error(projected, n, len(order))
    shares = F.array(*(F.lit(float(v / trace)) for v in values))
    return (
        centred.select("row", "vec_id", "deviation").join(projected, "row")
        .select("vec_id", "deviation", F.posexplode("y").alias("pos", "whitened"))
        .select("vec_id", (F.col("pos") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", shares[F.col("pos")].alias("explained"), F.lit(float(error)).alias("identity_error"))
    )
