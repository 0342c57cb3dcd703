"""Whitening of embeddings on the principal axes of their covariance, by distributed block matrices.

Entries become whole numbers (floor of ``scale`` times the entry), so sums, means and deviations are exact.
Centred rows are numbered without gaps and cut into the blocks of a BlockMatrix; its transpose times itself is
the scatter, whose eigenvectors are found on the driver (width x width numbers), and the blocks times the
whitening matrix are the projections. The covariance is that of distinct vectors: a vector that a third of
all rows share counts once, and partial aggregates cut it down before the shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.store import stored

#: Entries a block holds at most.
BLOCK_ENTRIES = 1 << 17
#: Columns a block holds at most, and a vector: the scatter of 4096 columns is 128 MB on the driver.
BLOCK_COLUMNS, MAX_WIDTH = 1024, 4096
RESULT = "{id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """``rows`` with x, the whole numbers of the vector; rows whose vector is null or has a null or non-finite entry go.

    An entry whose whole number does not fit a long counts as not finite. Vectors are of the length that
    most rows have (of the longer, if equally many); rows of any other length go.
    """
    entry = lambda e: F.isnotnull(e) & (F.abs(e * scale) < F.lit(float(1 << 63)))  # noqa: E731  NaN is above all numbers
    sound = F.col(vector).isNotNull() & F.forall(F.col(vector), entry)
    rows = rows.withColumn(vector, F.col(vector).cast("array<double>")).filter(sound & (F.size(vector) > 0))
    lengths = rows.groupBy(F.size(vector).alias("w")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("w"))
    common = lengths.first()
    width = common["w"] if common else 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} entries, more than {MAX_WIDTH}")
    x = F.transform(vector, lambda e: F.floor(e * scale))
    return rows.filter(F.size(vector) == width).withColumn("x", x).drop(vector)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """A stored copy of ``df`` whose ``index`` counts its rows from 0 without gaps.

    Rows are numbered within their task; offsets, a row per task, are added after the table is written, so
    a lost executor cannot number them anew.
    """
    kept = stored(df.withColumn("nth", F.monotonically_increasing_id()), name)
    task = F.shiftright("nth", 33)
    sizes = kept.groupBy(task.alias("task")).agg(F.count("*").alias("c"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("nth").bitwiseAND((1 << 33) - 1)
    return kept.withColumn("task", task).join(F.broadcast(offsets), "task").withColumn("index", place).drop("task", "nth", "offset")


def blocks(df: DataFrame, means: list[float], n_rows: int) -> BlockMatrix:
    """The centred rows of ``df`` (index, x) as a matrix of blocks."""
    width = len(means)
    centred = F.zip_with("x", F.lit(means), lambda v, m: v - m)
    vectors = MLUtils.convertVectorColumnsFromML(df.select("index", array_to_vector(centred).alias("vector")), "vector")
    columns = min(width, BLOCK_COLUMNS)
    return IndexedRowMatrix(vectors, n_rows, width).toBlockMatrix(max(1, BLOCK_ENTRIES // columns), columns)


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """left times right; ``splits`` tasks share the middle dimension, which the Python method has no argument for."""
    out = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(out, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix, splits: int) -> np.ndarray:
    """The matrix's transpose times itself, as a local array."""
    return product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, axes: np.ndarray) -> DataFrame:
    """(index, y) of the rows of ``matrix`` times ``axes`` (width x components)."""
    sc, columns = SparkContext.getOrCreate(), matrix.colsPerBlock
    parts = [axes[at : at + columns] for at in range(0, len(axes), columns)]
    local = [((k, 0), Matrices.dense(p.shape[0], p.shape[1], p.ravel("F").tolist())) for k, p in enumerate(parts)]
    right = BlockMatrix(sc.parallelize(local, 1), columns, axes.shape[1], *axes.shape)
    rows = product(matrix, right).toIndexedRowMatrix()
    frame = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return frame.select("index", vector_to_array(F.col("vector")).alias("y"))


def whiten(
    rows: DataFrame, components: int = 4, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """A row per vector and component: whitened value, variance explained, exact deviation from the mean.

    The n distinct vectors are what means and the covariance (divisor n) come from; components are its unit
    eigenvectors by falling eigenvalue. Components without variance, to double precision, are left out: of
    equal vectors only, of one vector, or of an empty table, there are no rows. Equal eigenvalues share a
    plane, in which the axes are any two at right angles. Repeated rows and null ids are all returned.
    A deviation that does not fit a long is null. Other columns, whatever their names, are not read.
    """
    spark = rows.sparkSession
    kind = rows.select(F.col(f"`{vec_id}`")).schema[0].dataType.simpleString()
    read = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    every = numbered(whole_vectors(read, "v", scale), "whole-vectors")
    fit = numbered(every.select("x").distinct(), "fit-vectors")
    exact = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n"))
    sums = sorted(exact.collect(), key=lambda r: r["at"])  # as many rows as a vector has entries
    width, n = len(sums), sums[0]["n"] if sums else 0
    none = spark.createDataFrame([], RESULT.format(id=f"vec_id {kind}"))
    if n < 2:
        return none
    means = [float(r["s"]) / n for r in sums]
    whole = blocks(fit, means, n)
    splits = max(1, spark.sparkContext.defaultParallelism)
    covariance = scatter(whole, splits) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    solid = int((values > max(trace, 0) * width * np.finfo(float).eps).sum())
    k = min(components, solid)
    if not k:
        return none
    axes = vectors[:, :k] / np.sqrt(values[:k])
    error = identity_error(projected(whole, axes), k)
    total = every.agg(F.count("*")).first()[0]
    scores = projected(blocks(every, means, total), axes)
    # n * x - S and its square, whole numbers throughout; null where they leave the range of a long.
    away = F.zip_with("x", F.array(*[F.lit(int(r["s"])) if abs(r["s"]) < 1 << 63 else F.lit(None).cast("long") for r in sums]),
                      lambda v, s: F.try_subtract(F.try_multiply(v, F.lit(n)), s))
    deviation = F.aggregate(away, F.lit(0).cast("long"), lambda a, d: F.try_add(a, F.try_multiply(d, d)))
    shares = F.lit([float(v) / trace for v in values[:k]])
    out = every.select("index", "vec_id", deviation.alias("deviation")).join(scores, "index")
    return out.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )


def identity_error(scores: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of y (divisor n, centred first) minus the identity."""
    values = [F.element_at("y", i + 1) for i in range(k)]
    means = scores.agg(*[F.avg(v) for v in values]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = scores.agg(*[F.avg((values[i] - means[i]) * (values[j] - means[j])) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found))
