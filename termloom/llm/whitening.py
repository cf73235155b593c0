"""Whitening of embeddings with distributed block matrices.

*Numbers.*  Entries are turned into whole numbers ``x = floor(scale * c)``, so that counts, sums and
deviations are exact.  The model is fitted on each distinct x vector once (``n`` of them, sums ``S``).
*Blocks.*  The distinct vectors get row numbers without gaps and are centred, ``x - S / n``.  Some
``BLOCK_VALUES`` values in a row make one block of a Spark MLlib ``BlockMatrix``; the blocks are grouped by
Spark and written, so that a lost executor costs a re-read.
*Scatter.*  The tall matrix, transposed, times itself.  The product has one block, so its middle
dimension is cut into splits of ``SPLIT_BLOCKS`` blocks each: a task adds up a few blocks and hands on d x d
values.  The driver gets that d x d matrix alone, and decomposes it (``eigh``).
*Projection.*  ``BlockMatrix`` times the whitening matrix.  MLlib deals a product's blocks out as a grid with as many
cuts in either direction, and would leave a tall, narrow matrix with few tasks.  So the blocks
are laid out as a square grid, whose other factor has the whitening matrix along its diagonal: every
block is multiplied once, and all tasks have work.

The driver holds the places of the blocks; ``MOST_BLOCKS`` bounds them (blocks get larger beyond it).

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped.  Shorter
vectors count as padded with zeros.  Null and repeated ids and repeated rows all stay rows of
the result.  Components without variance (an eigenvalue below 1e-12 of the trace) are not given; if
there is none at all (no row, or one distinct vector) the result is empty.  Other columns are ignored.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.sources.shared import materialize, new_path

SCALE = 256
BLOCK_VALUES = 65_536
SPLIT_BLOCKS = 16
MOST_BLOCKS = 40_000
LEAST_SHARE = 1e-12
# A stored matrix block; Parquet gives it back as MLlib's own type.
STORED = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("_2", MatrixUDT())])


@dataclass(frozen=True)
class Whitening:
    """What was learnt: ``matrix`` (d x k) projects centred vectors on components of variance 1.

    ``identity_error`` is the largest absolute entry of the covariance of the projections minus the identity.
    """

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # all eigenvalues, falling
    matrix: np.ndarray
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return (self.values[: self.matrix.shape[1]] / self.values.sum()).tolist()


def integers(df: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``(id, x)`` of the usable rows, all x of one length."""

    def usable(c: Column) -> Column:
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    made = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("bigint"))
    rows = df.filter(F.col(vector).isNotNull() & F.forall(vector, usable))
    rows = materialize(rows.select(F.col(id_column).alias("id"), made.alias("x")), "whiten-rows")
    size = F.size("x")
    low, high = rows.agg(F.min(size), F.max(size)).first()
    if low == high:
        return rows
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(high) - size)
    return rows.withColumn("x", F.concat("x", zeros))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``(i, x)``: each x once, numbered from 0 without gaps.

    A row number is its place in a stored partition after the sizes of the partitions before; these
    sizes, one number per partition, are all that is ordered in one place.
    """
    stored = rows.groupBy("x").count().select("x", F.monotonically_increasing_id().alias("place"))
    stored = materialize(stored, "whiten-distinct")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    placed = stored.select(part.alias("part"), inside.alias("inside"), "x")
    numbered = placed.join(F.broadcast(starts), "part")
    return numbered.select((F.col("start") + F.col("inside")).alias("i"), "x")


def _struct(rows: Column, columns: int, values: Column) -> Column:
    """The stored form of a dense matrix whose ``values`` come row by row."""
    none = F.lit(None).cast("array<int>")
    return F.struct(
        F.lit(1).cast("tinyint").alias("type"), rows.alias("numRows"), F.lit(columns).alias("numCols"),
        none.alias("colPtrs"), none.alias("rowIndices"), values.alias("values"), F.lit(True).alias("isTransposed"),
    )


def _matrix(blocks: DataFrame, rows_per_block: int, columns_per_block: int, shape: tuple[int, int]) -> BlockMatrix:
    return BlockMatrix(
        callMLlibFunc("createBlockMatrix", blocks, rows_per_block, columns_per_block, *shape),
        rows_per_block,
        columns_per_block,
    )


def _product(left: BlockMatrix, right: BlockMatrix, splits: int = 1):
    """The product as a JVM matrix; the public call takes the splits of the middle dimension in Scala only."""
    return left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)


def _read_blocks(spark: SparkSession, path: str, place: Column) -> DataFrame:
    """The stored blocks, moved to ``place(number of the block)``."""
    return spark.read.schema(STORED).parquet(path).select(place.alias("_1"), "_2")


def _at(row: Column, column: Column) -> Column:
    return F.struct(row.cast("bigint").alias("_1"), column.cast("bigint").alias("_2"))


def whiten(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = SCALE
) -> tuple[DataFrame, Whitening | None]:
    """Rows ``(id, n, deviation, whitened)`` with one whitened value per component, and the model.

    ``deviation`` is the sum of ``(n x - S)^2`` over the dimensions, exact, as a decimal number.
    """
    spark = df.sparkSession
    rows = integers(df, id_column, vector, scale)
    fit = materialize(distinct_vectors(rows), "whiten-fit")
    nothing = spark.createDataFrame([], T.StructType([
        T.StructField("id", df.schema[id_column].dataType), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ]))
    shape = fit.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = shape["n"], shape["d"] or 0
    if n < 2 or not d:
        return nothing, None
    sums = [int(s) for s in fit.agg(*(F.sum(F.col("x")[j]) for j in range(d))).first()]

    # Blocks of centred rows.
    size = max(1, BLOCK_VALUES // d, -(-n // MOST_BLOCKS))
    blocks = -(-n // size)
    mean = F.array(*(F.lit(s / n) for s in sums))
    centred = F.zip_with("x", mean, lambda x, m: x.cast("double") - m)
    grouped = fit.groupBy(F.floor(F.col("i") / size).cast("int").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("i", centred.alias("c")))).alias("rows")
    )
    values = F.flatten(F.col("rows.c"))
    path = new_path(spark, "whiten-blocks")
    grouped.select("block", _struct(F.size("rows"), d, values).alias("_2")).write.parquet(path)

    # Scatter, and its components.
    tall = _matrix(_read_blocks(spark, path, _at(F.col("block"), F.lit(0))), size, d, (n, d))
    splits = -(-blocks // SPLIT_BLOCKS)
    scatter = BlockMatrix(_product(tall.transpose(), tall, splits), d, d).toLocalMatrix().toArray()
    values, matrix = _decomposed((scatter + scatter.T) / (2 * n), components)
    k = matrix.shape[1]
    if not k:
        return nothing, None

    # The blocks as a square grid, times the whitening matrix along a diagonal.
    side = int(np.ceil(np.sqrt(blocks)))
    grid = _matrix(
        _read_blocks(spark, path, _at(F.floor(F.col("block") / side), F.col("block") % side)),
        size, d, (-(-blocks // side) * size, side * d),
    )
    weights = F.lit([float(v) for v in matrix.ravel()])
    path = new_path(spark, "whiten-diagonal")
    diagonal = spark.range(side).select(F.col("id").cast("int").alias("block"), _struct(F.lit(d), k, weights).alias("_2"))
    diagonal.write.parquet(path)
    right = _matrix(_read_blocks(spark, path, _at(F.col("block"), F.col("block"))), d, k, (side * d, side * k))
    path = new_path(spark, "whiten-projected")
    callMLlibFunc("getMatrixBlocks", _product(grid, right)).toDF("_1", "_2").write.parquet(path)
    whitened = _rows_of(spark, path, side, size, k)

    # Back to the rows given: all of them, copies too, by their vector.
    keys = F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(7), "x").alias("k2")
    exact = "decimal(38,0)"
    off = F.transform("x", lambda x, j: x.cast(exact) * F.lit(n) - F.element_at(F.lit(sums), j + 1))
    deviation = F.aggregate(off, F.lit(0).cast(exact), lambda a, v: (a + (v * v).cast(exact)).cast(exact))
    known = fit.join(whitened, "i").select(*keys, F.lit(n).cast("bigint").alias("n"), deviation.alias("deviation"), "whitened")
    known = materialize(known, "whiten-known")
    model = Whitening(n, tuple(sums), values, matrix, _identity_error(known, k))
    return rows.select("id", *keys).join(known, ["k1", "k2"]).drop("k1", "k2"), model


def _decomposed(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    k = min(components, int((values > LEAST_SHARE * values.sum()).sum()))
    vectors = vectors[:, :k]
    # Of the two signs the one that makes the largest entry positive.
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] if k else np.zeros(0)
    return values, vectors * np.where(largest < 0, -1.0, 1.0) / np.sqrt(values[:k])


def _identity_error(known: DataFrame, k: int) -> float:
    each = [F.col("whitened")[c] for c in range(k)]
    off = [F.abs(F.covar_pop(each[a], each[b]) - float(a == b)) for a in range(k) for b in range(a, k)]
    return max(known.agg(*off).first())


def _rows_of(spark: SparkSession, path: str, side: int, size: int, k: int) -> DataFrame:
    """``(i, whitened)`` from a stored product; its blocks hold their values column by column."""
    block = "struct<type: tinyint, numRows: int, numCols: int, values: array<double>, isTransposed: boolean>"
    place = spark.read.parquet(path).schema["_1"].dataType.simpleString()
    stored = spark.read.schema(f"_1 {place}, _2 {block}").parquet(path)
    first = (F.col("_1._1").cast("bigint") * side + F.col("_1._2")) * size
    rows, values = F.col("_2.numRows"), F.col("_2.values")

    def row(r: Column) -> Column:
        across, down = r * k, r
        cells = [F.when(F.col("_2.isTransposed"), values[across + c]).otherwise(values[down + rows * c]) for c in range(k)]
        return F.struct((first + r).alias("i"), F.array(*cells).alias("whitened"))

    return stored.select(F.inline(F.transform(F.sequence(F.lit(0), rows - 1), row)))
