"""Whitening of embeddings with MLlib's BlockMatrix.

Rows are numbered, centred and laid out as distributed blocks; a block matrix times its own transpose gives the
scatter; its eigenvectors are found on the driver (d x d numbers for d dimensions); a second block product projects
every row. Only that d x d matrix, the d sums and the k x k check meet on the driver.

Layout. One column of row blocks would leave MLlib's grid of partitions with the square root of the tasks asked for.
So G rows stand side by side as one wide row, and the weights as a block diagonal: the product's grid then has
rows and columns. For the scatter the same blocks are numbered as one column, and the product splits its middle
dimension, so that no task meets more than `BLOCKS_PER_TASK` blocks of each side.
"""

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.llm.common import written

SCALE, COMPONENTS = 256, 4
ROWS_PER_BLOCK, BLOCKS_PER_TASK = 1024, 8
WHOLE = "decimal(38,0)"


def whole_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """`vec_id` and `x`: whole numbers floor(256 c) of the vectors without null or non-finite entries."""
    c = F.col(vector)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    x = F.transform(c, lambda v: F.floor(F.lit(SCALE) * v.cast("double")).cast("long"))
    return table.filter(c.isNotNull()).filter(finite).select("vec_id", x.alias("x"))


def numbered(rows: DataFrame) -> DataFrame:
    """The stored rows with `index` 0, 1, 2, …: the place in the stored part plus the sizes of the parts before it."""
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    stored = written(rows.select("*", part.alias("part"), place.alias("place")), "whitening")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task
    starts = stored.groupBy("part").agg(F.count(F.lit(1)).alias("size")).select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    return stored.join(F.broadcast(starts), "part").select(*rows.columns, (F.col("start") + F.col("place")).alias("index"))


class Layout:
    """How `count` rows of width `width` are dealt to wide rows and blocks."""

    def __init__(self, count: int, width: int):
        self.width = width
        self.stripes = max(1, math.isqrt(math.ceil(count / ROWS_PER_BLOCK)))
        self.wide_rows = math.ceil(count / self.stripes)
        self.tall_blocks = math.ceil(self.wide_rows / ROWS_PER_BLOCK) * self.stripes

    def blocks(self, rows: DataFrame, values: Column) -> BlockMatrix:
        """Blocks of the `width` doubles of each row, by `index`; absent rows are zero."""
        seat = F.struct((F.col("index") % self.stripes).cast("int").alias("stripe"), values.alias("values"))
        wide = rows.groupBy(F.floor(F.col("index") / self.stripes).cast("long").alias("index")).agg(F.map_from_entries(F.collect_list(seat)).alias("seats"))
        empty = F.array_repeat(F.lit(0.0), self.width)
        flat = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(self.stripes - 1)), lambda s: F.coalesce(F.try_element_at("seats", s), empty)))
        vectors = MLUtils.convertVectorColumnsFromML(wide.select("index", array_to_vector(flat).alias("vector")), "vector")
        return IndexedRowMatrix(vectors, self.wide_rows, self.stripes * self.width).toBlockMatrix(ROWS_PER_BLOCK, self.width)

    def tall(self, matrix: BlockMatrix) -> BlockMatrix:
        """The same blocks in one column."""
        blocks = callMLlibFunc("getMatrixBlocks", matrix._java_matrix_wrapper._java_model)
        key, block = blocks.columns
        down, across = (f"{key}.{n}" for n in blocks.schema[key].dataType.names)
        place = F.struct((F.col(down) * self.stripes + F.col(across)).cast("long").alias("_1"), F.lit(0).cast("long").alias("_2"))
        sizes = (ROWS_PER_BLOCK, self.width, self.tall_blocks * ROWS_PER_BLOCK, self.width)
        return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks.select(place.alias(key), block), *sizes), ROWS_PER_BLOCK, self.width)

    def rows(self, matrix: BlockMatrix, width: int) -> DataFrame:
        """`index` and array `values` of each row of a matrix of `width` columns a stripe."""
        wide = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        index, vector = wide.columns
        parts = F.transform(F.sequence(F.lit(0), F.lit(self.stripes - 1)), lambda s: F.slice("flat", s * width + 1, width))
        return wide.select(index, vector_to_array(vector).alias("flat")).select(index, F.posexplode(parts).alias("stripe", "values")).select(
            (F.col(index) * self.stripes + F.col("stripe")).alias("index"), "values"
        )

    def scatter(self, matrix: BlockMatrix) -> np.ndarray:
        """Sum over the rows of the outer product of each with itself."""
        tall = self.tall(matrix)
        splits = max(1, math.ceil(self.tall_blocks / BLOCKS_PER_TASK))
        product = tall.transpose()._java_matrix_wrapper.call("multiply", tall._java_matrix_wrapper._java_model, splits)
        return BlockMatrix(product, self.width, self.width).toLocalMatrix().toArray()

    def projected(self, matrix: BlockMatrix, weights: np.ndarray, sc) -> DataFrame:
        """Rows times `weights`."""
        across = weights.shape[1]
        block = Matrices.dense(*weights.shape, weights.ravel(order="F"))
        diagonal = BlockMatrix(sc.parallelize([((s, s), block) for s in range(self.stripes)]), self.width, across)
        return self.rows(matrix.multiply(diagonal), across)


def eigen(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` largest eigenvalues, falling, and their unit eigenvectors as columns; those of rounding size are left out."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = (values > len(values) * np.finfo(float).eps * max(values[0], 0.0))[:most]
    return values[:most][kept], vectors[:, :most][:, kept]


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector: vec_id, n, deviation, values (whitened), explained (one for each component), identity_error.

    Fitted on the distinct whole vectors, each once. Rows whose vector is null, or holds a null or a non-finite entry,
    go; shorter vectors count as having zeros at the end; repeated rows and null ids stay. A component whose variance
    is of rounding size is left out, so equal vectors, a single one, or an empty table give rows without components.
    A deviation beyond a long is null. Other columns are ignored. Work that many rows share happens once: rows are
    stored, and equal vectors are combined within each task before they move.
    """
    spark = table.sparkSession
    rows = numbered(whole_vectors(table, vector))
    fit = written(rows.groupBy("x").agg(F.min("index").alias("index")), "whitening-fit")
    size = fit.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    n, width = size[0], size[1]
    no_components = [*[F.array().cast("array<double>").alias(c) for c in ("values", "explained")], F.lit(0.0).alias("identity_error")]
    if not width:
        return rows.select("vec_id", F.lit(n).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"), *no_components)
    totals = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast(WHOLE)).alias("total")).collect()  # one for each dimension
    sums = dict.fromkeys(range(width), 0) | {r["at"]: int(r["total"]) for r in totals}
    means = F.array(*[F.lit(sums[j] / n) for j in range(width)])
    exact = F.array(*[F.lit(str(sums[j])).cast(WHOLE) for j in range(width)])
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    centred = F.zip_with(padded, means, lambda x, m: x.cast("double") - m)

    count = rows.count()
    layout = Layout(count, width)
    fitted = layout.blocks(fit, centred)
    covariance = layout.scatter(fitted) / n
    values, vectors = eigen((covariance + covariance.T) / 2, components)
    off = F.zip_with(padded, exact, lambda x, s: F.try_subtract(F.try_multiply(x.cast("decimal(20,0)"), F.lit(n).cast("decimal(18,0)")), s).cast(WHOLE))
    squares = F.aggregate(off, F.lit(0).cast(WHOLE), lambda acc, v: F.try_add(acc, F.try_multiply(v, v)).try_cast(WHOLE))
    kept = rows.select("index", "vec_id", F.lit(n).cast("long").alias("n"), squares.try_cast("long").alias("deviation"))
    if not len(values):
        return kept.select("vec_id", "n", "deviation", *no_components)
    weights = vectors / np.sqrt(values)

    sample = written(layout.projected(fitted, weights, spark.sparkContext), "whitening-check")
    present = sample.join(fit.select("index"), "index")
    k = len(values)
    centre = present.select(*[F.avg(F.get("values", j)) for j in range(k)]).first()
    shift = F.array(*[F.lit(float(m)) for m in centre])
    checked = Layout(count, k)
    unit = checked.scatter(checked.blocks(present, F.zip_with("values", shift, lambda v, m: v - m))) / n
    error = float(np.abs(unit - np.eye(k)).max())
    explained = F.array(*[F.lit(float(v / np.trace(covariance))) for v in values])
    projected = layout.projected(layout.blocks(rows, centred), weights, spark.sparkContext)
    return kept.join(projected, "index").select("vec_id", "n", "deviation", "values", explained.alias("explained"), F.lit(error).alias("identity_error"))


def by_component(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component, components from 1."""
    pairs = F.arrays_zip("values", "explained")
    return whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(pairs).alias("at", "pair")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("pair.values").alias("whitened"), F.col("pair.explained").alias("explained"), "identity_error",
    )
