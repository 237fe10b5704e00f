"""A matrix as row-block files with an index (M13 sink).

Cells go to contiguous row blocks (M10), a folder for each, in order of (i, j); a heavy
block is several files in order of their names.  The index has for each block its first
row, its rows, the offset of its first element in the row-major matrix and the cells it
stores; it is written last, so a folder with an index is whole.  ``read_rows`` finds the
blocks of a row range in the index and opens their files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.functions.blocks import row_block
from trellis.operators.matrix import ShapeError, row_blocks

CELLS = "i bigint, j bigint, v double"
INDEX = "block bigint, start_row bigint, n_rows bigint, elem_offset bigint, n_elems bigint, cells bigint"


def write_row_blocks(m: DataFrame, path: str, nrows: int, ncols: int, blocks: int, num_partitions: int | None = None) -> None:
    """Write cells ``(i, j, v)`` of an ``nrows x ncols`` matrix in ``blocks`` row blocks."""
    spark = m.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = m.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v"))
    dealt = cells.withColumn("block", row_block("i", nrows, blocks))
    (dealt.repartitionByRange(n, "block", "i", "j").sortWithinPartitions("block", "i", "j")
     .write.partitionBy("block").parquet(f"{path}/cells"))
    written = (spark.read.schema(f"{CELLS}, block bigint").option("basePath", f"{path}/cells").parquet(f"{path}/cells")
               .groupBy("block").agg(F.count(F.lit(1)).alias("cells")))
    index = (row_blocks(spark, nrows, ncols, blocks).join(written, "block", "left")
             .withColumn("cells", F.coalesce("cells", F.lit(0))))
    index.coalesce(1).sortWithinPartitions("block").write.parquet(f"{path}/index")


def block_index(spark: SparkSession, path: str) -> DataFrame:
    """One row for each block, empty ones included."""
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read_rows(spark: SparkSession, path: str, first: int, end: int) -> DataFrame:
    """The cells of rows ``first`` to ``end - 1``; the plan lists the files of their blocks only."""
    if first < 0 or end < first:
        raise ShapeError(f"no rows {first} to {end}")
    inside = (F.col("start_row") < end) & (F.col("start_row") + F.col("n_rows") > first) & (F.col("cells") > 0)
    found = block_index(spark, path).where(inside).select("block").collect()    # one row for each block
    if not found:
        return spark.createDataFrame([], CELLS)
    folders = [f"{path}/cells/block={r['block']}" for r in found]
    return spark.read.schema(CELLS).parquet(*folders).where((F.col("i") >= first) & (F.col("i") < end))
