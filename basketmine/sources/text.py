"""Text sources: ragged basket lines (S1), the category catalogue (S2), incoming
baskets (S3) and row ids for sources without a natural key (R1, R2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def dense_row_index(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add a dense 0..n-1 index without an RDD round trip (R1): in file order (path, then
    position) for a DataFrame read from files, else in partition order.

    Spark orders file splits by size, so partition order is not file order.  Rows
    are therefore counted per block, a split of one file: its rows follow one another in the low
    part of ``monotonically_increasing_id``, so a row's place in its block is its
    id less the block's smallest.  The running sum over the blocks (one row each, in order of path and
    start) gives the offsets; nothing reaches the driver.
    """
    try:
        tagged = df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_at", F.col("_metadata.file_block_start"))
    except AnalysisException:       # not read from files
        tagged = df.withColumn("_file", F.lit("")).withColumn("_at", F.spark_partition_id().cast("long"))
    tagged = tagged.withColumn("_mid", F.monotonically_increasing_id())
    before = Window.orderBy("_file", "_at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (tagged.groupBy("_file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_low"))
              .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low"))
              .select("_file", "_at", "_off"))
    return (tagged.join(blocks, ["_file", "_at"])
            .withColumn(name, F.col("_off") + F.col("_mid"))
            .drop("_file", "_at", "_mid", "_off"))


def unique_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, gap-allowed id (R2); enough wherever only identity matters."""
    return df.withColumn(name, F.monotonically_increasing_id())


def parse_basket_lines(lines: DataFrame, id_col: str = "basket_id", value_col: str = "value",
                       trim: bool = False) -> DataFrame:
    """Ragged comma lists -> long form ``(basket_id, item)``.

    Items are split on ``,`` and kept as written unless ``trim``.  Empty items are
    dropped (an empty product name is not a product); a basket left with no item
    keeps one row with a NULL item so that it survives as an empty basket.
    """
    items = F.split(F.col(value_col), ",")
    if trim:
        items = F.transform(items, lambda x: F.trim(x))
    items = F.filter(items, lambda x: x != F.lit(""))
    return lines.select(F.col(id_col).cast("long").alias("basket_id"),
                        F.explode_outer(items).alias("item"))


def read_basket_lines(spark: SparkSession, path: str, trim: bool = False) -> DataFrame:
    """One basket per text line, comma-separated products, no header, no id.

    The line's dense position in the file is its ``basket_id``.
    """
    lines = dense_row_index(spark.read.text(path), "basket_id")
    return parse_basket_lines(lines, trim=trim)


def parse_catalog_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``"product, Level1/Level2/Level3"`` lines -> ``(product, path)``.

    The product is the text before the first comma, as written; the path is the
    second comma field, trimmed.  A line without a comma fails the job and is
    named; ``rejected_catalog_lines`` lists such lines beforehand.
    """
    parts = F.split(F.col(value_col), ",")
    path = F.when(F.size(parts) >= 2, F.trim(F.get(parts, F.lit(1)))).otherwise(
        F.raise_error(F.concat(F.lit("catalogue line without a path: "), F.col(value_col))))
    return lines.where(F.col(value_col).isNotNull()).select(F.element_at(parts, 1).alias("product"), path.alias("path"))


def rejected_catalog_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The lines that ``parse_catalog_lines`` cannot read: those without a comma."""
    return lines.where(F.col(value_col).isNotNull() & ~F.col(value_col).contains(","))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return parse_catalog_lines(spark.read.text(path))


def incoming_baskets(spark: SparkSession, rows: Iterable[tuple[int, int, str]],
                     trim: bool = False) -> DataFrame:
    """In-memory incoming baskets ``(basket_id, customer_id, line)`` -> long form
    ``(basket_id, customer_id, item)`` (S3)."""
    return parse_incoming_lines(spark.createDataFrame(list(rows), "basket_id long, customer_id long, line string"), trim)


def parse_incoming_lines(lines: DataFrame, trim: bool = False) -> DataFrame:
    """``(basket_id, customer_id, line)`` -> long form ``(basket_id, customer_id, item)``: the form of S3 that
    batches and micro-batches share."""
    with_both = lines.select("line", F.struct("basket_id", "customer_id").alias("_of"))
    items = F.filter(F.split("line", ","), lambda x: (F.trim(x) if trim else x) != F.lit(""))
    return with_both.select(F.col("_of.basket_id").alias("basket_id"), F.col("_of.customer_id").alias("customer_id"),
                            F.explode_outer(F.transform(items, F.trim) if trim else items).alias("item"))
