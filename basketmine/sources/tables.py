"""Adapters from the parquet tables of a scale-factor folder to the data model.

basket   = an order (``orders.o_orderkey``); orders without line items are
           empty baskets
item     = the part of a line item (``lineitem.l_partkey``, kept numeric: a
           long join key hashes and shuffles cheaper than its text)
customer = ``orders.o_custkey``
catalogue path = ``p_type/p_brand`` (two category levels per part)

Only the needed columns are selected, so the parquet scans read just those
(``ReadSchema``) and status filters reach the scan (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(product, path)`` with path ``p_type/p_brand``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product"),
        F.concat_ws("/", "p_type", "p_brand").alias("path"))


def has_status(col: str, statuses: list[str]) -> Column:
    """True or false, never NULL: an order without a status has none of the given ones."""
    return F.coalesce(F.col(col).isin(statuses), F.lit(False))


def orders(spark: SparkSession, sf_dir: str, statuses: list[str] | None = None,
           exclude: bool = False, with_status: bool = False) -> DataFrame:
    """``(basket_id, customer_id[, status])`` for orders of the given statuses (all if None)."""
    o = table(spark, sf_dir, "orders")
    if statuses is not None:
        o = o.where(~has_status("o_orderstatus", statuses) if exclude else F.col("o_orderstatus").isin(statuses))
    cols = [F.col("o_orderkey").alias("basket_id"), F.col("o_custkey").alias("customer_id")]
    if with_status:
        cols.append(F.col("o_orderstatus").alias("status"))
    return o.select(*cols)


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows ``(basket_id, item)`` of all orders."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_partkey").alias("item"))


def order_baskets(spark: SparkSession, sf_dir: str, statuses: list[str] | None = None,
                  exclude: bool = False) -> DataFrame:
    """Long-form baskets ``(basket_id, customer_id, item)``.

    A left join keeps orders without line items as one row with a NULL item.
    """
    return orders(spark, sf_dir, statuses, exclude).join(line_items(spark, sf_dir), "basket_id", "left")


def encoded_orders(spark: SparkSession, sf_dir: str, catalog: DataFrame, statuses: list[str] | None = None,
                   exclude: bool = False, mode: str = "exact", with_status: bool = False,
                   vocab: list[str] | None = None) -> DataFrame:
    """Encoded baskets ``(basket_id, customer_id, words, items)`` of the selected orders.

    Line items are matched to categories and reduced to one row per order
    before they meet the orders table.
    """
    from basketmine.operators.encode import encode_baskets
    return encode_baskets(line_items(spark, sf_dir), catalog, mode,
                          header=orders(spark, sf_dir, statuses, exclude, with_status), vocab=vocab)


def order_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(basket_id, items)``: the distinct parts of every order as an array (``[]`` without line items)."""
    held = line_items(spark, sf_dir).groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return (orders(spark, sf_dir).select("basket_id").join(held, "basket_id", "left")
            .withColumn("items", F.coalesce("items", F.array().cast("array<bigint>"))))


# The open orders are the incoming baskets to be scored and promoted; where a query
# needs baskets to train on beside them, these are all other orders, those without
# a status among them.
OPEN_STATUS = ["O"]


def encoded_split(spark: SparkSession, sf_dir: str, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(training, incoming)`` from one encode of all orders (cached), so the
    line items are scanned and aggregated once for both sides.  Every order is in exactly one of them."""
    from basketmine.session import keep
    enc = keep(encoded_orders(spark, sf_dir, catalog, with_status=True))
    open_ = has_status("status", OPEN_STATUS)
    return enc.where(~open_).drop("status"), enc.where(open_).drop("status")
