"""Comparing two clusterings: contingency table (A6), marginals (A7) and the
Adjusted Rand Index (A8), with the pair count C(n, 2) (P13) and the row-id
join of two labelings (J1).

ARI = (I - E) / (0.5 * (A + B) - E), with I = sum C(n_ij, 2),
A = sum C(a_i, 2), B = sum C(b_j, 2), E = A * B / C(N, 2); NaN when the
divisor (or C(N, 2)) is 0.  All in double.  ``compat_first_row=True`` sums I
over the cells of label_a = 0 only, as a loop that never resets its column
counter does.

Everything is one contingency aggregate (partial aggregation: each task sends
at most k1 x k2 rows) plus window and global aggregates over that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAN = float("nan")


def pairs(n: Column) -> Column:
    """C(n, 2) in double."""
    n = n.cast("double")
    return n * (n - F.lit(1.0)) / F.lit(2.0)


def join_labelings(a: DataFrame, b: DataFrame, id_col: str = "row_id", label_col: str = "label") -> DataFrame:
    """``(row_id, label)`` x ``(row_id, label)`` -> ``(row_id, label_a, label_b)``."""
    return (a.select(id_col, F.col(label_col).alias("label_a"))
            .join(b.select(id_col, F.col(label_col).alias("label_b")), id_col, "inner"))


def contingency(df: DataFrame, a: str = "label_a", b: str = "label_b", weight: str | None = None,
                by: tuple[str, ...] = ()) -> DataFrame:
    """``(label_a, label_b, n)`` for every non-empty cell (A6); ``weight``: column with the
    number of labelled rows that a row of ``df`` stands for; ``by``: columns that tell several
    pairs of labelings apart, which are kept."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*by, F.col(a).alias("label_a"), F.col(b).alias("label_b")).agg(n.alias("n"))


def marginals(cont: DataFrame) -> DataFrame:
    """``(side, label, n)``: row sums (side 'a') and column sums (side 'b')."""
    both = F.array(F.struct(F.lit("a").alias("side"), F.col("label_a").alias("label"), F.col("n").alias("n")),
                   F.struct(F.lit("b").alias("side"), F.col("label_b").alias("label"), F.col("n").alias("n")))
    return (cont.select(F.explode(both).alias("m"))
            .groupBy(F.col("m.side").alias("side"), F.col("m.label").alias("label"))
            .agg(F.sum("m.n").alias("n")))


def ari_table(df: DataFrame, a: str = "label_a", b: str = "label_b", compat_first_row: bool = False,
              weight: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """One row (per value of ``by``): ``n, index, sum_a, sum_b, expected, max_index, ari``.

    The labelled rows are read once: the contingency table (at most k1 x k2
    rows) carries its row and column sums as window aggregates, and one global
    aggregate reads each row sum and column sum from the first cell of its row
    or column.
    """
    cont = contingency(df, a, b, weight, by)
    by_a, by_b = Window.partitionBy(*by, "label_a"), Window.partitionBy(*by, "label_b")
    cells = (cont
             .withColumn("row_n", F.sum("n").over(by_a))
             .withColumn("row_first", F.row_number().over(by_a.orderBy("label_b")) == 1)
             .withColumn("col_n", F.sum("n").over(by_b))
             .withColumn("col_first", F.row_number().over(by_b.orderBy("label_a")) == 1))
    in_index = (F.col("label_a") == 0) if compat_first_row else F.lit(True)
    sums = cells.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(in_index, pairs(F.col("n")))), F.lit(0.0)).alias("index"),
        F.sum(F.when(F.col("row_first"), pairs(F.col("row_n")))).alias("sum_a"),
        F.sum(F.when(F.col("col_first"), pairs(F.col("col_n")))).alias("sum_b"))
    pn = pairs(F.col("n"))
    expected = F.when(pn == 0, F.lit(NAN)).otherwise(F.col("sum_a") * F.col("sum_b") / pn)
    max_index = F.lit(0.5) * (F.col("sum_a") + F.col("sum_b"))
    res = sums.withColumn("expected", expected).withColumn("max_index", max_index)
    den = F.col("max_index") - F.col("expected")
    return res.withColumn("ari", F.when(den.isNull() | (den == 0) | F.isnan(den), F.lit(NAN))
                          .otherwise((F.col("index") - F.col("expected")) / den))


def adjusted_rand_index(df: DataFrame, a: str = "label_a", b: str = "label_b",
                        compat_first_row: bool = False, weight: str | None = None) -> float:
    """Scalar ARI (one row reaches the driver)."""
    row = ari_table(df, a, b, compat_first_row, weight).select("ari").first()
    return float("nan") if row is None or row[0] is None else float(row[0])
