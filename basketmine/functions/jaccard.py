"""Jaccard distance between category sets (P6), its "don't-care" form against
mean centroids (P7) and the arg-min over clusters (A4), as column expressions.

Sets are ``array<string>`` of distinct categories.  A binary vector counts
M11 (both 1), M10 (centroid 1, basket 0) and M01 (centroid 0, basket 1);
distance = (M01 + M10) / (M11 + M01 + M10), rounded to float, NaN when the
denominator is 0.  Against a mean centroid only weights of exactly 1 ("ones")
and exactly 0 (outside "support") count; fractional weights count nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from basketmine.functions import bitwords

NAN = float("nan")


def _str_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def dontcare_distance(ones: Column, support: Column, basket: Column) -> Column:
    m11 = F.size(F.array_intersect(ones, basket))
    m10 = F.size(ones) - m11
    m01 = F.size(basket) - F.size(F.array_intersect(support, basket))
    return _float_ratio(m01 + m10, m11 + m01 + m10)


def _float_ratio(num: Column, den: Column) -> Column:
    # float division as in a 32-bit quotient: the double quotient of two small
    # integers rounded to float is the correctly rounded float quotient
    quotient = (num.cast("double") / den.cast("double")).cast("float").cast("double")
    return F.when(den == 0, F.lit(NAN)).otherwise(quotient)


def jaccard_distance(a: Column, b: Column) -> Column:
    """Distance of two binary sets; NaN when both are empty.  One intersection:
    M11 = |a & b|, M01 + M10 = |a| + |b| - 2 M11."""
    m11 = F.size(F.array_intersect(a, b))
    diff = F.size(a) + F.size(b) - m11 * 2
    return _float_ratio(diff, diff + m11)


def seed_array(seeds: Sequence[tuple[int, Sequence[str]]]) -> Column:
    """Literal ``array<struct<cid int, ones array<string>, support array<string>>>``
    for binary seeds ``(cluster_id, items)``; ``support`` is NULL, which marks
    a binary centre (ones = support)."""
    return F.array(*[F.struct(F.lit(int(cid)).alias("cid"), _str_array(items).alias("ones"),
                              F.lit(None).cast("array<string>").alias("support")) for cid, items in seeds])


def centroid_array(centroids: Sequence[tuple[int, Sequence[str], Sequence[str]]]) -> Column:
    """Literal array for mean centroids ``(cluster_id, ones, support)``."""
    return F.array(*[F.struct(F.lit(int(cid)).alias("cid"), _str_array(ones).alias("ones"),
                              _str_array(support).alias("support")) for cid, ones, support in centroids])


def distances_to(centres: Column, basket: Column) -> Column:
    """``array<struct<d double, cid int>>``: distance of the basket to every centre."""
    def one(c):
        d = F.when(c["support"].isNull(), jaccard_distance(c["ones"], basket)) \
            .otherwise(dontcare_distance(c["ones"], c["support"], basket))
        return F.struct(d.alias("d"), c["cid"].alias("cid"))
    return F.transform(centres, one)


def nearest(centres: Column, basket: Column) -> Column:
    """``struct<d, cid>`` of the closest centre: least distance, then least
    cluster id; NaN sorts after every number."""
    return F.array_min(distances_to(centres, basket))


def word_distance(ones: Column, support: Column | None, basket: Column, n_words: int) -> Column:
    """``dontcare_distance`` of sets as bit words; without ``support`` the centre is binary (support = ones)."""
    m11 = bitwords.overlap(ones, basket, n_words)
    m10 = bitwords.size(ones, n_words) - m11
    m01 = bitwords.size(basket, n_words) - (m11 if support is None else bitwords.overlap(support, basket, n_words))
    return _float_ratio(m01 + m10, m11 + m01 + m10)


@dataclass
class Centres:
    """Centres ``(cluster id, ones, support or None)`` as a literal table of the plan.  ``n_words``: number of
    words of sets that are bit words; None: sets are arrays of names."""
    rows: list[tuple]
    n_words: int | None = None

    def distances(self, basket: Column) -> Column:
        """``array<struct<d double, cid int>>``: distance of the basket to every centre, in their order."""
        if self.n_words is None:
            if all(support is None for _, _, support in self.rows):
                return distances_to(seed_array([(c, ones) for c, ones, _ in self.rows]), basket)
            return distances_to(centroid_array(self.rows), basket)
        binary = all(support is None for _, _, support in self.rows)
        word = lambda ws: F.array(*[F.lit(w).cast("bigint") for w in ws])
        table = F.array(*[F.struct(F.lit(int(c)).alias("cid"), word(ones).alias("ones"),
                                   *([] if binary else [word(ones if support is None else support).alias("support")]))
                          for c, ones, support in self.rows])
        return F.transform(table, lambda c: F.struct(
            word_distance(c["ones"], None if binary else c["support"], basket, self.n_words).alias("d"), c["cid"].alias("cid")))

    def nearest(self, basket: Column) -> Column:
        """``struct<d, cid>`` of the closest centre (see ``nearest``)."""
        return F.array_min(self.distances(basket))


def set_distance(a: Sequence, b: Sequence) -> float:
    """``jaccard_distance`` of two sets (names, or bit words) that the driver holds."""
    if any(isinstance(x, int) for x in (*a, *b)):
        a, b = bitwords.unpack(a), bitwords.unpack(b)
    union = len(set(a) | set(b))
    return float(np.float32((union - len(set(a) & set(b))) / union)) if union else NAN
