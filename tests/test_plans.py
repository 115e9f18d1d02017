"""Plan-level guards over every registered query: no cross or nested-loop
joins, and the line-item scan reads only the two columns it needs."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest

from samples import SF_SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_registered_plans(spark):
    checked = 0
    from basketmine.plans.queries import QUERIES
    for name, fn in QUERIES.items():
        text = plan_text(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        for schema in re.findall(r"lineitem\.parquet.*?ReadSchema: (struct<[^>]*>)", text):
            assert schema == "struct<l_orderkey:bigint,l_partkey:bigint>" or schema == "struct<l_partkey:bigint>", \
                (name, schema)
            checked += 1
        spark.catalog.clearCache()
    assert checked >= 20


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
def test_labelings_need_one_aggregate_of_the_baskets(spark):
    """The customer table of a walk: one hash aggregate on customer_id, no sort aggregate, and
    each k is labelled without another join or aggregate."""
    from basketmine.operators.ckmeans import customer_label, customer_table
    from basketmine.plans import queries as q
    rows, seeds = customer_table(q.baskets(spark, SF_SMALL), 9, 1)
    plan = plan_text(rows.select("n_baskets", customer_label(seeds, 8), customer_label(seeds, 9)))
    physical = plan[plan.index("== Physical Plan =="):]
    assert len(re.findall(r"HashAggregate\(keys=\[customer_id#\d+L\]", physical)) == 2      # partial and final
    assert "SortAggregate" not in physical
    bare = plan_text(rows)
    bare = bare[bare.index("== Physical Plan =="):]
    for node in ("Join", "Exchange", "Aggregate"):
        assert physical.count(node) == bare.count(node)
