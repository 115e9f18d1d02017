from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names clash with what operators add."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(brute.odd_documents(), brute.SCHEMA)
    for name in ("score", "fp", "label", "x", "start", "ids", "kept", "slot", "chunk", "round", "payload", "held", "node",
                 "u", "v", "k", "h", "size", "m0", "l00", "cut", "all", "seg", "key", "first", "parts", "dc_spans", "ss_text", "lic_found", "main_text", "_chunk", "distance", "n_words"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    """The same columns without rows."""
    return odd.where("false")
