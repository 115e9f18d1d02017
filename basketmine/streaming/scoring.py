"""Scoring streams of incoming baskets with a trained model.

Scoring is stateless (a join with the static link table plus row-local
distances).  ``score_encoded_stream`` runs it as a plain stream-static plan
on already encoded baskets.  ``score_stream`` takes raw basket lines: encoding
them needs a per-basket aggregate, so each micro-batch is parsed, encoded
against the catalogue and predicted inside ``foreachBatch`` exactly like a
batch.  A batch is written to its own ``batch_id`` partition, which a replay after a
restart replaces, so no basket is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketmine.operators.ckmeans import ConstrainedKMeansModel
from basketmine.operators.encode import encode_baskets
from basketmine.sources.text import parse_incoming_lines


def score_batch(model: ConstrainedKMeansModel, lines: DataFrame, catalog: DataFrame,
                match: str = "exact", score_against: str = "seeds") -> DataFrame:
    """``(basket_id, customer_id, line)`` -> ``(basket_id, customer_id, items, prediction, known_customer)``."""
    enc = encode_baskets(parse_incoming_lines(lines), catalog, match)
    return model.predict(enc, score_against).select(
        "basket_id", "customer_id", "items", "prediction", "known_customer")


def write_batch(scored: DataFrame, batch_id: int, output_path: str) -> None:
    """Write one micro-batch; written again, it replaces itself and nothing else."""
    (scored.withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(output_path))


def score_stream(model: ConstrainedKMeansModel, lines: DataFrame, catalog: DataFrame, output_path: str,
                 checkpoint_path: str, match: str = "exact", trigger_once: bool = False) -> StreamingQuery:
    """Start a streaming query that writes scored baskets to ``output_path``, partitioned by ``batch_id``."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(score_batch(model, batch, catalog, match), batch_id, output_path)

    writer = lines.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def score_encoded_stream(model: ConstrainedKMeansModel, baskets: DataFrame, output_path: str,
                         checkpoint_path: str, score_against: str = "seeds",
                         trigger_once: bool = False) -> StreamingQuery:
    """Stream of already encoded baskets ``(basket_id, customer_id, items)``
    -> appended predictions, as a plain stream-static plan: a left join of the
    stream with the static link table plus row-local distances; no state, no
    watermark, exactly-once through the checkpoint and the file sink."""
    scored = model.predict(baskets, score_against).select(
        "basket_id", "customer_id", "items", "prediction", "known_customer")
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", output_path).option("checkpointLocation", checkpoint_path))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
