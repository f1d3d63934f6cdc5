"""Incremental counts over newly arriving tables of units.

All counters of a run are additive, so a stream of per-unit rows (written chunk by chunk) keeps counts per sample
and design up to date; no watermark is needed, since a count never closes. State grows with samples times designs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from seqloom.operators.library import count_matches


def stream_counts(spark: SparkSession, folder: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """Streaming (sample, ref_index, exact, near) of the Parquet unit tables that arrive in ``folder``."""
    units = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)
    return count_matches(units)


def start(counts: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Writes the whole counts after each batch as a Parquet table of their own."""

    def save(frame: DataFrame, batch: int) -> None:
        frame.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    writer = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer).start()
