"""A run that follows its folder: chunks are matched as they arrive, and the library's statistics are those of all chunks so far.

Each batch adds the counts of its chunks, rolled up, under its number, so a batch that is run again after a failure replaces its own. All counters are additive:
the statistics after a batch come from the sums of the counts (``metrics_so_far``), or from states that change with the designs of the batch alone
(``follow_metrics``), never from reads again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqloom.operators import library
from seqloom.plans.run import classified, run_designs, spike_in_kmers
from seqloom.sinks.store import kept
from seqloom.sources.fastq import FastqSource
from seqloom.sources.tables import RunConfig
from seqloom.streaming import incremental


def stream_reads(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """The reads (or, with ``pairs``, the pairs) of a folder's chunks as they come."""
    spark.dataSource.register(FastqSource)
    return spark.readStream.format("fastq").options(**options).load(root)


def _rolled(counts: DataFrame, keys: list[str]) -> DataFrame:
    return library.rolled_up(counts, keys, F.lower("sample").startswith("undetermined"))


def follow(spark: SparkSession, c: RunConfig, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Starts counting the pairs below ``c.input_dir`` into ``out``; ``once`` takes what is there and ends."""
    c = c.checked()
    designs, kmers = kept(run_designs(spark, c), "designs"), spike_in_kmers(spark, c)
    kmers = kmers if kmers is None else kept(kmers, "kmers")

    def add(batch: DataFrame, number: int) -> None:
        units = kept(classified(kept(batch, "stream-reads"), designs, c, kmers), "stream-units")
        for name, counts in (("counts", _rolled(library.count_matches(units), ["ref_index"])), ("totals", _rolled(library.sample_totals(units), []))):
            counts.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    writer = stream_reads(spark, c.input_dir, pairs="true").writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _summed(spark: SparkSession, out: str, name: str, keys: list[str]) -> DataFrame:
    parts = spark.read.parquet(f"{out}/{name}").drop("batch")
    return parts.groupBy("sample", *keys).agg(*[F.sum(x).alias(x) for x in parts.columns if x not in ("sample", *keys)])


def metrics_so_far(spark: SparkSession, c: RunConfig, out: str) -> DataFrame:
    """The run's metrics by sample and roll-up from the counts of all batches."""
    totals = kept(_summed(spark, out, "totals", []), "totals")
    full = library.zero_filled(_summed(spark, out, "counts", ["ref_index"]), run_designs(spark, c), totals)
    return library.library_metrics(full).join(library.control_metrics(totals).drop("mapped_reads"), "sample")


def follow_metrics(spark: SparkSession, c: RunConfig, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keeps the library's cells below ``out`` up to date with the counts that ``follow`` writes there."""
    return incremental.follow_counts(spark, run_designs(spark, c), f"{out}/counts", f"{out}/cells", checkpoint, once)


def followed_metrics(spark: SparkSession, c: RunConfig, out: str) -> DataFrame:
    """``metrics_so_far`` by way of the cells: no count of an earlier batch is read again."""
    totals = kept(_summed(spark, out, "totals", []), "totals")
    metrics = incremental.latest_metrics(spark, run_designs(spark, c), f"{out}/cells", totals)
    return metrics.join(library.control_metrics(totals).drop("mapped_reads"), "sample")
