"""Library statistics kept up to date from the counts that each batch adds, at the cost of the designs that changed.

Two states follow the counts. The totals of a sample's designs lie in the state store, ``BLOCK`` designs to a value, so a block's size is bounded and a
sample of any share of the reads is spread over its blocks; a batch reads and writes the blocks it touches, and hands on what its designs had and have.
From those moves come the counts of counts: how many designs of one length, gc and total a sample has, as differences from a library without
reads. They are a table a version, made of the version before and the moves, and all statistics are computed from it.

A batch of counts holds a sample and design once. Its number is kept with the design, so counts that a follower writes again after a
failure are added once; numbers must not fall. Moves and versions follow the number of the stream's own batch, so both states survive lost executors and restarts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from seqloom.operators import library
from seqloom.sinks.store import kept

BLOCK = 4096  # designs of a sample that one state value holds
COUNTS = "sample string, ref_index long, exact long, near long, batch long"
MOVES = "sample string, ref_index long, exact0 long, near0 long, exact long, near long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BlockTotals(StatefulProcessor):
    """Totals of one sample's block of designs; gives a row (see MOVES) for each design that a batch changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "exact array<long>, near array<long>, batch array<long>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        if self.totals.exists():
            exact, near, batch = (np.array(x, np.int64) for x in self.totals.get())
        else:
            exact, near, batch = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64), np.full(BLOCK, -1, np.int64)
        had = exact.copy(), near.copy()
        start = key[1] * BLOCK
        given = pd.concat([x[["ref_index", "exact", "near", "batch"]] for x in rows]).sort_values("batch", kind="stable")
        for number, new in given.groupby("batch"):  # batches that arrived together, not rows
            place = new["ref_index"].to_numpy(np.int64) - start
            fresh = batch[place] < number
            place, new = place[fresh], new[fresh]
            exact[place] += new["exact"].to_numpy(np.int64)
            near[place] += new["near"].to_numpy(np.int64)
            batch[place] = number
        self.totals.update((exact.tolist(), near.tolist(), batch.tolist()))
        at = np.flatnonzero((exact != had[0]) | (near != had[1]))
        yield pd.DataFrame({"sample": key[0], "ref_index": at + start, "exact0": had[0][at], "near0": had[1][at], "exact": exact[at], "near": near[at]})

    def close(self) -> None:
        pass


def moves(counts: DataFrame) -> DataFrame:
    """Of a stream of ``counts`` (COUNTS): each design's totals before and after a batch, for those that change. Rows without a sample, design or batch add nothing."""
    whole = counts.where("sample is not null and ref_index is not null and batch is not null").na.fill(0, ["exact", "near"])
    blocks = whole.withColumn("block", F.floor(F.col("ref_index") / BLOCK))
    return blocks.groupBy("sample", "block").transformWithStateInPandas(statefulProcessor=BlockTotals(), outputStructType=MOVES, outputMode="Update", timeMode="None")


def moved_cells(moved: DataFrame, designs: DataFrame) -> DataFrame:
    """What ``moved`` takes from and adds to the cells of equal length, gc and count; a design leaves one cell and comes to another."""
    one, ids = F.lit(1).cast("long"), F.col("n_ids").cast("long")
    cell = lambda sign, e, n: F.struct((F.col(e) + F.col(n)).alias("total"), (sign * one).alias("m"), (sign * ids).alias("ids"), (sign * F.col(e)).alias("exact"), (sign * F.col(n)).alias("near"))
    both = moved.join(designs.select("ref_index", "n_ids", "length", "gc"), "ref_index")
    return both.select("sample", "length", "gc", F.inline(F.array(cell(-1, "exact0", "near0"), cell(1, "exact", "near"))))


def follow_counts(spark: SparkSession, designs: DataFrame, counts: str, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keeps the cells of the ``batch=N`` tables that appear below ``counts`` at ``out``, a version a batch; ``once`` takes what is there and ends."""
    designs = kept(designs.select("ref_index", "n_ids", "length", "gc"), "designs")

    def advance(batch: DataFrame, number: int) -> None:
        cells = moved_cells(kept(batch, "moves"), designs)
        if number:
            cells = cells.unionByName(spark.read.parquet(f"{out}/version={number - 1}"))
        library.summed_cells(cells).write.mode("overwrite").parquet(f"{out}/version={number}")

    writer = moves(spark.readStream.schema(COUNTS).parquet(counts)).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(advance)
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # a query keeps what its session says when it starts
    try:
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        spark.conf.set(PROVIDER, before)


def latest_cells(spark: SparkSession, designs: DataFrame, out: str, samples: DataFrame | None = None) -> DataFrame:
    """The cells of the last version; ``samples`` without reads have theirs too."""
    versions = spark.read.parquet(out)
    last = versions.where(F.col("version") == versions.agg(F.max("version")).first()[0]).drop("version")
    samples = (last if samples is None else samples).select("sample").distinct()
    zero = F.lit(0).cast("long")
    unread = designs.groupBy("length", "gc").agg(F.count("*").alias("m"), F.sum("n_ids").alias("ids")).withColumns({"total": zero, "exact": zero, "near": zero})
    return library.summed_cells(unread.crossJoin(samples).unionByName(last)).where("m > 0")  # lengths and gc contents by samples


def latest_metrics(spark: SparkSession, designs: DataFrame, out: str, samples: DataFrame | None = None) -> DataFrame:
    """``library.library_metrics`` of all counts so far."""
    return library.cell_metrics(latest_cells(spark, designs, out, samples))
