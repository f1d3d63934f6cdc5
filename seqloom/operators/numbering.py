"""Places of rows in an order, by counts and offsets: no task sees all rows."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.sinks.store import kept


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in ``order``, whose values are unique.

    Rows are dealt to tasks by ranges of the order and sorted there; a task's first place is the number of rows of the ranges before it, one count a task.
    """
    span = 1 << 33  # rows of a partition
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("_id"))
    placed = kept(placed, "numbered").withColumns({"_part": F.floor(F.col("_id") / span), "_at": F.pmod("_id", F.lit(span))})
    counts = sorted(map(tuple, placed.groupBy("_part").agg(F.count("*").alias("n")).collect()))
    before = [0, *accumulate(n for _, n in counts)]
    offsets = rows.sparkSession.createDataFrame([(part, b) for (part, _), b in zip(counts, before, strict=False)], "_part long, _before long")
    return placed.join(F.broadcast(offsets), "_part").select(*rows.columns, (F.col("_before") + F.col("_at")).alias(name))


def first_rows(rows: DataFrame, by: list[str], chunk: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group in the order of ``chunk`` and, inside a chunk, of ``order``.

    Rows are counted by chunk, and prefix sums of the counts say in which chunk a group's budget ends. Chunks before it are taken whole, those after it are left; only that
    one's rows are sorted. There is one such chunk for each group (a sample).
    """
    counts = rows.groupBy(*by, F.struct(*chunk).alias("_chunk")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ends = counts.withColumn("_before", before).where(F.col("_before") < n).groupBy(*by).agg(F.max(F.struct("_chunk", "_before")).alias("_end"))
    ends = ends.withColumnsRenamed({c: f"_by_{c}" for c in by})
    met = rows.join(F.broadcast(ends), reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])).select(*rows.columns, F.struct(*chunk).alias("_chunk"), "_end")
    whole = met.where(F.col("_chunk") < F.col("_end._chunk")).select(*rows.columns)
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    cut = met.where(F.col("_chunk") == F.col("_end._chunk")).withColumn("_place", place).where(F.col("_place") + F.col("_end._before") <= n)
    return whole.union(cut.select(*rows.columns))
