"""Exact deduplication by distributed MSD radix partitioning.

Documents start as one group. A round splits every open group by the next slice of its documents' bytes, most significant first: documents stay
together only if the slice and whether it ends the text are equal. A group of one is done, and so is one whose texts have ended, which
are then equal byte by byte; no digest decides. The rest of an open document goes to the next round. Slices grow by ``GROWTH`` up to
``MOST`` bytes, so the rounds are few, and each byte of a text is compared once.

Slices are counted by partial aggregation, so copies that a task reads shrink to one row before the shuffle. The join that gives documents their group is
salted where a slice is frequent. Nothing gathers a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import free_name, salted_join, stage

FIRST, GROWTH, MOST = 64, 16, 1 << 20


def _grouped(rows: DataFrame, first: int, growth: int, most: int) -> DataFrame:
    """(doc_id, row, keep_id, group_size, kept, text_sha256) of ``rows(doc_id, row, text)``."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    open_ = rows.select("doc_id", "row", text.alias("rest"), F.lit(0).cast("long").alias("group"), F.sha2(text, 256).alias("sha"))
    width, turn, ended = first, 0, []
    while True:
        slice_, after = F.substring("rest", 1, width), F.substring("rest", width + 1, 2**31 - 1)
        keyed = open_.select("doc_id", "row", "group", "sha", slice_.alias("slice"), (F.octet_length("rest") <= width).alias("ends"), after.alias("rest"))
        key = ["group", "slice", "ends"]
        many = keyed.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
        many = stage(many.withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        met = salted_join(keyed, many, key, "n", "left")
        on = F.col("next").isNotNull() & ~F.col("ends")
        met = met.select("doc_id", "row", F.lit(turn).alias("turn"), F.col("next").alias("group"), on.alias("on"), "sha", F.when(on, F.col("rest")).alias("rest"))
        met = stage(met, "radix-round")
        ended.append(met.where("not on").drop("on", "rest"))
        open_ = met.where("on").select("doc_id", "row", "rest", "group", "sha")
        if many.where("not ends").isEmpty():
            break
        width, turn = min(width * growth, most), turn + 1
    done = reduce(DataFrame.union, ended)
    groups = done.where("group is not null").groupBy("turn", "group").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("best"))
    met = salted_join(done.where("group is not null"), stage(groups, "radix-copies"), ["turn", "group"], "n")
    met = met.select("doc_id", "row", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))
    alone = done.where("group is null").select("doc_id", "row", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return met.union(alone)


def copies(docs: DataFrame, first: int = FIRST, growth: int = GROWTH, most: int = MOST) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs(doc_id, text)``.

    Null texts are empty, and empty texts are equal. Of equal texts one row is kept: the one with the largest doc_id, of several with that id
    any one; rows without an id come last, so keep_id is null only where no row of the group has an id. Further columns are
    ignored; empty input gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return _grouped(rows, first, growth, most).drop("row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, whole; the rules are those of ``copies``. Columns may have any name."""
    row = free_name(docs, "_row")
    held = stage(docs.withColumn(row, F.monotonically_increasing_id()), "radix-rows")
    gone = _grouped(held.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"), "text"), FIRST, GROWTH, MOST).where("not kept")
    return held.join(gone.select(F.col("row").alias(row)), row, "left_anti").select(*docs.columns)


ORACLE_SQL = """select doc_id, last_value(doc_id) over same keep_id, count(*) over same group_size,
row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 kept, sha256(coalesce(text, '')) text_sha256
from documents window same as (partition by coalesce(text, '') order by doc_id nulls first rows between unbounded preceding and unbounded following)"""
