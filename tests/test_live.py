"""Runs that follow a folder give, after every batch and restart, the figures of a bounded run over the same chunks."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from helpers import make_run
from seqloom.operators import library
from seqloom.plans.run import classified, read_pairs, run_designs, spike_in_kmers
from seqloom.sinks.store import kept
from seqloom.sources import tables
from seqloom.streaming import incremental, live


@pytest.fixture
def arriving(tmp_path):
    """The chunks of a small run, in the order of their arrival: lists of (name, bytes)."""
    make_run(str(tmp_path))
    source, steps = tmp_path / "fastq", [[], [], []]
    for name in sorted(os.listdir(source)):
        with gzip.open(source / name) as f:
            lines = f.readlines()
        os.remove(source / name)
        third = len(lines) // 12 * 4
        for k in range(3):
            part = lines[k * third : (k + 1) * third if k < 2 else None]
            if "_I1_" not in name:
                steps[k].append((name.replace("_001.fastq", f"_00{k + 1}.fastq"), gzip.compress(b"".join(part))))
    return tmp_path, steps


def bounded(spark, c):
    """The metrics of all that is in the folder, in one go."""
    designs = run_designs(spark, c)
    units = kept(classified(kept(read_pairs(spark, c.input_dir), "reads"), designs, c, spike_in_kmers(spark, c)), "units")
    und = F.lower("sample").startswith("undetermined")
    totals = library.rolled_up(library.sample_totals(units), [], und)
    full = library.zero_filled(library.rolled_up(library.count_matches(units), ["ref_index"], und), designs, totals)
    return library.library_metrics(full).join(library.control_metrics(totals).drop("mapped_reads"), "sample")


def by_value(df):
    return str(sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str))


def test_batches_equal_bounded_runs(spark, arriving):
    root, steps = arriving
    c = tables.RunConfig.load(str(root / "run.ini")).checked()
    for k, files in enumerate(steps):
        for name, data in files:
            (root / "fastq" / name).write_bytes(data)
        late = root / "fastq/late_S9_L001_R1_009.fastq"
        if k == 1:
            late.write_text("@x\nACGT\n+\nIIII\n")  # without its mate it isn't read yet
        live.follow(spark, c, str(root / "live"), str(root / "cp"), once=True).awaitTermination()  # each time from the checkpoint
        late.unlink(missing_ok=True)
        got, want = live.metrics_so_far(spark, c, str(root / "live")), bounded(spark, c)
        assert got.count() == 4 and by_value(got) == by_value(want)
        live.follow_metrics(spark, c, str(root / "live"), str(root / "cp3"), once=True).awaitTermination()
        assert by_value(live.followed_metrics(spark, c, str(root / "live"))) == by_value(want)
    assert sorted(os.listdir(root / "live/counts")) == ["batch=0", "batch=1", "batch=2"]
    live.follow(spark, c, str(root / "live"), str(root / "cp"), once=True).awaitTermination()  # nothing new
    assert len(os.listdir(root / "live/counts")) == 3


def test_stream_of_reads(spark, arriving):
    """Rows of a stream are those of a scan; a file that is gone after its batch doesn't matter."""
    root, steps = arriving
    fastq, seen = root / "fastq", []
    for k, files in enumerate(steps):
        for name, data in files:
            (fastq / name).write_bytes(data)
        want = {tuple(r)[1:] for r in live_scan(spark, fastq)}
        query = live.stream_reads(spark, str(fastq), reads="R1,R2").writeStream.option("checkpointLocation", str(root / "cp2")).foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect()))).trigger(availableNow=True).start()
        query.awaitTermination()
        for name, _ in files:
            os.remove(fastq / name)
        assert {r[1:] for r in seen} >= want and len(seen) == len(set(seen))
    assert len(seen) == 2 * 1093


def live_scan(spark, folder):
    from seqloom.sources.fastq import read_fastq

    return read_fastq(spark, str(folder), reads="R1,R2").collect()


def test_cells_follow_counts(spark, tmp_path):
    """After every batch the metrics are those of all counts: odd rows add nothing, a batch that is written again is added once."""
    n = incremental.BLOCK + 7
    designs = spark.range(n).select(F.col("id").alias("ref_index"), F.lit(1).cast("long").alias("n_ids"), (F.col("id") % 3 + 10).cast("int").alias("length"), (F.col("id") % 5 * 10.0).alias("gc"))
    samples = spark.createDataFrame([("a",), ("b",), ("unread",)], "sample string")
    last = n - 1
    batches = [
        [("a", 0, 5, 1), ("a", last, 2, 0), ("b", 3, 0, 1), (None, 3, 1, 1), ("b", None, 1, 1), ("b", 4, None, 2)],
        [("a", 0, 1, 0), ("a", 7, 4, 4)],
        [],
        [("b", 3, 0, 0), ("b", last, 600, 3), ("a", incremental.BLOCK, 1, 0)],
    ]
    so_far, folder = [], str(tmp_path)
    for k, rows in enumerate(batches):
        so_far += [r for r in rows if None not in r[:2]]
        for again in range(2 if k == 1 else 1):
            spark.createDataFrame(rows, "sample string, ref_index long, exact long, near long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/counts/batch={k}")
            incremental.follow_counts(spark, designs, f"{folder}/counts", f"{folder}/cells", f"{folder}/cp", once=True).awaitTermination()
        counts = spark.createDataFrame(so_far, "sample string, ref_index long, exact long, near long").na.fill(0).groupBy("sample", "ref_index").agg(F.sum("exact").alias("exact"), F.sum("near").alias("near"))
        full = library.zero_filled(counts, designs, samples)
        want = full.groupBy(*library.CELL).agg(F.count("*").alias("m"), *[F.sum(c).alias(to) for c, to in (("n_ids", "ids"), ("exact", "exact"), ("near", "near"))])
        assert by_value(incremental.latest_cells(spark, designs, f"{folder}/cells", samples)) == by_value(want)
    assert by_value(incremental.latest_metrics(spark, designs, f"{folder}/cells", samples)) == by_value(library.library_metrics(full))
