"""The session's SQL functions give what the column functions give."""

import gzip
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.functions.session import Kmers, register
from seqloom.operators import controls

SEQS = ["ACGTNacgtn", "", None, "GGGCCC", "ACGT+TTGCAA", "acgtac_ttggcc", "AC", "GGGCCA", "TTT+GGGG"]
HEADS = ["@r/1 1:N:0:ACGTAC", "@r/2 1:N:0:acgtac-ttggcc", "@r 1:N:0:ACG", "  @x/1\t2:N:ACGTACGT_AA ", "@alone:ACGTACGT", None, "@r 1:N:0:ACGTAX", ""]


def test_scalar_functions(spark):
    register(spark)
    register(spark)  # a second time changes nothing
    pairs = spark.createDataFrame([(a, b) for a in SEQS for b in SEQS], "a string, b string")
    sql = ["seq_reverse_complement(a)", "seq_gc_percent(a)", "seq_differing(a, b)", "seq_index_distance(a, b)", "seq_edits(a, b, 3)", "seq_quality_sum(a)"]
    a, b = F.col("a"), F.col("b")
    columns = [S.reverse_complement(a), S.gc_percent(a), S.hamming(a, b), S.index_distance(a, b), S.bounded_levenshtein(a, b, 3), S.phred_sum(a)]
    assert pairs.selectExpr("a", "b", *sql).collect() == pairs.select("a", "b", *columns).collect()
    heads = spark.createDataFrame([(h,) for h in HEADS], "h string")
    assert heads.selectExpr("h", "seq_header_index(h)", "seq_read_id(h)").collect() == heads.select("h", S.header_index(F.col("h")), S.canonical_read_id(F.col("h"))).collect()


def test_kmer_table_and_fastq_view(spark, tmp_path):
    register(spark)
    rows = spark.createDataFrame([(1, "ACGTACGTA"), (2, None), (3, "ACG"), (4, ""), (5, "NNNNACGT")], "id long, seq string")
    for k, stride in ((4, 1), (4, 3), (9, 7), (1, 1)):
        got = spark.sql(f"select * from seq_kmers(table(select id, seq from {{rows}}), {k}, {stride})", rows=rows)
        want = rows.select("id", F.explode(S.kmer_windows(F.col("seq"), k, stride)).alias("kmer"))
        assert sorted((r["id"], r["kmer"]) for r in got.collect()) == sorted((r["id"], r["kmer"]) for r in want.collect())
    (tmp_path / "a_R1_001.fastq.gz").write_bytes(gzip.compress(b"@x 1:N:0:ACGTAC\nACGT\n+\nIIII\n"))
    spark.sql(f"create or replace temporary view reads using fastq options (path '{tmp_path}')")
    assert [tuple(r) for r in spark.sql("select sample, seq_reverse_complement(seq), seq_header_index(header), seq_quality_sum(qual) from reads").collect()] == [("a", "ACGT", "ACGTAC", 160)]


def kmer_rows(batch, k, stride):
    return (r for t in Kmers().eval(batch, pa.array([k]), pa.array([stride])) for r in zip(*[t[c].to_pylist() for c in ("id", "place", "kmer")], strict=True))


@pytest.mark.parametrize(("k", "stride", "step"), [(1, 1, 1), (5, 7, 3), (11, 5, 16), (4, 3, 1000)])
def test_kmer_table_over_steps(monkeypatch, k, stride, step):
    monkeypatch.setattr(controls, "STEP", step)
    rnd = random.Random(step)
    seqs = ["".join(rnd.choice("ACGTN") for _ in range(rnd.choice([0, 1, k - 1, k, k + 1, 70]))) for _ in range(30)] + [None, ""]
    batch = pa.record_batch([pa.array(range(len(seqs))), pa.array(seqs, pa.string())], ["id", "seq"])
    want = [(i, p, s[p : p + k]) for i, s in enumerate(seqs) if s and len(s) >= k for p in sorted({*range(0, len(s) - k + 1, stride), len(s) - k})]
    assert list(kmer_rows(batch, k, stride)) == want


@pytest.mark.parametrize("reads", [200, 1])
def test_kmer_table_in_bounded_memory(reads):
    """What is worked on and handed on together doesn't grow with a batch or a sequence."""
    letters = np.random.default_rng(1).choice(np.frombuffer(b"ACGT", np.uint8), 8_000_000).tobytes().decode()
    batch = pa.record_batch([pa.array(range(reads)), pa.array([letters[i::reads] for i in range(reads)])], ["id", "seq"])
    tracemalloc.start()
    try:
        sizes = [(t.num_rows, t.nbytes) for t in Kmers().eval(batch, pa.array([11]), pa.array([5]))]
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    assert sum(n for n, _ in sizes) == reads * (1 - (11 - len(letters) // reads) // 5)
    assert max(b for _, b in sizes) < 4e6
