"""Packed k-mers, consensus in batches and numbering against plain versions."""

import gc
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import rc
from seqloom.operators import controls, library, matcher
from seqloom.operators.numbering import first_rows, numbered


@pytest.mark.parametrize("k", [1, 5, 27, 31, 32, 51, 62])
def test_packed_codes(k):
    rnd = random.Random(k)
    text = "".join(rnd.choice("ACGTACGTACGTN.") if i > 90 else rnd.choice("ACGT") for i in range(250))
    high, low, good = controls.packed(np.frombuffer(text.encode(), np.uint8), k)
    assert len(low) == len(text) - k + 1
    for i in range(len(low)):
        word = text[i : i + k]
        assert good[i] == (set(word) <= set("ACGT"))
        if good[i]:
            value = sum("ACGT".index(c) << 2 * (k - 1 - j) for j, c in enumerate(word))
            assert (int(high[i]) << 62 if k > 31 else 0) + int(low[i]) == value
    assert not len(controls.packed(np.zeros(k - 1, np.uint8), k)[0])


@pytest.mark.parametrize(("k", "stride"), [(17, 7), (27, 7), (51, 3)])
def test_kmer_hits(spark, k, stride):
    """Both strands, the circle's joint, reads with N, short and null reads, two mates; looked up and joined."""
    rnd = random.Random(k)
    genome = "".join(rnd.choice("ACGT") for _ in range(400))
    ring = genome * 2
    units = [(i, ring[a : a + n], None if i % 3 else rc(ring[a + 9 : a + 9 + n])) for i, (a, n) in enumerate((rnd.randrange(400), rnd.randrange(5, 120)) for _ in range(60))]
    units += [(100, "N" + genome[:80], "ACGT"), (101, genome[:30] + "N" + genome[31:90], ""), (102, None, None), (103, "A" * 90, genome[-20:] + genome[:60])]
    whole = genome + genome[: k - 1]
    kmers = {s[i : i + k] for s in (whole, rc(whole)) for i in range(len(s) - k + 1)}

    def hits(s):
        s = s or ""
        places = {*range(0, len(s) - k + 1, stride), len(s) - k} if len(s) >= k else ()
        return sum(s[p : p + k] in kmers for p in places)

    want = sorted((i, n) for i, a, b in units if (n := hits(a) + hits(b)))
    frame = spark.createDataFrame(units, "u long, s1 string, s2 string")
    table = controls.genome_kmers(spark.createDataFrame([(genome,), ("AC",)], "sequence string"), k)
    assert table.count() == len(kmers)
    for most in (controls.MOST_KEPT, 10):
        assert sorted(map(tuple, controls.kmer_hits(frame, ["u"], [F.col("s1"), F.col("s2")], table, k, stride, most).collect())) == want
    assert controls.kmer_hits(frame, ["u"], [F.col("s1")], table.limit(0), k).count() == 0


@pytest.mark.parametrize("k", [51, 27])
@pytest.mark.parametrize("reads", [200, 1])
def test_windows_in_bounded_memory(k, reads):
    """Many reads or a long one: no array grows with a batch, and none waits for Python to look for cycles."""
    letters = np.random.default_rng(k).choice(np.frombuffer(b"ACGT", np.uint8), 8_000_000).tobytes().decode()
    column = pa.array([letters[i::reads] for i in range(reads)])
    want = reads * (1 - (k - len(letters) // reads) // 7)
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        assert sum(len(row) for row, _, _ in controls._codes(column, k, 7)) == want
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
        gc.enable()


@pytest.mark.parametrize(("k", "stride", "step"), [(1, 1, 1), (5, 7, 3), (5, 3, 13), (9, 1, 64), (40, 7, 11)])
def test_windows_over_steps(monkeypatch, k, stride, step):
    monkeypatch.setattr(controls, "STEP", step)
    rnd = random.Random(k)
    reads = ["".join(rnd.choice("ACGTACGTACGTN") for _ in range(rnd.choice([0, 1, k - 1, k, k + 1, 90]))) for _ in range(40)] + [None, ""]
    got = [(int(r), int(h), int(w)) for row, high, low in controls._codes(pa.array(reads), k, stride) for r, h, w in zip(row, high, low, strict=True)]
    want = []
    for r, s in enumerate(reads):
        for i in sorted({*range(0, len(s) - k + 1, stride), len(s) - k}) if s and len(s) >= k else ():
            if set(s[i : i + k]) <= set("ACGT"):
                value = sum("ACGT".index(c) << 2 * (k - 1 - j) for j, c in enumerate(s[i : i + k]))
                want.append((r, value >> 62 if k > 31 else 0, value & (1 << 62) - 1))
    assert got == want


def test_consensus_in_batches(monkeypatch):
    """Bases, coverage and disagreements of each row, whatever the lengths of reads and qualities."""
    rnd = random.Random(2)
    text = lambda n, letters: "".join(rnd.choice(letters) for _ in range(n))
    rows = []
    for _ in range(400):
        p, s = (None if rnd.random() < 0.1 else text(rnd.randrange(14), "ACGTN") for _ in range(2))
        rows.append((text(rnd.choice([1, 5, 9, 12]), "ACGT"), p, None if rnd.random() < 0.1 else text(rnd.randrange(15), "!5I\x1f"), s, text(rnd.randrange(15), "!5I")))
    names = ["sequence", "prefix", "prefix_q", "suffix", "suffix_q"]
    batch = pa.RecordBatch.from_pydict({"k": list(range(len(rows)))} | {n: pa.array([r[i] for r in rows], pa.string()) for i, n in enumerate(names)})
    monkeypatch.setattr(matcher, "CELLS", 200)
    got = {r["k"]: r for b in matcher._scored(iter([batch])) for r in b.to_pylist()}
    for k, (seq, p, pq, s, sq) in enumerate(rows):
        n = len(seq)
        base, qual, apart = [None] * n, [-1] * n, 0
        value = lambda q, i: max(0, ord(q[i]) - 33) if q and i < len(q) else 0
        for i, c in enumerate((p or "")[:n]):
            base[i], qual[i] = c, value(pq, i)
        s = s or ""
        for i, c in enumerate(s):
            at, q = n - len(s) + i, value(sq, i)
            if at < 0:
                continue
            if base[at] is None:
                base[at], qual[at] = c, q
            elif base[at] != c:
                apart += 1
                if q > qual[at]:
                    base[at] = c
        have = [b is not None for b in base]
        want = {"k": k, "distance": sum(h and b != c for h, b, c in zip(have, base, seq, strict=True)), "disagreements": apart, "observed": "".join(b or "N" for b in base), "enough": sum(have) / n >= 0.95}
        assert got[k] == want


def test_numbering(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), F.col("id").cast("string").alias("b")).repartition(7)
    got = numbered(rows, ["a", "b"], "place")
    assert [r["a"] for r in got.orderBy("place").collect()] == sorted(r["a"] for r in rows.collect())
    assert sorted(r["place"] for r in got.collect()) == list(range(5000))
    assert numbered(rows.limit(0), ["a"], "place").count() == 0
    designs = library.group_designs(spark.createDataFrame([(2, "b", "AC"), (1, "c", "AC"), (3, "a", "GG"), (4, "c0", "T")], "ord long, id string, sequence string"))
    assert sorted(map(tuple, designs.select("ref_index", "sequence", "ids", "n_ids").collect())) == [(0, "GG", ["a"], 1), (1, "AC", ["c", "b"], 2), (2, "T", ["c0"], 1)]


@pytest.mark.parametrize("n", [0, 1, 3, 10, 100])
def test_first_rows(spark, n):
    rnd = random.Random(n)
    given = [(rnd.choice(["x", "y", None]), rnd.randrange(6), i) for i in range(60)]
    frame = spark.createDataFrame(given, "g string, c long, i long")
    want = [r for g in ("x", "y", None) for r in sorted((r for r in given if r[0] == g), key=lambda r: r[1:])[:n]]
    assert sorted(map(tuple, first_rows(frame, ["g"], ["c"], ["c", "i"], n).collect()), key=str) == sorted(want, key=str)
