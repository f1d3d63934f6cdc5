"""A scan in ranges gives the rows of a scan in one task, for all cut places, line ends and kinds of gzip."""

import gzip
import random
import struct
import zlib

import pytest

from seqloom.operators.numbering import first_rows
from seqloom.sources import fastq


def blocked(data, size):
    """Blocked gzip: members of ``size`` bytes of text, each with its own size, and the empty one that ends a file."""
    out = b""
    for i in range(0, len(data) + size, size):
        text = data[i : i + size]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(text) + packer.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(text), len(text))
    return out


def reads(n, seed=1, mate=1):
    """Records with empty and long sequences; many qualities begin with @ or +."""
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 1, 5, 30, 3, 90]) for _ in range(n)]
    return [(f"@r{i}/{mate} x", "".join(rnd.choice("ACGTN") for _ in range(k)), "".join(rnd.choice("@+I!") for _ in range(k))) for i, k in enumerate(sizes)]


def text(rows, end="\n"):
    return "".join(f"{h}{end}{s}{end}+{end}{q}{end}" for h, s, q in rows).encode()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("whole", [True, False])
def test_all_cut_places(tmp_path, end, whole):
    data = text(reads(40), end)
    data = data if whole else data[: -len(end)]
    for name, stored in (("a_R1_001.fastq", data), ("b_R1_001.fastq.gz", blocked(data, 37))):
        path = tmp_path / name
        path.write_bytes(stored)
        path = str(path)
        want = list(fastq.records(path))
        assert want == reads(40)
        for cut in range(1, len(stored) + 2, 1 if whole and end == "\n" else 7):  # all places once
            got, after = [], None
            for start in range(0, len(stored), cut):
                first, n, then = fastq.survey(path, start, start + cut, step=cut if not name.endswith("gz") else fastq.STEP)
                if first is None:
                    continue
                assert after in (None, first)
                for batch in fastq.batches(path, n, first):
                    got += zip(*batch, strict=True)
                after = then
            assert got == want, (name, cut)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Samples in plain, blocked and plain gzip files, in several chunks; mates differ in size."""
    root = tmp_path_factory.mktemp("fq")
    for sample, sizes in (("a", (50, 3, 70)), ("b", (200,)), ("c", (7, 9)), ("Undetermined", (60,))):
        for k, n in enumerate(sizes):
            for mate in (1, 2):
                data, base = text(reads(n, seed=k + 10 * mate, mate=mate)), root / f"{sample}_S1_L001_R{mate}_00{k}.fastq"
                if sample == "a":
                    base.write_bytes(data)
                elif sample == "c":
                    (root / (base.name + ".gz")).write_bytes(gzip.compress(data))
                else:
                    (root / (base.name + ".gz")).write_bytes(blocked(data, 300))
    return str(root)


def test_ranges_equal_whole_files(spark, folder):
    for options in ({"pairs": "true"}, {}):
        want = sorted(fastq.read_fastq(spark, folder, **options).collect())
        assert len(want) == (399 if options else 798)
        for size in (200, 3000):
            split = fastq.read_fastq(spark, folder, split_bytes=size, **options)
            assert sorted(split.collect()) == want
        assert split.rdd.getNumPartitions() > 8
    assert sorted(spark.read.format("fastq").option("pairs", "true").load(f"file://{folder}").drop("chunk_key").collect()) == sorted(fastq.read_fastq(spark, folder, split_bytes=700, pairs="true").drop("chunk_key").collect())


def test_read_budget(spark, folder):
    """The budget's rows are those of a window over all reads, and no partition reads more."""
    every = fastq.read_fastq(spark, folder, pairs="true")
    for budget in (1, 51, 60, 1000):
        want = sorted(first_rows(every, ["sample"], ["chunk_key"], ["ord"], budget).collect())
        for size in (400, fastq.SPLIT_BYTES):
            assert sorted(fastq.read_fastq(spark, folder, split_bytes=size, per_sample=budget, pairs="true").collect()) == want
            parts = fastq.plan(spark, folder, {"pairs": "true"}, size, budget)
            assert sum(p.take for p in parts) == len(want)


def test_faults_in_ranges(spark, tmp_path):
    good = text(reads(30))
    (tmp_path / "x_R1_001.fastq").write_bytes(good)
    (tmp_path / "x_R2_001.fastq").write_bytes(text(reads(31, mate=2)))
    with pytest.raises(ValueError, match="differ in their number"):
        fastq.read_fastq(spark, str(tmp_path), split_bytes=100, pairs="true")
    (tmp_path / "x_R2_001.fastq").write_bytes(good[:700] + b"\nline too many\n" + good[700:])
    with pytest.raises(Exception, match="record"):
        fastq.read_fastq(spark, str(tmp_path), split_bytes=100, pairs="true").count()
    assert fastq.read_fastq(spark, str(tmp_path), only="").count() == 0
