"""Small inputs by value, and the nearest barcodes against all pairs."""

import random

import numpy as np
import pytest

from seqloom.operators import indexqc
from seqloom.sources import tables


def written(tmp_path, text, name="x.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("[Header]\nx,y\n\n[Data]\n\nSample_ID,index,index2\n\na,acgtac,tt-gg\n,ACGTAC,\nb,,AC\n", [("A", "ACGTAC", "TTGG")]),
        ("[DATA],,\nSample_ID,Sample_Name,index1\n,two,ACGT\none,two,ACGT\n", [("TWO", "ACGT", ""), ("ONE", "ACGT", "")]),
        ("Sample_Name,index,index1,index2\na,,GGTTAA,\nb,CC,AA,TT\n", [("A", "GGTTAA", ""), ("B", "CC", "TT")]),
        ("", []), ("\ufeff\n \n", []), ("[Data]\n", []), ("[Data]\nSample_ID,index\n", []), ("Sample_ID\nx\n", []),
    ],
)
def test_sample_sheets(spark, tmp_path, text, want):
    assert sorted(map(tuple, tables.sample_sheet(spark, written(tmp_path, text)).collect())) == sorted(want)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("index,count\nACGTAC-TTGGCC,1e3\nACGTAC_TTGGCC,\"1,234\"\nACGTACN,7.9\n", {"ACGTAC+TTGGCC": 2234, "ACGTACN": 7}),
        ("lane;barcode;reads\n1;ACGTAC;-5\n2;ACGTAC;x\n3;ACG;9\n", {"ACGTAC": 3}),
        ("note\tcode\tclusters\nx\tacgtacgt\tinf\n", {"ACGTACGT": 1}),
        ("", {}), ("index,count\n", {}),
    ],
)
def test_unknown_barcodes(spark, tmp_path, text, want):
    assert dict(map(tuple, tables.unknown_barcodes(spark, written(tmp_path, text)).collect())) == want


def test_configuration(tmp_path):
    base = "[input]\ninput_dir = fastq\n[control_qc]\nphix_enabled = {}\nphix_reference =\n[runtime]\nmax_reads =\nwrite_observed_sequences = {}\n"
    off = tables.RunConfig.load(written(tmp_path, base.format("no", "Off"), "run.ini"))
    assert (off.phix_qc, off.write_observed_sequences, off.max_reads, off.input_dir) == (False, False, None, str(tmp_path / "fastq"))
    assert tables.RunConfig.load(written(tmp_path, base.format("TRUE", "1"), "run.ini")).phix_qc
    with pytest.raises(ValueError, match="yes or no"):
        tables.RunConfig.load(written(tmp_path, base.format("perhaps", "1"), "run.ini"))
    with pytest.raises(ValueError, match="no column"):
        tables.design_rows(written(tmp_path, "", "d.csv"))


def brute(observed, expected):
    d = [[sum(x != y for x, y in zip(o, e, strict=True)) for e in expected] for o in observed]
    return [(min(row), row.index(min(row)), row.count(min(row))) for row in d]


@pytest.mark.parametrize(("length", "letters"), [(1, "AC"), (2, "ACGT"), (8, "ACGTN"), (17, "ACGTN"), (17, "AC"), (40, "ACGT")])
def test_closest_barcodes(length, letters):
    rnd = random.Random(length)
    make = lambda: "".join(rnd.choice(letters) for _ in range(length))
    expected = [make() for _ in range(60)]
    expected += expected[:3]

    def off(s, n):
        for k in rnd.sample(range(length), min(n, length)):
            s = s[:k] + rnd.choice("ACGTN.") + s[k + 1 :]
        return s

    observed = [off(rnd.choice(expected), rnd.randrange(length + 2)) for _ in range(300)] + ["." * length, "N" * length]
    matrix = lambda x: np.frombuffer("".join(x).encode(), np.uint8).reshape(len(x), -1)
    least, first, tied, compared = indexqc.closest(matrix(observed), matrix(expected))
    assert list(zip(least.tolist(), first.tolist(), tied.tolist(), strict=True)) == brute(observed, expected)
    near = [off(rnd.choice(expected), 2) for _ in range(300)]
    if length >= 17 and len(letters) > 2:  # what lies near meets a few, and growing the radius doesn't start over
        assert indexqc.closest(matrix(near), matrix(expected))[3] < 0.1 * len(near) * len(expected)
        assert indexqc.closest(matrix(["." * length] * 300), matrix(expected))[3] == 0


def test_nearest_of_other_forms(spark):
    sheet = spark.createDataFrame([("b", "ACGTAC", "GGTTCA"), ("a", "ACGTAC", "GGTTCA"), ("c", "TTTTTTTT", None)], "sample string, i7 string, i5 string")
    seen = spark.createDataFrame([("ACGTAC+GGTTCC", 5), ("ACGTAC", 2), ("TTTT", 9), ("ACG+TAC", 1), ("TTTTTTTN", 1), ("GGGGGGGG", 4)], "barcode string, count long")
    got = {r[0]: tuple(r)[1:] for r in indexqc.nearest(seen, sheet).collect()}
    assert got == {
        "ACGTAC+GGTTCC": (5, "a", "ACGTAC+GGTTCA", 1, "as_given", 2), "ACGTAC": (2, "a", "ACGTAC", 0, "I1_only", 2), "TTTT": (9, "a", "ACGTAC", 999, "I1_only", 3),
        "ACG+TAC": (1, "a", "ACGTAC+GGTTCA", 999, "as_given", 5), "TTTTTTTN": (1, "c", "TTTTTTTT", 1, "I1_only", 1), "GGGGGGGG": (4, "c", "TTTTTTTT", 8, "I1_only", 1),
    }
    assert indexqc.nearest(seen.limit(0), sheet).count() == 0 and indexqc.nearest(seen, sheet.limit(0)).count() == 0
