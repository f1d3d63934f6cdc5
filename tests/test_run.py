import gzip
import json
import os
import random
import shutil
from dataclasses import replace

import pytest

from helpers import COUNTS, LEFT, RIGHT, STRAY, make_run, naive_match, rc
from seqloom.operators import anchors, matcher
from seqloom.plans.run import analyse
from seqloom.sinks import tables as sinks
from seqloom.sources import fastq, tables
from seqloom.streaming import ingest


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    make_run(root)
    config = tables.RunConfig.load(f"{root}/run.ini")
    said = []
    rows = analyse(spark, config, say=said.append)
    assert [x[:5] for x in said[:-1]] == [f"[{i}/6]" for i in range(1, 7)] and said[-1].startswith("Done in ") and "report.html" in said[-1]
    return root, config, rows


def test_golden_figures(run):
    _, _, m = run
    a, e = m["ALL_ASSIGNED"], m["ALL_WITH_UNDETERMINED"]
    assert (a["unique_design_sequences"], a["detected_1x"], a["dropout_sequences"]) == (20, 18, 2)
    assert (a["phix_reads"], e["phix_reads"]) == (0, 50)
    assert (a["total_units"], m["Undetermined"]["total_units"], e["total_units"]) == (950, 143, 1093)
    assert (a["mapped_reads"], e["mapped_reads"]) == (950, 1043)
    assert (a["exact_mapped_reads"], a["near_mapped_reads"], m["Undetermined"]["exact_mapped_reads"]) == (940, 10, 93)
    assert (a["detected_10x"], a["detected_100x"], a["detected_500x"]) == (18, 4, 0)
    for key, want in {"mean_coverage": 47.5, "median_coverage": 15, "p10_coverage": 9, "p90_coverage": 133, "p90_over_p10": 14.777778, "coverage_cv": 1.186956, "gini": 0.59, "top_1_percent_read_share_percent": 21.052632, "top_10_percent_read_share_percent": 37.894737, "effective_library_size": 10.828980}.items():
        assert a[key] == pytest.approx(want, abs=1e-5), key
    assert e["gini"] == pytest.approx(0.584708, abs=1e-5)
    assert e["phix_fraction_percent"] == pytest.approx(4.574565, abs=1e-5)
    assert e["library_to_phix_read_ratio"] == pytest.approx(20.86)


def table(path):
    head, *rows = (x.rstrip("\n").split("\t") for x in open(path))
    return [dict(zip(head, r, strict=True)) for r in rows]


def figures(path):
    return {r["metric"]: r["value"] for r in table(path)}


def test_outputs(run):
    root, config, _ = run
    out = f"{root}/out"
    for path in ("report.html", "RESULTS_TO_SHARE.txt", "manifest.json", "combined/ALL_ASSIGNED_variant_counts.tsv", "samples/ALL_ASSIGNED/ALL_ASSIGNED_variant_counts.tsv", "index_qc/nearest_expected_barcodes.tsv", "observed_sequences", "qc/orientations.tsv"):
        assert os.path.exists(f"{out}/{path}"), path
    f = figures(f"{out}/index_qc/index_summary.tsv")
    want = {
        "expected_index_count": "1", "assigned_read_pairs_or_reads": "950", "undetermined_read_pairs_or_reads": "143", "assigned_phix_reads": "0", "undetermined_phix_reads": "50", "assigned_non_phix_reads": "950",
        "undetermined_non_phix_reads": "93", "index_substitution_analysis_source": "I1_I2_FASTQ", "raw_I1_I2_index_reads_counted": "200", "raw_I1_I2_unique_retained": "2", "raw_I1_I2_counter_pruned": "False",
        "header_index_reads_counted": "1093", "header_index_unique_retained": "3", "top_unknown_reads_counted": "100", "observed_index_reads_analyzed": "200", "exact_expected_index_reads": "180",
        "within_2_bp_expected_reads": "200", "expected_G_position_weighted_reads_within_threshold": "400", "expected_G_to_G": "380", "expected_G_to_N": "20", "expected_G_to_other": "0", "expected_G_to_N_percent": "5", "preferred_i5_orientation": "I1_only",
    }
    assert {k: f[k] for k in want} == want and "nearest expected index" in f["note"]
    assert float(f["assigned_read_fraction_percent"]) == pytest.approx(100 * 950 / 1093, abs=1e-5) and float(f["undetermined_non_phix_fraction_percent"]) == pytest.approx(8.916587, abs=1e-5)
    m = json.load(open(f"{out}/manifest.json"))
    assert len(m["reference_sha256"]) == 64 and m["sample_names"] == ["pDNA", "Undetermined"] and m["counts"]["units"] == 1093 and m["arguments"]["left_primer"] == LEFT and m["version"] and m["warnings"] == []
    assert sorted(os.listdir(f"{out}/tables")) == ["units"]
    seen = spark_csv(f"{out}/observed_sequences")
    assert seen[0] == ["sample", "design_key", "observed_target_sequence", "match_type", "count"] and sum(int(r[-1]) for r in seen[1:]) == 1043
    assert {r["source"] for r in table(f"{out}/index_qc/top_observed_barcodes.tsv")} == {"I1_I2_FASTQ", "FASTQ_header", "Top_Unknown_Barcodes"}
    with pytest.raises(FileExistsError):
        analyse(None, config)


def spark_csv(folder):
    """Rows of gzipped TSV parts, the header once."""
    found = []
    for name in sorted(os.listdir(folder)):
        if name.endswith(".gz"):
            with gzip.open(f"{folder}/{name}", "rt") as lines:
                head, *rows = (x.rstrip("\n").split("\t") for x in lines)
            found += rows if found else [head, *rows]
    return found


def test_sample_files(run):
    root, _, rows = run
    m = table(f"{root}/out/samples/pDNA/pDNA_library_metrics.tsv")
    assert [x["metric"] for x in m] == list(sinks.METRICS) and len(m) == 50
    assert {x["metric"]: x["value"] for x in m}["total_read_pairs_or_reads"] == "950" == {x["metric"]: x["value"] for x in m}["mapped_reads"]
    d = table(f"{root}/out/samples/pDNA/pDNA_variant_counts.tsv")
    assert list(d[0]) == sinks.DESIGN_COLUMNS and [x["sequence_key"] for x in d] == [f"V{i:02d}" for i in range(20)] and [int(x["total_count"]) for x in d] == COUNTS
    assert sum(int(x["near_count"]) for x in d) == 10 and sum(int(x["exact_count"]) for x in d) == 940
    assert [x["detected"] for x in d][-3:] == ["1", "0", "0"] and float(d[0]["frequency_percent"]) == pytest.approx(100 * 200 / 950, abs=1e-5)
    assert [x["sequence_key"] for x in table(f"{root}/out/samples/pDNA/pDNA_dropout_variants.tsv")] == ["V18", "V19"]
    assert [int(x["total_count"]) for x in table(f"{root}/out/samples/pDNA/pDNA_top_variants.tsv")] == sorted(COUNTS, reverse=True)
    assert {x["category"]: x["count"] for x in table(f"{root}/out/samples/Undetermined/Undetermined_classification.tsv")} == {"exact": "93", "phix": "50"}
    every = table(f"{root}/out/combined/all_sample_metrics.tsv")
    assert [x["sample"] for x in every] == ["pDNA", "Undetermined", "ALL_ASSIGNED", "ALL_WITH_UNDETERMINED"] and list(every[0]) == sorted(sinks.METRICS)
    matrix = table(f"{root}/out/combined/variant_count_matrix.tsv")
    assert [(int(x["pDNA"]), int(x["Undetermined"])) for x in matrix] == list(zip(COUNTS, STRAY, strict=True))
    assert float(table(f"{root}/out/combined/variant_rpm_matrix.tsv")[0]["pDNA"]) == pytest.approx(1e6 * 200 / 950, rel=1e-6)


def test_quality_files_and_reports(run):
    root = run[0]
    q = table(f"{root}/out/run_qc_summary.tsv")
    assert [(x["label"], x["total_reads"]) for x in q] == [("Run:I1:001:001", "200"), ("Undetermined:R1:001:001", "143"), ("Undetermined:R2:001:001", "143"), ("pDNA:R1:001:001", "950"), ("pDNA:R2:001:001", "950")]
    assert list(q[0]) == sinks.FILE_COLUMNS and q[3]["path"].endswith("pDNA_S1_L001_R1_001.fastq.gz") and q[3]["mean_q"] == "40" and q[3]["mean_length"] == "150" and q[0]["n_base_percent"] == "1.25"
    cycles = table(f"{root}/out/per_cycle_qc.tsv")
    assert list(cycles[0]) == sinks.CYCLE_COLUMNS and len(cycles) == 8 + 4 * 150 and cycles[6]["N_percent"] == "10" and cycles[6]["G_percent"] == "90"
    text, page = open(f"{root}/out/RESULTS_TO_SHARE.txt").read(), open(f"{root}/out/report.html").read()
    for line in ("expected percent: 5.0000", "observed minus expected: -0.4254", "spike-in reads: 50", "pDNA R1: 950 reads, mean quality 40.00, Q30 100.00 %, N 0.0000 %", "expected_G_to_N: 20", "[sample ALL_ASSIGNED]", "class near: 10", "unique_designs: 20", "[warnings]\nnone"):
        assert line in text, line
    for name in ("Run quality", "Samples", "Rank and abundance", "Indexes", "Warnings", "Reproducibility"):
        assert f"<h2>{name}</h2>" in page
    assert page.count("<svg") == 4 and "within_2_bp_expected_reads" in page and "left_primer" in page


def test_leftover_files_and_limits(spark, run, tmp_path):
    """A second file for one read leaves the first over: it has quality figures and header indexes, up to the limit."""
    root = run[0]
    shutil.copytree(f"{root}/fastq", tmp_path / "fastq")
    os.makedirs(tmp_path / "fastq/more")
    shutil.copy(tmp_path / "fastq/pDNA_S1_L001_R1_001.fastq.gz", tmp_path / "fastq/more/pDNA_S1_L001_R1_001.fastq.gz")
    config = replace(run[1], input_dir=str(tmp_path / "fastq"), outdir=f"file://{tmp_path}/out", max_reads=60, sample_sheet="", top_unknown="", phix_qc=False)
    rows = analyse(spark, config)
    assert rows["ALL_WITH_UNDETERMINED"]["total_units"] == 120 and rows["ALL_WITH_UNDETERMINED"]["phix_reads"] == 0
    q = table(tmp_path / "out/run_qc_summary.tsv")
    assert sorted(x["total_reads"] for x in q) == ["60"] * 6
    f = figures(tmp_path / "out/index_qc/index_summary.tsv")
    assert (f["header_index_reads_counted"], f["expected_index_count"], f["preferred_i5_orientation"], f["raw_I1_I2_index_reads_counted"]) == ("180", "0", "NA", "60")
    text = open(tmp_path / "out/RESULTS_TO_SHARE.txt").read()
    assert "second R1 file" in text and "no usable sample sheet" in text and "spike-in classification is off" in text


def test_arguments(run):
    config = run[1]
    for change, message in (({"left_primer": ""}, "left_primer is required"), ({"phix_reference": ""}, "phix_reference is required"), ({"reference": "/none"}, "reference is no file"), ({"input_dir": "/none"}, "no folder"), ({"sample_sheet": "/none"}, "sample_sheet is no file"), ({"max_reads": 0}, "above 0")):
        with pytest.raises(ValueError, match=message):
            replace(config, **change).checked()
    assert replace(config, target_name="  a  b ").checked().target_name == "a b"


def test_flanked_designs_load_alike(spark, run):
    root = run[0]
    plain, oligo = (tables.designs(spark, f"{root}/{n}.csv", LEFT, RIGHT).select("ref_index", "ids", "sequence").collect() for n in ("design", "oligo"))
    assert sorted(plain) == sorted(oligo)


def test_max_reads_and_incremental_counts(spark, run, tmp_path):
    from seqloom.operators.library import count_matches
    from seqloom.plans.run import read_pairs

    root = run[0]
    assert sorted(r["count"] for r in read_pairs(spark, f"{root}/fastq", 100).groupBy("sample").count().collect()) == [100, 100]
    units = spark.read.parquet(f"{root}/out/tables/units")
    counts = ingest.stream_counts(spark, f"{root}/out/tables/units", units.schema.simpleString()[7:-1].replace(":", " "), 1)
    ingest.start(counts, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    last = max(os.listdir(tmp_path / "out"), key=lambda x: int(x.split("=")[1]))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out" / last)).collect())) == sorted(map(tuple, count_matches(units).collect()))


def test_file_errors(tmp_path):
    good = "@a 1\nACGT\n+\n@III\n"
    for text, message in ((good + "@b\nAC\n", "cut off"), ("x\nA\n+\nI\n", "start with"), ("@a\nAC\n+\nI\n", "bases"), (good + "\n", "cut off")):
        path = tmp_path / "x_R1_001.fastq"
        path.write_text(text)
        with pytest.raises(ValueError, match=message):
            list(fastq.records(str(path)))
    path.write_text(good.replace("ACGT", "acgn"))
    assert list(fastq.records(str(path))) == [("@a 1", "ACGN", "@III")]
    assert fastq.parse_name("/x/A_b_S3_L002_R2_001.fastq.gz") == fastq.FastqFile("/x/A_b_S3_L002_R2_001.fastq.gz", "A_b", "002", "R2", "001")
    for name, want in {"a.R1.fastq.gz": ("a", "", "R1", ""), "S_R1_0001.fastq.gz": ("S", "", "R1", "0001"), "S_R1_1.fastq": ("S", "", "R1", "1"), "S_1.fq": ("S", "", "R1", ""), "S_S2_L003.i2.7.FQ": ("S", "003", "I2", "7"), "_R2_9.fastq": ("", "", "R2", "9")}.items():
        assert fastq.parse_name(name) == fastq.FastqFile(name, *want)
    assert fastq.parse_name("x.txt") is None and fastq.parse_name("_r2.fastq") is None and fastq.parse_name("xR2.fastq") is None


def test_fastq_by_uri(spark, run):
    """A folder named by a URI is read alike, but for the names of its files."""
    root = run[0]
    plain, by_uri = (fastq.read_fastq(spark, f"{x}{root}/fastq", pairs="true").collect() for x in ("", "file://"))
    assert len(plain) == 1093 and sorted(plain) == sorted(by_uri)
    assert {f.path for f in fastq.discover(f"file://{root}/fastq/")[1]} == {f"file://{f.path}" for f in fastq.discover(f"{root}/fastq")[1]}


def test_matcher_against_plain_table(spark):
    rnd = random.Random(3)
    dna = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    refs = [dna(rnd.choice([9, 14, 30, 40])) for _ in range(30)]
    refs += [r[:-1] + ("A" if r[-1] != "A" else "C") for r in refs[:6]]
    refs += [refs[8][:15] + ("A" if refs[8][15:16] != "A" else "C") + refs[8][16:]]
    refs = list(dict.fromkeys(refs))

    def change(s, n):
        for _ in range(n):
            k = rnd.randrange(len(s))
            s = s[:k] + rnd.choice("ACGTN.") + s[k + 1 :]
        return s

    rows = []
    for i in range(400):
        r = rnd.choice(refs)
        p = rnd.choice([None, change(r, rnd.randrange(4)), change(r, 1)[: rnd.randrange(3, len(r))], change(r, 1) + dna(5)])
        s = rnd.choice([None, change(r, rnd.randrange(3)), change(r, 1)[-rnd.randrange(3, len(r)) :], dna(25)])
        q = lambda x: None if x is None else "".join(rnd.choice("!5I") for _ in x)
        rows.append((i, p, q(p), s, q(s), rnd.choice([[], [], [r], [dna(5), r]]), bool(rnd.randrange(2)), bool(rnd.randrange(2))))
    names = ["unit", "prefix", "prefix_q", "suffix", "suffix_q", "fulls", "left_anchor", "right_anchor"]
    schema = "unit long, prefix string, prefix_q string, suffix string, suffix_q string, fulls array<string>, left_anchor boolean, right_anchor boolean"
    designs = spark.createDataFrame(list(enumerate(refs)), "ref_index int, sequence string")
    got = {r[0]: tuple(r)[1:] for r in matcher.match(spark.createDataFrame(rows, schema), designs, ["unit"], 12, 2).collect()}
    want = {r[0]: naive_match(dict(zip(names, r, strict=True)), refs, 12, 2) for r in rows}
    assert got == want
    assert {v[0] for v in want.values()} >= {"exact", "near", "ambiguous", "too_many_mismatches", "insufficient_evidence", "no_candidate", "anchor_missing"}


def test_anchor_search_and_swapped_mates(spark):
    start, best = anchors.leftmost_best(["AACGTTACGA", "ACGAACGT", "AC", "TTTTTTT", "NCGTTTTT"], "ACGT", 1)
    assert list(zip(start.tolist(), best.tolist(), strict=True)) == [(1, 0), (4, 0), (-1, 2), (-1, 2), (0, 1)]
    target = "GATTACAGATTACAGGCCTTAA"
    one, two = "AC" + LEFT + target + rc(RIGHT) + "AAAA", RIGHT + rc(target) + rc(LEFT)
    rows = [(0, one, "I" * len(one), two, "I" * len(two)), (1, two, "I" * len(two), one, "I" * len(one)), (2, one, "I" * len(one), None, None), (3, two, "I" * len(two), None, None)]
    got = {r["u"]: r for r in anchors.build_evidence(spark.createDataFrame(rows, "u int, s1 string, q1 string, s2 string, q2 string"), LEFT, RIGHT).collect()}
    assert [got[u]["orientation"] for u in range(4)] == ["R1_forward", "R2_forward", "R1_forward", "R1_forward"]
    assert got[0]["fulls"] == [target, target] == got[1]["fulls"] and got[2]["fulls"] == [target] and got[3]["fulls"] == []
    assert got[0]["suffix"].endswith(target) and got[0]["prefix"].startswith(target)
    assert not got[3]["left_anchor"] and not got[3]["right_anchor"]
