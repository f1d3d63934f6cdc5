"""A whole run: FASTQ folder and designs in, tables and reports out.

``python -m seqloom.plans.run --config run.ini`` or ``analyse(spark, RunConfig(...))``. The FASTQ files
are scanned once into tables that all statistics read; the evidence of the pairs and the per-unit result are tables too.
"""

from __future__ import annotations

import argparse
import html
import os
import sys
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom import __version__
from seqloom.functions.scalars import INCOMPARABLE, canonical_read_id, header_index
from seqloom.operators import anchors, controls, indexqc, library, matcher, qc
from seqloom.sinks import tables as sink
from seqloom.sinks.store import kept
from seqloom.sources import tables as source
from seqloom.sources.fastq import discover, read_fastq

UNIT = ["sample", "is_undetermined", "chunk_key", "ord"]


def read_pairs(spark: SparkSession, root: str, max_reads: int | None = None) -> DataFrame:
    """Mates side by side; at most ``max_reads`` of each sample, in the order of its chunks, which the scan itself keeps to."""
    return read_fastq(spark, root, pairs="true", per_sample=max_reads)


def classified(pairs: DataFrame, designs: DataFrame, c: source.RunConfig, kmers: DataFrame | None) -> DataFrame:
    """``pairs``, a stored table, with their spike-in units told by ``kmers`` and the others matched: ``classify``."""
    ids = [canonical_read_id(F.col(h)) for h in ("h1", "h2")]
    pairs = pairs.withColumn("header_mismatch", F.coalesce(ids[0] != ids[1], F.lit(False)))
    spiked, rest = None, pairs
    if kmers is not None:
        spiked = kept(controls.spike_in_units(pairs, [*UNIT, "header_mismatch"], [F.col("s1"), F.col("s2")], kmers, c.phix_kmer_length, c.phix_min_kmer_hits), "spike-in")
        rest = pairs.join(spiked.select(*UNIT), UNIT, "left_anti")
    evidence = anchors.build_evidence(rest.select(*UNIT, "header_mismatch", "s1", "q1", "s2", "q2"), c.left_primer, c.right_primer, c.anchor_mismatches)
    return classify(kept(evidence.drop("s1", "q1", "s2", "q2"), "evidence"), designs, c, spiked)


def spike_in_kmers(spark: SparkSession, c: source.RunConfig) -> DataFrame | None:
    return controls.genome_kmers(source.genome(spark, c.phix_reference), c.phix_kmer_length) if c.phix_qc else None


def run_designs(spark: SparkSession, c: source.RunConfig) -> DataFrame:
    return source.designs(spark, c.reference, c.left_primer, c.right_primer, c.reference_mode, id_column=c.id_column, sequence_column=c.sequence_column)


def classify(evidence: DataFrame, designs: DataFrame, c: source.RunConfig, spiked: DataFrame | None) -> DataFrame:
    """One row per unit: match_type, ref_index, observed, distance, disagreements, anchors, orientation, header mismatch."""
    rows = matcher.match(evidence, designs, UNIT, c.signature_length, c.max_mismatches, carry=["left_anchor", "right_anchor", "orientation", "header_mismatch"])
    if spiked is not None:
        rows = rows.unionByName(spiked.withColumns({"match_type": F.lit("phix"), "disagreements": F.lit(0)}), allowMissingColumns=True)
    return rows


class Files:
    """The FASTQ files of a run: which are read as pairs, as index reads, or are left over."""

    def __init__(self, c: source.RunConfig):
        self.chunks, self.files, self.warnings = discover(c.input_dir)
        used = lambda *reads: {path: (k.key, str(i + 1)) for k in self.chunks for i, path in enumerate(k.files[r] for r in reads if r in k.files)}
        self.mates, self.index = used("R1", "R2"), used("I1", "I2")
        self.left = [f for f in self.files if f.path not in self.index and f.path not in self.mates]
        self.limit = {"limit": str(c.max_reads)} if c.max_reads else {}
        self.root = c.input_dir

    def samples(self) -> list[str]:
        names = list(dict.fromkeys(k.sample for k in self.chunks if {"R1", "R2"} & k.files.keys()))
        if not names:
            raise ValueError(f"no R1 or R2 files in {self.root}")
        clash = [n for n in names if len([m for m in names if _file(m).lower() == _file(n).lower()]) > 1]
        if clash:
            raise ValueError(f"sample names that give one file name: {clash}")
        return names

    def leftover(self, spark: SparkSession) -> DataFrame:
        return read_fastq(spark, self.root, only="\n".join(f.path for f in self.left), **self.limit)

    def index_reads(self, spark: SparkSession) -> DataFrame:
        """I1 and I2 side by side."""
        return read_fastq(spark, self.root, pairs="true", mates="I1,I2", **self.limit)

    def quality(self, spark: SparkSession, pairs: DataFrame, index: DataFrame, left: DataFrame) -> DataFrame:
        """(path, seq, qual) of every read that is used."""
        mate = lambda k: F.struct(F.lit(str(k)).alias("mate"), F.col(f"s{k}").alias("seq"), F.col(f"q{k}").alias("qual"))
        out = left.select("path", "seq", "qual")
        for reads, places in ((pairs, self.mates), (index, self.index)):
            files = spark.createDataFrame([(path, key, k) for path, (key, k) in places.items()], "path string, chunk_key string, mate string")
            used = reads.select("chunk_key", F.inline(F.array(mate(1), mate(2)))).where("seq is not null").join(files, ["chunk_key", "mate"])
            out = out.union(used.select("path", "seq", "qual"))
        return out

    def described(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(f.path, f.label, f.sample, f.read) for f in self.files], "path string, label string, sample string, read string")


def index_sources(spark: SparkSession, pairs: DataFrame, index: DataFrame, left: DataFrame, c: source.RunConfig) -> dict[str, DataFrame]:
    """Barcode counts of index reads, read headers and the table of unknown barcodes, in order of preference."""
    both = index.select(F.concat_ws("+", "s1", "s2").alias("barcode"))
    heads = pairs.select(header_index(F.col("h1")).alias("i1"), header_index(F.col("h2")).alias("i2"))
    heads = heads.union(left.where(F.col("read").isin("R1", "R2")).select(header_index(F.col("header")), F.lit(None).cast("string")))
    unknown = source.unknown_barcodes(spark, c.top_unknown) if c.top_unknown else spark.createDataFrame([], "barcode string, count long")
    return dict(zip(indexqc.SOURCES, (both.groupBy("barcode").agg(F.count("*").alias("count")), indexqc.header_counts(heads, "i1", "i2"), unknown), strict=True))


def run_quality(spark: SparkSession, files: Files, reads: DataFrame, outdir: str) -> list[dict]:
    """Writes quality by file and by cycle; returns the rows by file."""
    about = files.described(spark)
    by_read, by_cycle = qc.both_qc(reads, ["path"])
    by_file = about.join(by_read, "path", "left").fillna(0, ["total_reads", "total_bases", "min_length"]).select(*sink.FILE_COLUMNS)
    rows = [r.asDict() for r in by_file.orderBy("sample", "read", "path").collect()]
    sink.write_rows(os.path.join(outdir, "run_qc_summary.tsv"), sink.FILE_COLUMNS, rows)
    cycles = about.join(by_cycle, "path").withColumnsRenamed({f"{b}_percent": f"{b.upper()}_percent" for b in "acgtn"})
    sink.write_tsv(cycles, os.path.join(outdir, "per_cycle_qc.tsv"), ["sample", "read", "path", "cycle"], sink.CYCLE_COLUMNS)
    return rows


def index_quality(spark: SparkSession, c: source.RunConfig, barcodes: dict[str, DataFrame], rows: dict[str, dict], warnings: list[str], outdir: str) -> dict:
    """Writes the index tables; returns the summary by name."""
    at = lambda name: os.path.join(outdir, "index_qc", name)
    sink.write_tsv(indexqc.top_barcodes(barcodes), at("top_observed_barcodes.tsv"), [F.desc("count"), "barcode", F.array_position(F.array(*map(F.lit, indexqc.SOURCES)), F.col("source"))])
    sheet = source.sample_sheet(spark, c.sample_sheet) if c.sample_sheet else spark.createDataFrame([], "sample string, i7 string, i5 string")
    expected = sheet.count()
    some = [n for n, b in barcodes.items() if not b.isEmpty()]
    if not expected:
        warnings.append("no usable sample sheet: barcodes were counted, not compared")
    if not some:
        warnings.append("no barcodes in index reads, headers or a table of unknown ones")
    chosen = some[0] if some else indexqc.SOURCES[-1]
    near = indexqc.nearest(barcodes[chosen], sheet).cache()
    shown = near.withColumn("distance", F.when(F.col("distance") < INCOMPARABLE, F.col("distance")))
    sink.write_tsv(shown, at("nearest_expected_barcodes.tsv"), [F.desc("count"), "observed_barcode"])
    sink.write_tsv(indexqc.substitutions(near, c.max_index_distance), at("index_position_substitutions.tsv"), ["index_read", "position", "expected_base", "observed_base"])
    units = [(und, m["total_units"], m["phix_reads"]) for s, m in rows.items() if not s.startswith("ALL_") for und in (bool(m["is_undetermined"]),)]
    figures = {"expected_index_count": expected} | indexqc.unit_figures(spark.createDataFrame(units, "undetermined boolean, units long, phix long")).first().asDict()
    figures["index_substitution_analysis_source"] = chosen
    figures |= indexqc.source_figures(barcodes).first().asDict() | {"raw_I1_I2_counter_pruned": False, "header_index_counter_pruned": False}
    figures |= {k: v for k, v in indexqc.summary(near, c.max_index_distance).first().asDict().items()}
    if not expected:
        figures["observed_index_reads_analyzed"] = barcodes[chosen].agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    span = f"within {c.max_index_distance} substitutions of their nearest expected index"
    figures["note"] = f"substitution shares cover only failed or unknown index reads {span}" if chosen == indexqc.SOURCES[-1] else f"substitution shares cover {chosen} barcodes {span}; others are not in the denominator"
    sink.write_figures(at("index_summary.tsv"), figures)
    near.unpersist()
    return figures


def analyse(spark: SparkSession, c: source.RunConfig, command: str = "", say: Callable[[str], object] = lambda text: None) -> dict[str, dict]:
    """Writes all outputs below ``c.outdir``; returns the metrics by sample and roll-up. ``say`` is told of each step."""
    began = time.time()
    c = c.checked()
    say("[1/6] designs and files")
    sink.prepare_folder(c.outdir, c.overwrite)
    at = lambda *p: os.path.join(c.outdir, *p)
    files = Files(c)
    names, warnings = files.samples(), files.warnings
    designs = run_designs(spark, c).cache()
    twice = library.duplicates(designs).select(F.col("sequence").alias("target_sequence"), F.col("ids").alias("variant_ids"), "id_count")
    sink.write_tsv(twice, at("design_sequence_duplicates.tsv"), ["variant_ids"])
    n_twice = twice.count()
    if n_twice:
        warnings.append(f"{n_twice} design sequences are listed more than once and can't be told apart")

    say(f"[2/6] reads of {len(names)} samples in {len(files.files)} files")
    pairs = kept(read_pairs(spark, c.input_dir, c.max_reads), "reads")
    index, left = kept(files.index_reads(spark), "index-reads"), kept(files.leftover(spark), "leftover-reads")
    say("[3/6] matching")
    classified(pairs, designs, c, spike_in_kmers(spark, c)).write.parquet(at("tables", "units"))
    units = spark.read.parquet(at("tables", "units"))
    say("[4/6] read quality and library statistics")
    qc_rows = run_quality(spark, files, files.quality(spark, pairs, index, left), c.outdir)

    unassigned = F.lower("sample").startswith("undetermined")
    totals = kept(library.rolled_up(library.sample_totals(units), [], unassigned), "totals")
    full = library.zero_filled(library.rolled_up(library.count_matches(units), ["ref_index"], unassigned), designs, totals).cache()
    counts = library.frequencies(full)
    key = F.array_join("ids", "|")
    shown = counts.select(
        "sample", key.alias("sequence_key"), key.alias("variant_ids"), F.col("n_ids").alias("duplicate_id_count"), F.col("sequence").alias("target_sequence"), "length", F.col("gc").alias("gc_percent"),
        F.col("exact").alias("exact_count"), F.col("near").alias("near_count"), F.col("total").alias("total_count"), "frequency_percent", "reads_per_million", F.col("detected").cast("int").alias("detected"), "ref_index",
    )
    metrics = library.library_metrics(full).join(library.control_metrics(totals).drop("mapped_reads"), "sample").withColumn("is_undetermined", unassigned)
    rows = {r["sample"]: r.asDict() for r in metrics.toLocalIterator()}
    rows = {s: rows[s] for s in [*names, library.ASSIGNED, library.EVERYTHING] if s in rows}
    categories = library.classification(library.rolled_up(library.category_counts(units, ["sample"], "match_type"), ["category"], unassigned), ["sample"])

    def paths(name: str):
        own = lambda s: at("samples", _file(s), f"{_file(s)}_{name}.tsv")
        return lambda s: [own(s), at("combined", f"{_file(s)}_{name}.tsv")] if s.startswith("ALL_") else [own(s)]

    sink.write_tsvs(shown, "sample", paths("variant_counts"), ["ref_index"], rows, sink.DESIGN_COLUMNS)
    sink.write_tsvs(shown.where("total_count = 0"), "sample", paths("dropout_variants"), ["ref_index"], rows, sink.DESIGN_COLUMNS)
    top = library.top_designs(shown.withColumn("total", F.col("total_count")), "sequence_key")
    sink.write_tsvs(top, "sample", paths("top_variants"), ["place"], rows, sink.DESIGN_COLUMNS)
    sink.write_tsvs(categories, "sample", paths("classification"), ["category"], rows, ["category", "count", "percent"])
    named = {s: {name: m.get(column) for name, column in sink.METRICS.items()} for s, m in rows.items()}
    for s, m in named.items():
        for path in paths("library_metrics")(s):
            sink.write_figures(path, m)
    order = sorted(sink.METRICS)
    sink.write_rows(at("combined", "all_sample_metrics.tsv"), order, named.values())
    sink.write_rows(at("combined", "combined_metrics.tsv"), order, [m for s, m in named.items() if s.startswith("ALL_")])
    keys = ["ref_index", "ids", "sequence", "length", "gc"]
    own = full.where(F.col("sample").isin(names))
    for name, matrix in (("variant_count_matrix", library.count_matrix(own, keys, names)), ("variant_rpm_matrix", library.rpm_matrix(own, keys, names))):
        columns = [key.alias("sequence_key"), key.alias("variant_ids"), F.col("sequence").alias("target_sequence"), "length", F.col("gc").alias("gc_percent"), *[F.col(f"`{n}`").alias(_file(n)) for n in names]]
        table = matrix.select("ref_index", *columns)
        sink.write_tsv(table, at("combined", f"{name}.tsv"), ["ref_index"], table.columns[1:])
    sink.write_tsv(units.groupBy("sample", "orientation").agg(F.count("*").alias("units")), at("qc", "orientations.tsv"), ["sample", "orientation"])
    sink.write_tsv(units.where("distance is not null").groupBy("sample", "distance").agg(F.count("*").alias("units")), at("qc", "distances.tsv"), ["sample", "distance"])
    if c.write_observed_sequences:
        seen = units.join(designs.select("ref_index", "ids"), "ref_index", "left").withColumn("design_key", F.coalesce(key, F.lit("")))
        sink.write_observed(library.observed_sequences(seen), at("observed_sequences"))

    say("[5/6] sample indexes")
    figures = index_quality(spark, c, index_sources(spark, pairs, index, left, c), rows, warnings, c.outdir)
    kinds: dict[str, dict] = {s: {} for s in rows}
    for r in categories.orderBy("sample", "category").collect():
        kinds[r["sample"]][r["category"]] = r["count"]
    say("[6/6] reports")
    curves = "".join(f"<h3>{html.escape(s)}</h3>" + sink.curve(points) for s, points in _curves(full, rows))
    n_ids, n_unique = designs.agg(F.sum("n_ids"), F.count("*")).first()
    facts = {"design_ids": n_ids, "unique_designs": n_unique, "duplicated_designs": n_twice, "fastq_files": len(files.files), "samples": len(names), "units": rows[library.EVERYTHING]["total_units"]}
    _write_reports(c, command, facts, qc_rows, named, kinds, figures, curves, warnings)
    full.unpersist()
    designs.unpersist()
    sink.write_manifest(at("manifest.json"), __version__, command, asdict(c), names, facts, warnings, time.time() - began)
    say(f"Done in {time.time() - began:.1f} seconds: {at('report.html')}, {at('RESULTS_TO_SHARE.txt')}")
    return rows


def _curves(full: DataFrame, samples: Iterable[str]) -> Iterator[tuple[str, list[tuple[int, float]]]]:
    """(sample, points) of every sample's curve; equal counts are one step, so a sample has few points."""
    steps = library.rank_abundance(full).groupBy("sample", "log_count").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    found: dict[str, list] = {s: [] for s in samples}
    for r in steps.toLocalIterator():
        if r["sample"] in found:
            found[r["sample"]] += [(r["first"], r["log_count"]), (r["last"], r["log_count"])]
    yield from found.items()


# What the report shows of each sample and each file, by title.
SAMPLE_TITLES = {"sample": "Sample", "total_read_pairs_or_reads": "Pairs or reads", "phix_fraction_percent": "Spike-in %", "mapped_fraction_percent": "Assigned %", "mapped_fraction_non_phix_percent": "Assigned % without spike-in", "detected_1x_percent": "Detected %", "dropout_sequences": "Dropouts", "mean_coverage": "Mean count", "gini": "Gini", "top_10_percent_read_share_percent": "Share of top 10 %"}
FILE_TITLES = {"sample": "Sample", "read": "Read", "total_reads": "Reads", "mean_q": "Mean quality", "q30_base_percent": "Q30 %", "n_base_percent": "N %"}


def _write_reports(c: source.RunConfig, command: str, facts: dict, qc_rows: list[dict], named: dict, kinds: dict, figures: dict, curves: str, warnings: list[str]) -> None:
    note = f"<p>{library.EVERYTHING} serves diagnosis: where another library with these designs was in the run, it isn't a sample's count.</p>"
    sections = [
        ("Run quality", sink.grid(qc_rows, FILE_TITLES)), ("Samples", sink.grid(named.values(), SAMPLE_TITLES) + note), ("Rank and abundance", curves),
        ("Indexes", sink.grid([{"k": k, "v": v} for k, v in figures.items()], {"k": "Figure", "v": "Value"})), ("Warnings", sink.listing(warnings)),
        ("Reproducibility", sink.listing([command or "called from Python", f"seqloom {__version__}", *[f"{k} = {v}" for k, v in asdict(c).items()]])),
    ]
    sink.write_report(os.path.join(c.outdir, "report.html"), f"{c.target_name}: sequencing quality", sections)
    whole = named[library.EVERYTHING]
    spike: dict | list = ["spike-in classification is off"]
    if c.phix_qc:
        seen = whole["phix_fraction_percent"]
        spike = {"spike-in reads": whole["phix_reads"], "all reads": whole["total_read_pairs_or_reads"], "observed percent": seen, "library to spike-in ratio": whole["library_to_phix_read_ratio"]}
        if c.expected_phix_percent is not None and seen is not None:
            spike |= {"expected percent": c.expected_phix_percent, "observed minus expected": seen - c.expected_phix_percent}
        if c.max_reads:
            spike["note"] = "reads were limited by sample, so the combined fraction isn't that of the run"
    settings = facts | {"left primer": c.left_primer, "right primer": c.right_primer, "mismatches allowed": c.max_mismatches, "reads a sample": c.max_reads or "all", "spike-in genome": c.phix_reference if c.phix_qc else "none", "expected spike-in percent": c.expected_phix_percent}
    quality = [f"{r['sample']} {r['read']}: {sink.fmt_int(r['total_reads'])} reads, mean quality {sink.fmt_float(r['mean_q'])}, Q30 {sink.fmt_float(r['q30_base_percent'])} %, N {sink.fmt_float(r['n_base_percent'], 4)} %" for r in qc_rows]
    blocks: dict[str, list[str] | dict] = {"settings": settings, "run quality": quality, "indexes": figures, "spike-in": spike}
    for s, m in named.items():
        blocks[f"sample {s}"] = {k: v for k, v in m.items() if k != "sample"} | {f"class {k}": n for k, n in kinds[s].items()}
    blocks["warnings"] = warnings
    sink.write_summary(os.path.join(c.outdir, "RESULTS_TO_SHARE.txt"), f"{c.target_name}: summary of the run", blocks)


def _file(sample: str) -> str:
    kept = "".join(ch if ch.isascii() and (ch.isalnum() or ch in "._-") else "_" for ch in sample).strip("._")
    return kept or "sample"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Quality control and quantification of designed sequence libraries")
    p.add_argument("--config")
    for f in fields(source.RunConfig):
        flag = "--" + f.name.replace("_", "-")
        if f.type == "bool":
            p.add_argument(flag, action=argparse.BooleanOptionalAction, default=None)
        else:
            p.add_argument(flag, type=int if f.type.startswith("int") else float if f.type.startswith("float") else str)
    return p


def main(argv: list[str] | None = None) -> int:
    given = vars(parser().parse_args(argv))
    path = given.pop("config")
    config = source.RunConfig.load(path) if path else source.RunConfig()
    config = replace(config, **{k: v for k, v in given.items() if v is not None})
    analyse(SparkSession.builder.appName("seqloom").getOrCreate(), config, " ".join(["seqloom.plans.run", *(sys.argv[1:] if argv is None else argv)]), lambda text: print(text, flush=True))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
