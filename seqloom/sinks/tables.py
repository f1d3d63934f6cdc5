"""Report files: tables in TSV, an HTML page, a text summary and a manifest, at a path or a URI that Arrow opens.

Tables are written by the executors through a Spark data sink, a file a sample, and get their names when all tasks are done; the driver
writes single figures and the reports.
"""

from __future__ import annotations

import hashlib
import html
import io
import json
import math
import os
import platform
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from seqloom.sources.fastq import located

# Names and order of a sample's metrics in its file, with the column that holds each.
METRICS = {
    name: source or name
    for name, source in (
        ("sample", ""), ("is_undetermined", ""), ("designed_ids", ""), ("unique_design_sequences", ""), ("total_read_pairs_or_reads", "total_units"), ("phix_reads", ""),
        ("phix_fraction_percent", ""), ("non_phix_read_pairs_or_reads", "non_phix_units"), ("library_to_phix_read_ratio", ""), ("mapped_reads", ""), ("exact_mapped_reads", ""),
        ("near_mapped_reads", ""), ("mapped_fraction_percent", ""), ("mapped_fraction_non_phix_percent", ""), ("unresolved_non_phix_reads", ""), ("unresolved_non_phix_percent", ""),
        ("detected_1x", ""), ("detected_1x_percent", ""), ("detected_10x", ""), ("detected_10x_percent", ""), ("detected_100x", ""), ("detected_100x_percent", ""),
        ("detected_500x", ""), ("detected_500x_percent", ""), ("dropout_sequences", ""), ("mean_coverage", ""), ("median_coverage", ""), ("min_nonzero_coverage", ""),
        ("max_coverage", ""), ("coverage_cv", ""), ("p05_coverage", ""), ("p10_coverage", ""), ("p90_coverage", ""), ("p95_coverage", ""), ("p90_over_p10", ""), ("p95_over_p05", ""),
        ("gini", ""), ("top_1_percent_read_share_percent", ""), ("top_10_percent_read_share_percent", ""), ("effective_library_size", ""), ("spearman_length_logcount", ""),
        ("spearman_gc_logcount", ""), ("left_anchor_percent", ""), ("right_anchor_percent", ""), ("both_anchors_percent", ""), ("pair_header_mismatches", ""),
        ("pair_base_disagreements", ""), ("ambiguous_reads", ""), ("anchor_missing_reads", ""), ("unassigned_reads", "unresolved_non_phix_reads"),
    )
}
# Columns of the tables of designs, of files and of cycles.
DESIGN_COLUMNS = ["sequence_key", "variant_ids", "duplicate_id_count", "target_sequence", "length", "gc_percent", "exact_count", "near_count", "total_count", "frequency_percent", "reads_per_million", "detected"]
FILE_COLUMNS = ["label", "sample", "read", "path", "total_reads", "total_bases", "mean_length", "min_length", "max_length", "mean_q", "q20_base_percent", "q30_base_percent", "n_base_percent", "reads_with_n_percent"]
CYCLE_COLUMNS = ["label", "sample", "read", "cycle", "total_bases", "mean_q", "q20_percent", "q30_percent", "A_percent", "C_percent", "G_percent", "T_percent", "N_percent"]


def cell(value: object) -> str:
    """None as NA, floats with eight significant digits, arrays joined by '|', the rest as Python prints it."""
    if value is None or isinstance(value, float) and not math.isfinite(value):
        return "NA"
    if isinstance(value, float):
        return f"{value:.8g}"
    if isinstance(value, list):
        return "|".join(map(str, value))
    return str(value)


def create(path: str) -> io.TextIOWrapper:
    """A new text file at a path or URI; its folder is made."""
    store, name = located(path)
    store.create_dir(os.path.dirname(name), recursive=True)
    return io.TextIOWrapper(store.open_output_stream(name), encoding="utf-8", newline="")


def write_rows(path: str, names: list[str], rows: Iterable[dict]) -> None:
    with create(path) as out:
        out.write("\t".join(names) + "\n")
        for row in rows:
            out.write("\t".join(cell(row[n]) if n in row else "" for n in names) + "\n")


def write_figures(path: str, figures: dict) -> None:
    write_rows(path, ["metric", "value"], [{"metric": k, "value": v} for k, v in figures.items()])


@dataclass
class Written(WriterCommitMessage):
    """Files that a task has written, by key, under names of its own."""

    files: dict[str, str]


class _TsvWriter(DataSourceArrowWriter):
    """Each task formats its rows and writes a file for each of its keys; commit gives the files their names, abort removes them."""

    def __init__(self, options: dict[str, str]):
        self.paths: dict[str, list[str]] = json.loads(options["files"])
        self.header = options["header"]
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files: dict[str, str] = {}
        out, now = None, object()
        try:
            for batch in iterator:
                keys, *columns = (c.to_pylist() for c in batch.columns)
                for key, row in zip(keys, zip(*columns, strict=True), strict=True):
                    if key != now:
                        if out is not None:
                            out.close()
                        if key in files:
                            raise ValueError(f"rows of {key} don't come together")
                        now, out = key, None
                        if key in self.paths:
                            files[key] = f"{self.paths[key][0]}.{self.run}-{TaskContext.get().taskAttemptId()}"
                            out = create(files[key])
                            out.write(self.header)
                    if out is not None:
                        out.write("\t".join(map(cell, row)) + "\n")
            if out is not None:
                out.close()
        except BaseException:
            if out is not None:
                out.close()
            self.abort([Written(files)])
            raise
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        found: dict[str, str] = {}
        for m in messages:
            for key, path in (m.files if m else {}).items():
                if key in found:
                    raise ValueError(f"rows of {key} come from two tasks")
                found[key] = path
        for key, (path, *others) in self.paths.items():
            store, name = located(path)
            if key in found:
                store.move(located(found[key])[1], name)
            else:
                with create(path) as out:
                    out.write(self.header)
            for other in others:
                target = located(other)[1]
                store.create_dir(os.path.dirname(target), recursive=True)
                store.copy_file(name, target)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            for path in (m.files if m else {}).values():
                store, name = located(path)
                store.delete_file(name)


class TsvSink(DataSource):
    """Options: files (JSON: key -> paths), header. The first column is the key; rows of a key come together, in order."""

    @classmethod
    def name(cls) -> str:
        return "seqloom_tsv"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _TsvWriter(dict(self.options))


def write_tsv(df: DataFrame, path: str, order: list | None = None, names: list[str] | None = None) -> None:
    """One file, written by one task."""
    write_tsvs(df.withColumn("_file", F.lit("")), "_file", lambda _: [path], order or [], [""], names or df.columns)


def write_tsvs(df: DataFrame, key: str, paths: Callable[[str], list[str]], order: list, keys: Iterable[str], names: list[str]) -> None:
    """A file of ``names`` for each of ``keys`` (and a copy at each further path), of the rows that have it, by ``order``. One job writes all files, on the executors."""
    spark = df.sparkSession
    spark.dataSource.register(TsvSink)
    rows = df.repartition(key).sortWithinPartitions(key, *order).select(F.col(key).cast("string").alias("_key"), *names)
    rows.write.format("seqloom_tsv").option("files", json.dumps({k: paths(k) for k in keys})).option("header", "\t".join(names) + "\n").mode("append").save()


def write_observed(df: DataFrame, path: str) -> None:
    """Gzipped TSV parts, ordered by sample, falling count, design and sequence across the parts."""
    ordered = df.withColumnRenamed("observed", "observed_target_sequence").orderBy("sample", F.desc("count"), "design_key", "observed_target_sequence")
    ordered.write.mode("errorifexists").option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def prepare_folder(path: str, overwrite: bool) -> None:
    store, name = located(path)
    if store.get_file_info(name).type != pafs.FileType.NotFound:
        if not overwrite:
            raise FileExistsError(path)
        store.delete_dir(name)
    store.create_dir(name, recursive=True)


def fmt_int(value: float | None) -> str:
    return "NA" if value is None else f"{round(value):,}"


def fmt_float(value: float | None, digits: int = 2) -> str:
    return "NA" if value is None or not math.isfinite(value) else f"{value:.{digits}f}"


def _show(value: object, digits: int = 3) -> str:
    return fmt_float(value, digits) if isinstance(value, float) else f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else cell(value)


def grid(rows: Iterable[dict], columns: dict[str, str]) -> str:
    """HTML table of ``columns`` (title by key), numbers to the right."""
    rows = list(rows)
    if not rows:
        return "<p class=none>nothing to show</p>"
    parts = ["<table>", "<tr>", *[f"<th>{html.escape(t)}" for t in columns.values()]]
    for row in rows:
        parts.append("<tr>")
        for key in columns:
            value = row.get(key)
            parts.append(f"<td{' class=number' if isinstance(value, int | float) else ''}>{html.escape(_show(value))}")
    return "".join([*parts, "</table>"])


def curve(points: list[tuple[int, float]]) -> str:
    """Rank-abundance curve: log10(count + 1) by place, drawn in a box of 100 by 40 units."""
    most, top = max((p for p, _ in points), default=0), max((y for _, y in points), default=0.0)
    if top <= 0:
        return "<p class=none>no reads assigned</p>"
    path = "L".join(f"{100 * (p - 1) / max(1, most - 1):.2f} {40 - 38 * y / top:.2f}" for p, y in sorted(points))
    return f"<figure><svg viewBox='0 0 100 40' preserveAspectRatio='none'><path d='M{path}' vector-effect='non-scaling-stroke'/></svg><figcaption>{most:,} designs by falling count; top of the scale: log10(count + 1) = {top:.2f}</figcaption></figure>"


STYLE = "body{font:15px/1.4 sans-serif;max-width:70rem;margin:auto;padding:1rem}table{border-collapse:collapse}td,th{padding:.2rem .6rem;border-bottom:1px solid #ccc;text-align:left}.number{text-align:right}svg{width:100%;height:12rem;fill:none;stroke:#246}.none{color:#777}"


def write_report(path: str, title: str, sections: list[tuple[str, str]]) -> None:
    links = " · ".join(f"<a href='#s{i}'>{html.escape(name)}</a>" for i, (name, _) in enumerate(sections))
    parts = "".join(f"<section id=s{i}><h2>{html.escape(name)}</h2>{body}</section>" for i, (name, body) in enumerate(sections))
    with create(path) as out:
        out.write(f"<!DOCTYPE html><html lang=en><meta charset=utf-8><title>{html.escape(title)}</title><style>{STYLE}</style><h1>{html.escape(title)}</h1><nav>{links}</nav>{parts}</html>\n")


def listing(lines: list[str]) -> str:
    return "<ul>" + "".join(f"<li>{html.escape(x)}" for x in lines) + "</ul>" if lines else "<p class=none>none</p>"


def write_summary(path: str, title: str, blocks: dict[str, list[str] | dict]) -> None:
    """Plain text to share: titled blocks of lines, or of figures by name."""
    with create(path) as out:
        out.write(f"{title}\n{'=' * len(title)}\n")
        for name, block in blocks.items():
            lines = [f"{k}: {_show(v, 4)}" for k, v in block.items()] if isinstance(block, dict) else block
            out.write(f"\n[{name}]\n" + "".join(f"{x}\n" for x in lines or ["none"]))


def write_manifest(path: str, version: str, command: str, config: dict, samples: list[str], counts: dict, warnings: list[str], seconds: float) -> None:
    with open(config["reference"], "rb") as f:
        digest = hashlib.file_digest(f, "sha256").hexdigest()
    facts = {
        "pipeline": "seqloom", "version": version, "generated_at": time.strftime("%Y-%m-%dT%H:%M:%S"), "runtime_seconds": round(seconds, 3), "python": platform.python_version(), "command": command,
        "reference_path": config["reference"], "reference_sha256": digest, "input_dir": config["input_dir"], "sample_names": samples, "counts": counts, "arguments": config, "warnings": warnings,
    }
    with create(path) as out:
        json.dump(facts, out, indent=2, ensure_ascii=False)
