"""Small inputs of a run: designs, spike-in genome, sample sheet, unknown barcodes, configuration.

They are parsed on the driver, since their layout rules (sniffed delimiters, header aliases, sections) are looser
than Spark's readers allow, and become DataFrames. The number of designs and samples bounds them.
"""

from __future__ import annotations

import configparser
import csv
import os
import re
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.scalars import gc_percent, trim_flanks
from seqloom.operators.library import group_designs
from seqloom.sources.fastq import open_text

FASTA = (".fa", ".fasta", ".fna", ".fa.gz", ".fasta.gz")


def clean_dna(value: str, allow_n: bool = False) -> str:
    dna = re.sub("[^A-Za-z]", "", value).upper().replace("U", "T")
    if not re.fullmatch("[ACGTN]+" if allow_n else "[ACGT]+", dna):
        raise ValueError(f"not a DNA sequence: {value[:40]!r}")
    return dna


def fasta_records(path: str) -> list[tuple[str, str]]:
    out: list[list] = []
    with open_text(path) as lines:
        for line in map(str.strip, lines):
            if line.startswith(">"):
                out.append([(line[1:].split() or [""])[0], []])
            elif line and out:
                out[-1][1].append(line)
            elif line:
                raise ValueError(f"{path}: sequence before the first header")
    return [(name, "".join(parts)) for name, parts in out]


def genome(spark: SparkSession, path: str) -> DataFrame:
    """One-row frame (sequence): all sequence lines of a FASTA file put together."""
    return spark.createDataFrame([(clean_dna("".join(s for _, s in fasta_records(path))),)], "sequence string")


def _delimited(path: str) -> list[list[str]]:
    with open_text(path) as f:
        text = f.read().lstrip("\ufeff")
    if not text.strip():
        return []
    try:
        mark = csv.Sniffer().sniff(text[:8192], delimiters=",\t;").delimiter
    except csv.Error:
        mark = "\t" if "\t" in text[:8192] else ","
    return [row for row in csv.reader(text.splitlines(), delimiter=mark)]


def design_rows(path: str, id_column: str = "Variant_ID", sequence_column: str = "target_sequence") -> list[tuple[int, str, str]]:
    """(place, id, sequence) of a FASTA or delimited file; duplicate ids and half-blank rows raise ValueError."""
    if path.lower().endswith(FASTA):
        rows = [(i, name, clean_dna(seq)) for i, (name, seq) in enumerate(fasta_records(path))]
    else:
        head, *body = _delimited(path) or [[]]
        at = {c.strip().lower(): i for i, c in enumerate(head)}
        try:
            a, b = at[id_column.strip().lower()], at[sequence_column.strip().lower()]
        except KeyError as e:
            raise ValueError(f"{path}: no column {e}") from None
        rows = []
        for line, row in enumerate(body, 2):
            key, seq = (row[i].strip() if i < len(row) else "" for i in (a, b))
            if not key and not seq:
                continue
            if not key or not seq:
                raise ValueError(f"{path}: line {line} lacks its id or sequence")
            rows.append((line, key, clean_dna(seq)))
    if not rows:
        raise ValueError(f"{path}: no designs")
    seen: set[str] = set()
    for _, key, _ in rows:
        if key in seen:
            raise ValueError(f"{path}: id {key} twice")
        seen.add(key)
    return rows


def designs(spark: SparkSession, path: str, left_primer: str, right_primer: str, mode: str = "auto", **columns: str) -> DataFrame:
    """(ref_index, sequence, ids, n_ids, length, gc): unique targets without their flanks."""
    rows = spark.createDataFrame(design_rows(path, **columns), "ord long, id string, sequence string")
    trimmed = rows.withColumn("sequence", trim_flanks(F.col("sequence"), left_primer, right_primer, mode))
    return group_designs(trimmed).withColumns({"length": F.length("sequence"), "gc": gc_percent(F.col("sequence"))})


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample, i7, i5), upper case, from the [Data] section or the whole file; rows without sample or i7 are skipped.

    Blank lines don't count. Of the names that a column may have, the first one that isn't blank in a row is taken. An empty sheet gives no rows.
    """
    rows = [r for r in _delimited(path) if any(c.strip() for c in r)]
    data = [i for i, r in enumerate(rows) if r[0].strip().lower() == "[data]"]
    head, *body = (rows[data[0] + 1 :] if data else rows) or [[]]
    names = [c.strip().lower() for c in head]
    out = []
    for row in body:
        cells = dict(zip(names, (c.strip().upper() for c in row)))  # noqa: B905
        value = lambda *alias: next((cells[a] for a in alias if cells.get(a)), "")  # noqa: B023, E731
        sample, i7, i5 = value("sample_id", "sampleid", "sample_name", "samplename"), value("index", "index1"), value("index2")
        i7, i5 = (re.sub("[^ACGTN]", "", v) for v in (i7, i5))
        if sample and i7:
            out.append((sample, i7, i5))
    return spark.createDataFrame(out, "sample string, i7 string, i5 string")


def _whole_number(cell: str) -> int | None:
    """A count as tables write it (1,234 or 1e3), cut to a whole number; None for other words and negative numbers."""
    try:
        n = int(float(cell.replace(",", "")))
    except (ValueError, OverflowError):
        return None
    return n if n >= 0 else None


def unknown_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """(barcode, count) of a table of unassigned barcodes: columns named like index or barcode and like count are
    looked at first, the others in order; a row without a count counts once. An empty table gives none."""
    head, *body = _delimited(path) or [[]]
    order = lambda words: sorted(range(len(head)), key=lambda i: (not any(w in head[i].lower() for w in words), i))
    codes, numbers = order(("barcode", "index")), order(("count", "read", "cluster"))
    out = []
    for row in body:
        code = next((c for i in codes if i < len(row) and (c := row[i].strip().upper().replace("-", "+").replace("_", "+")) and re.fullmatch("[ACGTN+]+", c) and len(c.replace("+", "")) >= 6), None)
        if code is not None:
            out.append((code, next((n for i in numbers if i < len(row) and (n := _whole_number(row[i].strip())) is not None), 1)))
    return spark.createDataFrame(out, "barcode string, count long").groupBy("barcode").agg(F.sum("count").alias("count"))


# Other names that configurations give an option, and the words for yes and no.
OPTION_NAMES = {"phix_enabled": "phix_qc"}
YES_NO = {"1": True, "yes": True, "true": True, "on": True, "0": False, "no": False, "false": False, "off": False}


@dataclass(frozen=True)
class RunConfig:
    """Options of a run; ``load`` reads them from an INI file, relative paths against its folder."""

    target_name: str = "target"
    input_dir: str = ""
    reference: str = ""
    outdir: str = ""
    id_column: str = "Variant_ID"
    sequence_column: str = "target_sequence"
    reference_mode: str = "auto"
    left_primer: str = ""
    right_primer: str = ""
    anchor_mismatches: int = 1
    signature_length: int = 20
    max_mismatches: int = 2
    sample_sheet: str = ""
    top_unknown: str = ""
    max_index_distance: int = 2
    phix_qc: bool = True
    phix_reference: str = ""
    expected_phix_percent: float | None = None
    phix_kmer_length: int = 27
    phix_min_kmer_hits: int = 1
    max_reads: int | None = None
    write_observed_sequences: bool = False
    overwrite: bool = False

    @staticmethod
    def load(path: str) -> RunConfig:
        ini = configparser.ConfigParser(interpolation=None)
        if not ini.read(path):
            raise FileNotFoundError(path)
        flat = {OPTION_NAMES.get(k, k): v.strip() for section in ini.sections() for k, v in ini[section].items() if v.strip()}
        known = {f.name: f.type for f in fields(RunConfig)}
        values: dict = {"write_observed_sequences": True}
        for k, v in flat.items():
            if k not in known:
                continue
            kind = known[k]
            if kind == "bool" and v.lower() not in YES_NO:
                raise ValueError(f"{path}: {k} is yes or no, not {v!r}")
            values[k] = YES_NO[v.lower()] if kind == "bool" else int(v) if kind.startswith("int") else float(v) if kind.startswith("float") else v
            if k in ("input_dir", "reference", "outdir", "sample_sheet", "top_unknown", "phix_reference") and "://" not in v:
                values[k] = os.path.normpath(os.path.join(os.path.dirname(os.path.abspath(path)), v))
        return RunConfig(**values)

    def checked(self) -> RunConfig:
        """The same with clean primers and name; raises ValueError for what is missing, absent or out of bounds."""
        for name in ("input_dir", "reference", "outdir", "left_primer", "right_primer"):
            if not getattr(self, name):
                raise ValueError(f"{name} is required")
        if self.phix_qc and not self.phix_reference:
            raise ValueError("phix_reference is required unless phix_qc is off")
        if "://" not in self.input_dir and not os.path.isdir(self.input_dir):
            raise ValueError(f"input_dir is no folder: {self.input_dir}")
        for name in ("reference", "sample_sheet", "top_unknown", *(["phix_reference"] if self.phix_qc else [])):
            if getattr(self, name) and not os.path.isfile(getattr(self, name)):
                raise ValueError(f"{name} is no file: {getattr(self, name)}")
        rules = (
            (self.reference_mode in ("auto", "target", "amplicon"), "reference_mode is auto, target or amplicon"),
            (self.signature_length >= 8, "signature_length is at least 8"), (0 <= self.max_mismatches <= 5, "max_mismatches is 0 to 5"),
            (0 <= self.anchor_mismatches <= 3, "anchor_mismatches is 0 to 3"), (self.max_reads is None or self.max_reads > 0, "max_reads is above 0"),
            (17 <= self.phix_kmer_length <= 51, "phix_kmer_length is 17 to 51"), (self.phix_min_kmer_hits >= 1, "phix_min_kmer_hits is at least 1"),
            (self.expected_phix_percent is None or 0 <= self.expected_phix_percent <= 100, "expected_phix_percent is 0 to 100"),
        )
        for ok, message in rules:
            if not ok:
                raise ValueError(message)
        return replace(self, target_name=" ".join(self.target_name.split()) or "target", left_primer=clean_dna(self.left_primer), right_primer=clean_dna(self.right_primer))
