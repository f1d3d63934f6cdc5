"""Read quality per file and per cycle.

Both are sums over bases. An Arrow task adds them up with NumPy, batch by batch, and hands on one row per group (and
cycle) of a batch; Spark sums those. A base costs a few vector operations and no row of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.functions.scalars import pct
from seqloom.sinks.store import kept

_BASES = "ACGT"
_READ_SUMS = ["total_reads", "total_bases", "min_length", "max_length", "q", "q20", "q30", "ns", "with_n"]
_CYCLE_SUMS = ["total_bases", "q", "q20", "q30", *_BASES.lower(), "n"]
_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(_BASES.encode(), np.uint8)] = np.arange(4)
#: Bases that one step works on.
STEP = 1 << 20


def flat_letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters of all rows, where each row's begin); nulls are empty, letters outside ASCII are one '?' each."""
    column = pc.fill_null(column.cast(pa.string()), "")
    if pc.sum(pc.binary_length(column)).as_py() != pc.sum(pc.utf8_length(column)).as_py():
        column = pc.replace_substring_regex(column, r"[^\x00-\x7F]", "?")
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    letters = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return letters, at - at[0]


def _groups(batch: pa.RecordBatch, by: list[str]) -> tuple[list[pa.Array], np.ndarray]:
    """(distinct keys as columns, the key of each row)."""
    columns = [batch.column(batch.schema.get_field_index(c)) for c in by]
    numbers: dict[tuple, int] = {}
    code = np.array([numbers.setdefault(k, len(numbers)) for k in (zip(*[c.to_pylist() for c in columns], strict=True) if by else [()] * batch.num_rows)], np.int64)
    _, first = np.unique(code, return_index=True)
    return [c.take(pa.array(first)) for c in columns], code


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, base codes, qualities, offsets) of whole reads, about STEP bases at a time."""
    seq, qual = (batch.column(batch.schema.get_field_index(c)) for c in ("seq", "qual"))
    ends = np.cumsum(pc.fill_null(pc.utf8_length(seq), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + STEP, "right")))
        (bases, at), (quals, at_q) = flat_letters(seq.slice(i, j - i)), flat_letters(qual.slice(i, j - i))
        if not np.array_equal(at, at_q):
            raise ValueError("a read has unequal numbers of bases and qualities")
        yield i, j, _CODE[bases], np.maximum(quals, 33) - np.uint8(33), at
        i = j


def _summed(reads: DataFrame, by: list[str], sums: list[str], run, extra: str = "") -> DataFrame:
    keys = [reads.schema[c] for c in by]
    schema = T.StructType([*keys, *T.StructType.fromDDL(extra + ", ".join(f"`{c}` long" for c in sums)).fields])
    return reads.select(*by, "seq", "qual").mapInArrow(run, schema)


def _read_sums(by: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_base = np.uint8(ord("N"))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, code = _groups(batch, by)
            groups = int(code.max()) + 1
            out = {c: np.zeros(groups, np.int64) for c in _READ_SUMS}
            out["min_length"] += np.iinfo(np.int64).max
            seq = batch.column(batch.schema.get_field_index("seq"))
            for i, j, _, q, at in _steps(batch):
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[at])  # noqa: B023, E731
                own, size = code[i:j], np.diff(at)
                ns = total(flat_letters(seq.slice(i, j - i))[0] == n_base)
                for name, value in (("total_reads", np.ones_like(size)), ("total_bases", size), ("q", total(q)), ("q20", total(q >= 20)), ("q30", total(q >= 30)), ("ns", ns), ("with_n", ns > 0)):
                    np.add.at(out[name], own, value)
                np.minimum.at(out["min_length"], own, size)
                np.maximum.at(out["max_length"], own, size)
            yield pa.RecordBatch.from_arrays([*keys, *[pa.array(out[c]) for c in _READ_SUMS]], [*by, *_READ_SUMS])

    return run


def _cycle_sums(by: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, code = _groups(batch, by)
            for i, j, base, q, at in _steps(batch):
                if not len(base):
                    continue
                longest = np.zeros(int(code.max()) + 1, np.int64)
                np.maximum.at(longest, code[i:j], np.diff(at))
                begin = np.concatenate([[0], np.cumsum(longest)])
                cell = np.arange(len(base)) + np.repeat(begin[code[i:j]] - at[:-1], np.diff(at))  # a cell for each group and cycle that occurs
                cells = int(begin[-1])
                kinds = np.bincount(cell * 16 + (base + 5 * ((q >= 20).astype(np.uint8) + (q >= 30))), minlength=16 * cells).reshape(cells, 16)[:, :15].reshape(cells, 3, 5)
                sums = [kinds.sum((1, 2)), np.bincount(cell, q, cells), kinds[:, 1:].sum((1, 2)), kinds[:, 2].sum(1), *kinds.sum(1).T]
                group = np.repeat(np.arange(len(longest)), longest)
                columns = [*[k.take(pa.array(group)) for k in keys], pa.array(np.arange(cells) - begin[group] + 1), *[pa.array(x.astype(np.int64)) for x in sums]]
                yield pa.RecordBatch.from_arrays(columns, [*by, "cycle", *_CYCLE_SUMS])

    return run


def _read_figures(per: DataFrame, by: list[str]) -> DataFrame:
    bases = F.sum("total_bases")
    return per.groupBy(*by).agg(
        F.sum("total_reads").alias("total_reads"), bases.alias("total_bases"), F.try_divide(bases.cast("double"), F.sum("total_reads").cast("double")).alias("mean_length"),
        F.min("min_length").alias("min_length"), F.nullif(F.max("max_length"), F.lit(0)).alias("max_length"),
        F.try_divide(F.sum("q").cast("double"), bases.cast("double")).alias("mean_q"), pct(F.sum("q20"), bases).alias("q20_base_percent"), pct(F.sum("q30"), bases).alias("q30_base_percent"),
        pct(F.sum("ns"), bases).alias("n_base_percent"), pct(F.sum("with_n"), F.sum("total_reads")).alias("reads_with_n_percent"),
    )


def _cycle_figures(per: DataFrame, by: list[str]) -> DataFrame:
    n = F.sum("total_bases")
    share = lambda c: pct(F.sum(c), n)
    return per.groupBy(*by, "cycle").agg(
        n.alias("total_bases"), F.try_divide(F.sum("q").cast("double"), n.cast("double")).alias("mean_q"), share("q20").alias("q20_percent"), share("q30").alias("q30_percent"),
        *[share(b).alias(f"{b}_percent") for b in "acgt"], share("n").alias("n_percent"),
    )


def read_qc(reads: DataFrame, by: list[str]) -> DataFrame:
    """Totals, lengths, mean quality and shares of good and N bases per group of reads(seq, qual).

    Letters other than N count as bases; null reads are empty; unequal numbers of bases and qualities fail.
    """
    return _read_figures(_summed(reads, by, _READ_SUMS, _read_sums(by)), by)


def cycle_qc(reads: DataFrame, by: list[str]) -> DataFrame:
    """The same per position in the read, with base composition; other letters count as N."""
    return _cycle_figures(_summed(reads, by, _CYCLE_SUMS, _cycle_sums(by), "cycle long, "), by)


def both_qc(reads: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``read_qc``, ``cycle_qc``) from one pass over the reads, whose sums are kept; those of whole reads stand at cycle 0."""
    names = list(dict.fromkeys([*_READ_SUMS, *_CYCLE_SUMS]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sums in (_read_sums(by), _cycle_sums(by)):
                for part in sums(iter([batch])):
                    rows = part.num_rows
                    have = {n: part.column(part.schema.get_field_index(n)) for n in part.schema.names}
                    cycle = have.get("cycle", pa.array(np.zeros(rows, np.int64)))
                    yield pa.RecordBatch.from_arrays([*[have[c] for c in by], cycle, *[have.get(n, pa.nulls(rows, pa.int64())) for n in names]], [*by, "cycle", *names])

    per = kept(_summed(reads, by, names, run, "cycle long, "), "quality")
    return _read_figures(per.where("cycle = 0"), by), _cycle_figures(per.where("cycle > 0"), by)
