"""Spike-in control: units that share exact k-mers with a circular genome.

A k-mer is two bits a base in one or two whole numbers. A task computes the codes of all windows of its reads by doubling (a code of 2 m bases is two of m
bases) and looks up those it probes in the genome's sorted codes, so nothing is exploded or shuffled; a genome of more than
``MOST_KEPT`` different k-mers meets the reads' codes by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.functions.scalars import reverse_complement
from seqloom.operators.qc import flat_letters

MOST_KEPT = 4 << 20  # codes that are sent to all tasks: 64 MB
WORD = 31  # bases in one number
STEP = 1 << 18  # bases that are worked on together, of whatever reads: some 40 MB of a worker
_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)


def packed(letters: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high, low, whether all its letters are bases) of the k letters from each place on that has so many; ``high`` holds what goes over WORD bases."""
    n = len(letters) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    base = _CODE[letters]
    bad = np.concatenate([[0], np.cumsum(base > 3)])
    single = np.append(base & 3, np.zeros(k, np.uint8)).astype(np.int64)
    over = max(0, k - WORD)
    return _code(single, over)[:n], _code(single, k - over)[over : over + n], bad[k:] == bad[:-k]


def _code(single: np.ndarray, size: int) -> np.ndarray:
    """Codes of ``size`` bases from every place on.

    Not an inner function of ``packed``: one that calls itself is a reference cycle, which keeps the arrays it sees until Python looks for cycles.
    """
    if size <= 1:
        return single if size else np.zeros_like(single)
    half = size // 2
    left = _code(single, half)
    out = (left << np.int64(2 * half)) | np.concatenate([left[half:], np.zeros(half, np.int64)])
    return (out << np.int64(2)) | np.concatenate([single[2 * half :], np.zeros(2 * half, np.int64)]) if size % 2 else out


def window_steps(at: np.ndarray, k: int, stride: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first letter, end letter, read, place in it) of the windows at 0, stride, 2 * stride, .. and the last one; none of reads under k.

    ``at`` says where each read begins. A step has the windows that begin in STEP letters, be these many reads or a part of one; its end lies k - 1 letters further.
    """
    last = np.diff(at) - k
    for begin in range(0, int(at[-1]), STEP):
        end = min(begin + STEP, int(at[-1]))
        i, j = int(np.searchsorted(at, begin, "right")) - 1, int(np.searchsorted(at, end, "left"))
        own, first = last[i:j], np.maximum(begin - at[i:j], 0)
        turns = -(-first // stride)
        many = np.maximum(-(-np.minimum(end - at[i:j], own + 1) // stride) - turns, 0)
        many += (own % stride > 0) & (own >= first) & (own < end - at[i:j])
        read = np.repeat(np.arange(j - i), many)
        turn = np.arange(len(read)) - np.repeat(np.cumsum(many) - many, many) + turns[read]
        yield begin, min(end + k - 1, int(at[-1])), read + i, np.minimum(turn * stride, own[read])


def _codes(column: pa.Array, k: int, stride: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, high, low) of the windows that a column's reads are probed at, in steps of ``window_steps``. Windows with other letters match nothing."""
    letters, at = flat_letters(column)
    for begin, end, row, place in window_steps(at, k, stride):
        high, low, good = packed(letters[begin:end], k)
        where = at[row] + place - begin
        ok = good[where]
        yield row[ok], high[where[ok]], low[where[ok]]


def genome_kmers(genomes: DataFrame, k: int, circular: bool = True) -> DataFrame:
    """Distinct k-mers (high, low) of genomes(sequence) on both strands, over the joint if circular."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, high, low in _codes(batch.column(0), k, 1):
                yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], ["high", "low"])

    seq = F.col("sequence")
    whole = F.when(F.length(seq) >= k, F.concat(seq, F.left(seq, F.lit(k - 1)))).otherwise(F.lit("")) if circular else seq
    strands = genomes.select(F.explode(F.array(whole, reverse_complement(whole))).alias("s"))
    return strands.mapInArrow(run, "high long, low long").distinct()


def _mixed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return low ^ (high * np.int64(-7046029254386353131))


def _sorted(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """Codes in order of a mixed key, and how many may share one."""
    key = _mixed(high, low)
    order = np.argsort(key)
    key = key[order]
    same = int(np.unique(key, return_counts=True)[1].max(initial=0))
    return key, high[order], low[order], np.array(same)


def _found(kept: tuple[np.ndarray, ...], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    key, own_high, own_low, same = kept
    if not len(key):
        return np.zeros(len(high), bool)
    at = np.searchsorted(key, _mixed(high, low))
    out = np.zeros(len(high), bool)
    for step in range(int(same)):
        x = np.minimum(at + step, len(key) - 1)
        out |= (own_high[x] == high) & (own_low[x] == low)
    return out


def kmer_hits(units: DataFrame, key: list[str], seqs: list[Column], kmers: DataFrame, k: int, stride: int = 7, most_kept: int = MOST_KEPT) -> DataFrame:
    """(key, hits): windows of a unit's reads that are in ``kmers``, counted across its mates; units without any are left out.

    ``key`` names a unit. Up to ``most_kept`` k-mers go to all tasks as a sorted array; more are joined.
    """
    names = [f"_s{i}" for i in range(len(seqs))]
    reads = units.select(*key, *[s.alias(n) for s, n in zip(seqs, names, strict=True)])
    schema = T.StructType([reads.schema[c] for c in key])
    some = kmers.limit(most_kept + 1).toPandas()
    if len(some) > most_kept:

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(key), batch.num_columns):
                    for row, high, low in _codes(batch.column(i), k, stride):
                        yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row)) for c in batch.columns[: len(key)]], pa.array(high), pa.array(low)], [*key, "high", "low"])

        rows = reads.mapInArrow(spread, T.StructType([*schema.fields, *T.StructType.fromDDL("high long, low long").fields]))
        return rows.join(kmers, ["high", "low"], "left_semi").groupBy(*key).agg(F.count("*").alias("hits"))

    shared = units.sparkSession.sparkContext.broadcast(_sorted(some["high"].to_numpy(np.int64), some["low"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = np.zeros(batch.num_rows, np.int64)
            for i in range(len(key), batch.num_columns):
                for row, high, low in _codes(batch.column(i), k, stride):
                    hits += np.bincount(row[_found(shared.value, high, low)], minlength=batch.num_rows)
            some = pa.array(np.flatnonzero(hits))
            yield pa.RecordBatch.from_arrays([*[c.take(some) for c in batch.columns[: len(key)]], pa.array(hits[hits > 0])], [*key, "hits"])

    return reads.mapInArrow(run, T.StructType([*schema.fields, T.StructField("hits", T.LongType())]))


def spike_in_units(units: DataFrame, key: list[str], seqs: list[Column], kmers: DataFrame, k: int = 27, min_hits: int = 1) -> DataFrame:
    return kmer_hits(units, key, seqs, kmers, k).where(F.col("hits") >= min_hits).select(*key)
