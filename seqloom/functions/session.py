"""The sequence functions in SQL text: ``register(spark)`` gives a session its functions and table function.

Scalar functions are SQL expressions that Catalyst inlines. ``seq_kmers(TABLE(..), k, stride)`` takes rows (id, seq) and gives (id, place, kmer) of every
``stride``-th window and the last one, a step of ``window_steps`` at a time. FASTQ folders are read by ``CREATE TEMPORARY VIEW .. USING fastq OPTIONS (path ..)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from seqloom.functions.scalars import COMPLEMENT, INCOMPARABLE, INDEX_FIELD
from seqloom.operators.controls import window_steps
from seqloom.operators.qc import flat_letters
from seqloom.sources.fastq import FastqSource

_GC = "length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))"
_FIELD = "upper(element_at(split(element_at(split(btrim(header), '\\\\s+'), -1), ':'), -1))"
_SIZES = "transform(split({0}, '[+]'), x -> length(x))"
#: name and arguments, result, SQL
FUNCTIONS = (
    ("seq_reverse_complement(seq STRING)", "STRING", f"reverse(translate(seq, '{COMPLEMENT[0]}', '{COMPLEMENT[1]}'))"),
    ("seq_gc_percent(seq STRING)", "DOUBLE", f"try_divide(100.0D * CAST({_GC} AS DOUBLE), CAST(length(seq) AS DOUBLE))"),
    ("seq_differing(a STRING, b STRING)", "INT", "CASE WHEN length(a) <> length(b) THEN greatest(length(a), length(b)) ELSE aggregate(zip_with(split(a, ''), split(b, ''), (x, y) -> CAST(x <> y AS INT)), 0, (s, v) -> s + v) END"),
    ("seq_edits(a STRING, b STRING, most INT)", "INT", "CASE WHEN levenshtein(a, b) > most THEN most + 1 ELSE levenshtein(a, b) END"),
    ("seq_header_index(header STRING)", "STRING", f"CASE WHEN size(split(btrim(header), '\\\\s+')) >= 2 AND length(replace({_FIELD}, '+', '')) BETWEEN 6 AND 40 AND {_FIELD} RLIKE '{INDEX_FIELD}' THEN translate({_FIELD}, '-_', '++') END"),
    ("seq_read_id(header STRING)", "STRING", "regexp_replace(element_at(split(header, '\\\\s+'), 1), '/[12]$', '')"),
    ("seq_index_distance(a STRING, b STRING)", "INT", f"CASE WHEN {_SIZES.format('a')} = {_SIZES.format('b')} THEN seq_differing(a, b) ELSE {INCOMPARABLE} END"),
    ("seq_quality_sum(qual STRING)", "BIGINT", "aggregate(filter(split(qual, ''), c -> c <> ''), 0L, (s, c) -> s + greatest(0, ascii(c) - 33))"),
)


class Kmers:
    """Windows of a table's sequences."""

    def eval(self, batch: pa.RecordBatch, k: pa.Array, stride: pa.Array) -> Iterator[pa.Table]:
        size, step = k[0].as_py(), stride[0].as_py()
        letters, at = flat_letters(batch.column(1))
        ids = batch.column(0).cast(pa.int64())
        for begin, end, row, place in window_steps(at, size, step):
            if not len(row):
                continue
            window = np.lib.stride_tricks.sliding_window_view(letters[begin:end], size)[at[row] + place - begin]
            ends = pa.py_buffer((np.arange(len(row) + 1) * size).astype(np.int32))
            kmers = pa.Array.from_buffers(pa.string(), len(row), [None, ends, pa.py_buffer(np.ascontiguousarray(window))])
            yield pa.table({"id": ids.take(pa.array(row)), "place": pa.array(place, pa.int64()), "kmer": kmers})


def register(spark: SparkSession) -> None:
    for head, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    spark.udtf.register("seq_kmers", F.arrow_udtf(Kmers, returnType="id bigint, place bigint, kmer string"))
    spark.dataSource.register(FastqSource)
