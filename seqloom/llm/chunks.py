"""Substring deduplication by content-defined chunks.

A gear hash rolls over a text's bytes; a chunk ends where its four leading bits are zero, so that chunks
resist shifts from insertions. Chunks are matched by a 128-bit digest; every chunk but the first of
its digest in the corpus is a repeat. Adjacent repeats join to runs, and runs of at least ``least_run``
bytes are removed: shorter ones are chance matches of common phrases.

Equal chunks in one slice of a task are reduced to the first before the shuffle, so a chunk that a third of all
texts hold arrives once a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.llm.common import byte_table, free_name, mix64, powers, stage, text_slices

SHORTEST, LONGEST, BITS, ROLLED = 16, 256, 4, 16
LEAST_RUN = 120
_GEAR = (byte_table(21) >> np.uint64(32)).astype(np.uint32)
_DIGESTS = ((0x9E3779B97F4A7C15 | 1, byte_table(22)), (0xC2B2AE3D27D4EB4F | 1, byte_table(23)))
ROWS = "repeat boolean, doc long, tag long, start int, size int, d1 long, d2 long"


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: the sum of the last 16 bytes' gear values, each shifted by its distance."""
    h = _GEAR[data]
    width = 1
    while width < ROLLED:
        older = h[:-width] << np.uint32(width) if len(h) > width else h[:0]
        h = h.copy()
        h[width:] += older
        width *= 2
    return h


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of all chunks of a slice; ends fall on whole characters."""
    good = (gear(data) >> np.uint32(32 - BITS)) == 0
    good[:-1] &= (data[1:] & 0xC0) != 0x80
    spots = np.flatnonzero(good) + 1
    lo = np.searchsorted(spots, offsets[:-1] + ROLLED)
    hi = np.searchsorted(spots, offsets[1:])
    text, starts, ends = [], [], []
    for i in range(len(offsets) - 1):
        at, end = int(offsets[i]), int(offsets[i + 1])
        for spot in [*spots[lo[i] : hi[i]].tolist(), end]:
            while spot - at > LONGEST:
                part = at + LONGEST
                while (int(data[part]) & 0xC0) == 0x80:
                    part -= 1
                text.append(i)
                starts.append(at)
                ends.append(part)
                at = part
            if spot - at >= SHORTEST or (spot == end and spot > at):
                text.append(i)
                starts.append(at)
                ends.append(spot)
                at = spot
    return np.array(text, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)


def _rows(repeat: bool, doc, tag, start, size, d1, d2) -> pa.RecordBatch:
    cols = [np.full(len(doc), repeat), doc.astype(np.int64), tag.astype(np.int64), start.astype(np.int32), size.astype(np.int32), d1.view(np.int64), d2.view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["repeat", "doc", "tag", "start", "size", "d1", "d2"])


def _order(d1, d2, doc, tag, start) -> tuple[np.ndarray, np.ndarray]:
    """(first chunks of their digest by place in the corpus, later ones); a row that repeats the first's place is neither."""
    order = np.lexsort((start, tag, doc, d2, d1))
    new = np.ones(len(order), bool)
    new[1:] = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return order[new], order[(doc[order] != doc[head]) | (tag[order] != tag[head]) | (start[order] != start[head])]


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tags = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "tag"))
        for i, _, data, offsets in text_slices(batch, "text"):
            if not len(data):
                continue
            text, a, b = cut(data, offsets)
            digests = []
            for base, table in _DIGESTS:
                total = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(table[data] * powers(base, len(data)), out=total[1:])
                digests.append(mix64((total[b] - total[a]) * powers(pow(base, -1, 2**64), len(data))[a] + (b - a).astype(np.uint64)))
            doc, tag, start = ids[i + text], tags[i + text], a - offsets[text]
            once, again = _order(*digests, doc, tag, start)
            yield _rows(True, doc[again], tag[again], start[again], (b - a)[again], mix64(doc[again].view(np.uint64)), digests[1][again])
            yield _rows(False, doc[once], tag[once], start[once], (b - a)[once], digests[0][once], digests[1][once])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among chunks that come in order of digest and place: those of a digest after its first, wherever batches end."""
    head: tuple | None = None  # digest and place of the last digest's first chunk
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        known = cols[0].astype(bool)
        if known.any():
            yield batch.filter(pa.array(known))
        doc, tag, start, size, d1, d2 = (c[~known] for c in cols[1:])
        if not len(doc):
            continue
        new = np.ones(len(doc), bool)
        new[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        new[0] = head is None or (d1[0], d2[0]) != head[:2]
        first = np.maximum.accumulate(np.where(new, np.arange(len(doc)), -1))
        own = [np.where(first < 0, 0 if head is None else h, c[first]) for c, h in zip((doc, tag, start), head[2:] if head else (0, 0, 0), strict=True)]
        again = (doc != own[0]) | (tag != own[1]) | (start != own[2])  # a row that repeats the first's place isn't a repeat
        head = (d1[-1], d2[-1], *(c[-1] for c in own))
        yield _rows(True, doc[again], tag[again], start[again], size[again], d1[again], d2[again])


def _tag(text) -> Column:
    """Orders different texts of one id, and tells them apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_runs(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """(doc, tag, spans): the byte runs of each text that repeat earlier text, ascending. A document is an id with a text's tag.

    Null texts and rows without an id have none; a text of any length is cut whole. Chunks of a digest meet sorted and are streamed, so a frequent
    one costs a task time, one row for each slice of text that holds it, but no memory.
    """
    given = docs.select(F.col("doc_id").cast("long"), "text", _tag(F.col("text")).alias("tag")).where("doc_id is not null")
    rows = given.mapInArrow(_chunk, ROWS).repartition("d1").sortWithinPartitions("d1", "d2", "doc", "tag", "start").mapInArrow(_meet, ROWS)
    marks = rows.select("doc", "tag", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    line = W.partitionBy("doc", "tag").orderBy("start")
    runs = marks.withColumn("new", (F.coalesce(F.lag("end").over(line), F.lit(-1)) != F.col("start")).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(line)).groupBy("doc", "tag", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.where(F.col("end") - F.col("start") >= least_run)
    return runs.groupBy("doc", "tag").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def chunk_report(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the removed byte ``spans`` of every row.

    Null texts are empty. The first occurrence stays, by doc_id, then by the text's hash where texts share an id, then by place. Rows whose doc_id is null lose
    nothing; rows that repeat a doc_id with its text are one document and share its result. Further columns are
    ignored; empty input gives an empty result.
    """
    runs = stage(repeated_runs(docs, least_run), "chunk-runs")
    sizes = docs.select(F.col("doc_id").cast("long"), _tag(F.col("text")).alias("_tag"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    out = sizes.join(runs, (sizes["doc_id"] == runs["doc"]) & (sizes["_tag"] == runs["tag"]), "left").withColumn("spans", F.coalesce("spans", none))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "spans")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, spans = batch.schema.get_field_index("text"), batch.column(batch.num_columns - 1).to_pylist()
        texts = []
        for text, own in zip(batch.column(at).to_pylist(), spans, strict=True):
            if own:
                raw = text.encode()
                edge = [0, *(x for s in own for x in (s["start"], s["end"])), len(raw)]
                text = b"".join(raw[edge[k] : edge[k + 1]] for k in range(0, len(edge), 2)).decode()
            texts.append(text)
        cols = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns[:-1])]
        yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:-1])


def drop_repeats(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """``docs`` with repeated runs cut out of its texts, as ``chunk_report`` finds them; all columns and rows stay, whatever their names.

    Null and empty texts and rows without an id are unchanged; an empty table gives an empty result.
    """
    key, tag, own = (free_name(docs, c) for c in ("_doc", "_tag", "_spans"))
    runs = repeated_runs(docs, least_run).select(F.col("doc").alias(key), F.col("tag").alias(tag), F.col("spans").alias(own))
    joined = docs.join(runs, (docs["doc_id"] == F.col(key)) & (_tag(docs["text"]) == F.col(tag)), "left")
    return joined.drop(key, tag).mapInArrow(_without, docs.schema)
