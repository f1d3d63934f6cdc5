"""Anchor search and the evidence that a pair of reads gives about its target.

The search looks at up to 71 starts of every read: an Arrow task does it on byte matrices, one
start at a time for all reads of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from seqloom.functions.scalars import COMPLEMENT

SEARCH_END = 70
_RC = str.maketrans(*COMPLEMENT)
ANCHOR = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("distance", T.IntegerType())])
EVIDENCE = "prefix string, prefix_q string, suffix string, suffix_q string, fulls array<string>, left_anchor boolean, right_anchor boolean, orientation string"


def reverse_complement(seq: str) -> str:
    return seq.translate(_RC)[::-1]


def leftmost_best(seqs: list[str], anchor: str, max_mismatches: int, end: int | None = SEARCH_END) -> tuple[np.ndarray, np.ndarray]:
    """(start, mismatches) of the best place of ``anchor`` in each sequence, leftmost among equals; start -1 for none."""
    n, k = len(seqs), len(anchor)
    start, best = np.full(n, -1), np.full(n, max_mismatches + 1)
    if not n or not k:
        return start, best
    want = np.frombuffer(anchor.encode(), np.uint8)
    sizes = np.array([len(s) for s in seqs])
    last = sizes - k if end is None else np.minimum(sizes - k, end)
    most = int(last.max())
    if most < 0:
        return start, best
    width = most + k
    cells = np.frombuffer(b"".join(s[:width].encode("ascii", "replace").ljust(width, b"\0") for s in seqs), np.uint8).reshape(n, width)
    for at in range(most + 1):
        live = np.flatnonzero((last >= at) & (best > 0))
        if not len(live):
            break
        apart = (cells[live, at : at + k] != want).sum(1)
        better = apart < best[live]
        start[live[better]], best[live[better]] = at, apart[better]
    return start, best


def find_anchor(rows: DataFrame, column: str, anchor: str, max_mismatches: int = 1, end: int = SEARCH_END) -> DataFrame:
    """``rows`` with ``anchor``: struct of position and distance, null where it isn't found. Null sequences find nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = [s or "" for s in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            start, best = leftmost_best(seqs, anchor, max_mismatches, end)
            found = [None if s < 0 else {"position": int(s), "distance": int(b)} for s, b in zip(start, best, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.struct([("position", pa.int32()), ("distance", pa.int32())]))], [*batch.schema.names, "anchor"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("anchor", ANCHOR)]))


def _bodies(seqs: list[str], primer: str, opposite: str, mismatches: int) -> list[tuple[str, int, int] | None]:
    """For each sequence (body after the primer, body's start, the opposite primer's place in it or -1), or None."""
    start, _ = leftmost_best(seqs, primer, mismatches)
    bodies = [s[a + len(primer) :] if a >= 0 else "" for s, a in zip(seqs, start, strict=True)]
    other, _ = leftmost_best(bodies, opposite, mismatches, None)
    return [(b, int(a) + len(primer), int(o)) if a >= 0 else None for a, b, o in zip(start, bodies, other, strict=True)]


def _sides(one: list[tuple[str, str]], two: list[tuple[str, str] | None], left: str, right: str, mismatches: int) -> list[dict]:
    """Evidence with ``one`` read forward and ``two`` backward."""
    out = []
    ahead = _bodies([s for s, _ in one], left, reverse_complement(right), mismatches)
    behind = _bodies([x[0] if x else "" for x in two], right, reverse_complement(left), mismatches)
    for (_, q1), x2, a, b in zip(one, two, ahead, behind, strict=True):
        e = {"prefix": None, "prefix_q": None, "suffix": None, "suffix_q": None, "fulls": [], "left_anchor": a is not None, "right_anchor": b is not None and x2 is not None}
        if a is not None:
            e["prefix"], e["prefix_q"] = a[0], q1[a[1] :]
            if a[2] > 0:
                e["fulls"].append(a[0][: a[2]])
        if e["right_anchor"]:
            e["suffix"], e["suffix_q"] = reverse_complement(b[0]), x2[1][b[1] :][::-1]
            if b[2] > 0:
                e["fulls"].append(reverse_complement(b[0][: b[2]]))
        out.append(e)
    return out


def build_evidence(pairs: DataFrame, left_primer: str, right_primer: str, mismatches: int = 1) -> DataFrame:
    """``pairs`` (s1, q1, s2, q2; s2 and q2 null for single reads) with the evidence columns.

    Read 1 is taken as forward unless the other way round finds strictly more anchors; single reads are
    only taken as forward.
    """
    kinds = [pa.string()] * 4 + [pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s1, q1, s2, q2 = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("s1", "q1", "s2", "q2"))
            one = [(s or "", q or "") for s, q in zip(s1, q1, strict=True)]
            two = [None if s is None or q is None else (s, q) for s, q in zip(s2, q2, strict=True)]
            forward = _sides(one, two, left_primer, right_primer, mismatches)
            turned = [i for i, x in enumerate(two) if x is not None]
            backward = dict(zip(turned, _sides([two[i] for i in turned], [one[i] for i in turned], left_primer, right_primer, mismatches), strict=True))
            rows = []
            for i, a in enumerate(forward):
                b = backward.get(i)
                swap = b is not None and b["left_anchor"] + b["right_anchor"] > a["left_anchor"] + a["right_anchor"]
                # full targets are tried in the order read 1, read 2 of the hypothesis' own forward read first
                rows.append((b if swap else a) | {"orientation": "R2_forward" if swap else "R1_forward"})
            names = ["prefix", "prefix_q", "suffix", "suffix_q", "fulls", "left_anchor", "right_anchor", "orientation"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]], [*batch.schema.names, *names])

    return pairs.mapInArrow(run, T.StructType([*pairs.schema.fields, *T.StructType.fromDDL(EVIDENCE).fields]))
