"""Assignment of units to designs: exact full targets, then signature candidates and their consensus.

Candidates come from an equi-join: the designs' first and last k bases are expanded to every sequence within one
substitution (with N for any other letter of a read), so a unit's own k bases find all designs one
substitution away. Candidates are scored by the quality-aware consensus of the two reads over the design's length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.operators.qc import flat_letters

COVERAGE = 0.95


def signature_lengths(signature: int) -> list[int]:
    return sorted({signature, min(12, signature)}, reverse=True)


def neighbour_keys(designs: DataFrame, signature: int) -> DataFrame:
    """(k, side, key, ref_index): the designs' end sequences and their neighbours by one substitution; 4 k + 1 keys each."""
    out = None
    for k in signature_lengths(signature):
        for side in ("P", "S"):
            end = F.left("sequence", F.lit(k)) if side == "P" else F.right("sequence", F.lit(k))
            swap = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(k)), lambda p: F.transform(F.array(*map(F.lit, "ACGTN")), lambda b: F.concat(F.substring("end", F.lit(1), p - 1), b, F.substring("end", p + 1, F.lit(k))))))  # noqa: B023
            part = designs.where(F.length("sequence") >= k).select("ref_index", end.alias("end"))
            part = part.select(F.lit(k).alias("k"), F.lit(side).alias("side"), F.explode(F.array_distinct(swap)).alias("key"), "ref_index")
            out = part if out is None else out.union(part)
    return out


def candidates(units: DataFrame, designs: DataFrame, key: list[str], signature: int) -> DataFrame:
    """(key, ref_index): designs whose ends both reads' ends point to, else either's; at the longest k that gives any."""
    ks = signature_lengths(signature)

    def probe(k: int, side: str) -> Column:
        seq = F.col("prefix" if side == "P" else "suffix")
        end = F.left(seq, F.lit(k)) if side == "P" else F.right(seq, F.lit(k))
        return F.when(F.length(seq) >= k, F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), F.regexp_replace(end, "[^ACGT]", "N").alias("key")))

    probes = units.select(*key, F.inline(F.array_compact(F.array(*[probe(k, s) for k in ks for s in "PS"]))))
    hits = probes.join(neighbour_keys(designs, signature), ["k", "side", "key"])
    sets = hits.groupBy(*key).agg(*[F.collect_set(F.when((F.col("k") == k) & (F.col("side") == s), F.col("ref_index"))).alias(f"{s}{k}") for k in ks for s in "PS"])
    chosen = F.array().cast("array<int>")
    for k in reversed(ks):
        p, s = F.col(f"P{k}"), F.col(f"S{k}")
        both, either = F.array_intersect(p, s), F.array_union(p, s)
        chosen = F.when(F.size(both) > 0, both).when(F.size(either) > 0, either).otherwise(chosen)
    return sets.select(*key, F.explode(chosen).alias("ref_index"))


def _spread(column: pa.Array, length: int, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(letters, whether a letter is there) of strings laid over ``length`` places, from the left or up to the right end."""
    letters, at = flat_letters(column)
    size = np.diff(at)[:, None]
    place = np.arange(length) + (size - length if right else 0)
    there = (place >= 0) & (place < size)
    return np.append(letters, np.uint8(0))[np.where(there, place + at[:-1, None], len(letters))], there


def consensus(length: int, prefix: pa.Array, prefix_q: pa.Array, suffix: pa.Array, suffix_q: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bases, covered, disagreements) of reads over designs of one length, a row each: prefixes from the left, suffixes from the right; where they
    disagree the better quality wins, the prefix on ties. Bases without a quality have quality 0; uncovered places are N.
    """

    def side(bases: pa.Array, quality: pa.Array, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        letters, there = _spread(bases, length, right)
        values, known = flat_letters(quality), pc.fill_null(pc.utf8_length(bases), 0).to_numpy(zero_copy_only=False)[:, None]
        place = np.arange(length) + (known - length if right else 0)  # in the read, whose qualities count from its start
        have = there & (place < np.diff(values[1])[:, None])
        found = np.append(values[0], np.uint8(33))[np.where(have, place + values[1][:-1, None], len(values[0]))]
        return letters, there, np.maximum(found, 33).astype(np.int16) - 33

    (base, first, own), (other, second, theirs) = side(prefix, prefix_q, False), side(suffix, suffix_q, True)
    differ = first & second & (base != other)
    take = second & (~first | differ & (theirs > own))
    base = np.where(take, other, np.where(first, base, np.uint8(ord("N"))))
    return base, first | second, differ.sum(1)


CELLS = 1 << 21  # letters that one step scores


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs, scored together where their designs have one length."""
    names = ("sequence", "prefix", "prefix_q", "suffix", "suffix_q")
    for batch in batches:
        size = pc.utf8_length(batch.column(batch.schema.get_field_index("sequence"))).to_numpy(zero_copy_only=False)
        order = np.argsort(size, kind="stable")
        i = 0
        while i < len(order):
            length = int(size[order[i]])
            j = min(int(np.searchsorted(size[order], length, "right")), i + max(1, CELLS // max(1, length)))
            some = batch.take(pa.array(order[i:j]))
            design, *reads = (some.column(some.schema.get_field_index(c)) for c in names)
            base, covered, apart = consensus(length, *reads)
            wanted, _ = _spread(design, length, False)
            wrong = (covered & (base != wanted)).sum(1)
            ends = pa.py_buffer((np.arange(j - i + 1) * length).astype(np.int32))
            observed = pa.Array.from_buffers(pa.string(), j - i, [None, ends, pa.py_buffer(np.ascontiguousarray(base))])
            kept = [n for n in some.schema.names if n not in names]
            columns = [*[some.column(some.schema.get_field_index(n)) for n in kept], pa.array(wrong.astype(np.int32)), pa.array(apart.astype(np.int32)), observed, pa.array(covered.sum(1) / length >= COVERAGE)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "distance", "disagreements", "observed", "enough"])
            i = j


def match(units: DataFrame, designs: DataFrame, key: list[str], signature: int = 20, max_mismatches: int = 2, carry: Sequence[str] = ()) -> DataFrame:
    """key, ``carry`` columns, match_type, ref_index, observed, distance, disagreements for every unit of evidence.

    A tie in distance is ambiguous whatever the distance; only then is the mismatch limit looked at.
    """
    designs = designs.select(F.col("ref_index").cast("int"), "sequence")
    full = units.select(*key, *carry, F.posexplode("fulls").alias("pos", "sequence")).join(designs, "sequence")
    exact = full.groupBy(*key, *carry).agg(F.min(F.struct("pos", "ref_index", "sequence")).alias("hit"))
    rest = units.join(exact.select(*key), key, "left_anti")
    pairs = candidates(rest, designs, key, signature).join(designs, "ref_index").join(rest.select(*key, "prefix", "prefix_q", "suffix", "suffix_q"), key)
    schema = T.StructType([f for f in pairs.schema.fields if f.name not in ("sequence", "prefix", "prefix_q", "suffix", "suffix_q")] + T.StructType.fromDDL("distance int, disagreements int, observed string, enough boolean").fields)
    scored = pairs.mapInArrow(_scored, schema)
    best = scored.groupBy(*key).agg(
        F.min(F.when(F.col("enough"), F.struct("distance", "disagreements", "ref_index", "observed"))).alias("b"),
        F.collect_list(F.when(F.col("enough"), F.col("distance"))).alias("all"),
    )
    d = rest.select(*dict.fromkeys([*key, *carry, "left_anchor", "right_anchor"])).join(best, key, "left")
    tied = F.size(F.filter("all", lambda x: x == F.col("b.distance"))) > 1
    kind = (
        F.when(F.col("all").isNull(), F.when(F.col("left_anchor") | F.col("right_anchor"), "no_candidate").otherwise("anchor_missing"))
        .when(F.col("b").isNull(), "insufficient_evidence").when(tied, "ambiguous").when(F.col("b.distance") == 0, "exact")
        .when(F.col("b.distance") <= max_mismatches, "near").otherwise("too_many_mismatches")
    )
    d = d.withColumn("match_type", kind)
    found = F.col("match_type").isin("exact", "near")
    inexact = d.select(*key, *carry, "match_type", F.when(found, F.col("b.ref_index")).alias("ref_index"), F.col("b.observed").alias("observed"), F.col("b.distance").alias("distance"), F.coalesce("b.disagreements", F.lit(0)).alias("disagreements"))
    hit = exact.select(*key, *carry, F.lit("exact").alias("match_type"), "hit.ref_index", F.col("hit.sequence").alias("observed"), F.lit(0).alias("distance"), F.lit(0).alias("disagreements"))
    return hit.union(inexact)
