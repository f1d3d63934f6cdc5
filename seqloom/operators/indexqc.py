"""Sample-index diagnostics: nearest expected barcodes, substitutions and orientation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.scalars import INCOMPARABLE, pct, reverse_complement

SOURCES = ("I1_I2_FASTQ", "FASTQ_header", "Top_Unknown_Barcodes")


def header_counts(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """Barcode counts of read headers: once a pair, and once more if the mate's differs."""
    both = F.array_distinct(F.array_compact(F.array(first, second)))
    return pairs.select(F.explode(both).alias("barcode")).groupBy("barcode").agg(F.count("*").alias("count"))


def top_barcodes(sources: dict[str, DataFrame], n: int = 5000) -> DataFrame:
    """The n most frequent (barcode, count, source) of all sources; ties by barcode, then source order."""
    every = None
    for i, (name, counts) in enumerate(sources.items()):
        part = counts.select("barcode", "count", F.lit(name).alias("source"), F.lit(i).alias("_o"))
        every = part if every is None else every.unionByName(part)
    return every.orderBy(F.desc("count"), "barcode", "_o").limit(n).drop("_o")


def candidates(expected: DataFrame) -> DataFrame:
    """(sample, barcode, orientation, single) of expected(sample, i7, i5): what an observed barcode is compared with."""
    i5, turned = F.coalesce("i5", F.lit("")), reverse_complement(F.coalesce("i5", F.lit("")))
    joined = lambda b: F.when(b != "", F.concat_ws("+", "i7", b)).otherwise(F.col("i7"))
    option = lambda barcode, name, single: F.struct(barcode.alias("barcode"), F.lit(name).alias("orientation"), F.lit(single).alias("single"))
    ways = F.array_compact(F.array(option(F.col("i7"), "I1_only", True), option(joined(i5), "as_given", False), F.when(turned != i5, option(joined(turned), "i5_reverse_complement", False))))
    return expected.select("sample", F.inline(ways))


DEAL = 50_000  # barcodes of one form that a task compares
_ROWS = 4096  # barcodes that are compared at once
FOUND = "observed_barcode string, count long, single boolean, nearest_sample string, nearest_expected string, distance int, orientation string, tied_best_candidates long"


def closest(observed: np.ndarray, expected: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(least distance, first row of ``expected`` at it, rows at it) of each row of letters, and the number of pairs compared.

    Within r substitutions one of r + 1 parts is equal, so only rows with an equal part are compared; r grows until something lies within it.
    Where more rows share a part than there are, each is compared once. What shares not even a letter with any is as far from all.
    """
    n, length = observed.shape
    least, first, tied = np.full(n, length), np.zeros(n, np.int64), np.full(n, len(expected), np.int64)
    left, compared, r = np.arange(n), 0, 2
    while len(left) and length:
        r = min(r, length - 1)
        at = [length * i // (r + 1) for i in range(r + 2)]
        weight = powers_of(length)
        ranges = []
        for x, y in zip(at, at[1:]):  # noqa: B905
            own, theirs = (m[:, x:y].astype(np.uint64) @ weight[: y - x] for m in (observed[left], expected))
            order = np.argsort(theirs, kind="stable")
            ranges.append((order, *(np.searchsorted(theirs[order], own, side) for side in ("left", "right"))))
        many = sum(high - low for _, low, high in ranges)
        every = many > len(expected)
        best = np.full(len(left), length + 1)
        for rows in np.array_split(np.arange(len(left)), max(1, -(-len(left) // _ROWS))):
            some, whole = rows[~every[rows]], rows[every[rows]]
            pairs = [np.zeros(0, np.int64)]
            for order, low, high in ranges:
                k = (high - low)[some]
                pairs.append(np.repeat(some, k) * len(expected) + order[np.repeat(low[some] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))])
            a, b = np.divmod(np.unique(np.concatenate(pairs)), len(expected))
            a, b = np.concatenate([a, np.repeat(whole, len(expected))]), np.concatenate([b, np.tile(np.arange(len(expected)), len(whole))])
            compared += len(a)
            d = np.concatenate([np.zeros(0, np.int64), *((observed[left[a[i : i + 65536]]] != expected[b[i : i + 65536]]).sum(1) for i in range(0, len(a), 65536))])
            np.minimum.at(best, a, d)
            hit = d == best[a]
            row = left[a[hit]]
            fresh = np.unique(row)
            tied[fresh], first[fresh] = 0, len(expected)
            np.add.at(tied, row, 1)
            np.minimum.at(first, row, b[hit])
        within = (best <= r) | every & (best <= length)
        least[left[within]] = best[within]
        left = left[~within]
        if r == length - 1:
            break
        r = 2 * r + 1
    tied[left], first[left] = len(expected), 0
    return least, first, tied, compared


def powers_of(n: int) -> np.ndarray:
    """Odd weights that tell parts of some letters apart."""
    return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))


def _letters(column: pa.ChunkedArray) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer("".join(values).encode("ascii", "replace"), np.uint8).reshape(len(values), -1)


def _compared(observed: pa.Table, expected: pa.Table) -> pa.Table:
    """Barcodes of one form with the nearest expected ones; without any of the form they stay open."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    have = [observed.column(c) for c in ("observed_barcode", "count", "single")]
    if not observed.num_rows or not expected.num_rows:
        none = lambda kind: pa.nulls(observed.num_rows, kind)
        return pa.table([*have, none(pa.string()), none(pa.string()), none(pa.int32()), none(pa.string()), none(pa.int64())], names)
    expected = expected.sort_by([(c, "ascending") for c in ("sample", "orientation", "expected")])
    least, first, tied, _ = closest(_letters(observed.column("observed_barcode")), _letters(expected.column("expected")))
    near = expected.take(pa.array(first))
    return pa.table([*have, near.column("sample"), near.column("expected"), pa.array(least.astype(np.int32)), near.column("orientation"), pa.array(tied)], names)


def nearest(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """The nearest expected barcode of each observed(barcode, count), with the number tied at its distance.

    Barcodes of one form (the lengths of their parts) are compared, by equal parts and a growing radius (``closest``); a form's barcodes are dealt to
    tasks of at most some ``DEAL``, each with the form's expected ones. A barcode without any of its form is INCOMPARABLE to all of its kind (single or
    dual). Equal barcodes are counted beforehand. Ties go to the first sample, orientation and barcode.
    """
    form = lambda c: F.array_join(F.transform(F.split(c, "[+]"), F.length), "+")
    deals = max(1, -(-observed.count() // DEAL))
    name = F.col("barcode")
    o = observed.select(name.alias("observed_barcode"), "count", (~name.contains("+")).alias("single"), form(name).alias("form"), F.pmod(F.xxhash64(name), F.lit(deals)).alias("deal"))
    e = candidates(expected).withColumnRenamed("barcode", "expected")
    dealt = e.select("single", "sample", "orientation", "expected", form(F.col("expected")).alias("form"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))).alias("deal"))
    found = o.groupBy("form", "single", "deal").cogroup(dealt.groupBy("form", "single", "deal")).applyInArrow(_compared, FOUND)
    kind = e.groupBy("single").agg(F.min(F.struct("sample", "orientation", "expected")).alias("b"), F.count("*").alias("n"))
    either = lambda c, other: F.when(F.col("distance").isNull(), other).otherwise(F.col(c)).alias(c)
    return found.join(F.broadcast(kind), "single").select(
        "observed_barcode", "count", either("nearest_sample", F.col("b.sample")), either("nearest_expected", F.col("b.expected")), either("distance", F.lit(INCOMPARABLE)),
        either("orientation", F.col("b.orientation")), either("tied_best_candidates", F.col("n")),
    )


def substitutions(near: DataFrame, max_distance: int = 2) -> DataFrame:
    """Weighted (index_read, position, expected_base, observed_base) of barcodes within ``max_distance``; matches included."""
    parts = F.arrays_zip(F.split("observed_barcode", "[+]").alias("o"), F.split("nearest_expected", "[+]").alias("e"))
    rows = near.where(F.col("distance") <= max_distance).select("count", F.posexplode(parts).alias("part", "x"))
    chars = lambda c: F.filter(F.split(c, ""), lambda b: b != "")
    rows = rows.select("count", "part", F.posexplode(F.arrays_zip(chars(F.col("x.o")).alias("o"), chars(F.col("x.e")).alias("e"))).alias("pos", "b"))
    key = [F.concat(F.lit("I"), (F.col("part") + 1).cast("string")).alias("index_read"), (F.col("pos") + 1).alias("position"), F.col("b.e").alias("expected_base"), F.col("b.o").alias("observed_base")]
    return rows.groupBy(*key).agg(F.sum("count").alias("weighted_reads"))


def expected_g(subs: DataFrame) -> DataFrame:
    """What expected G bases were read as."""
    g = subs.where(F.col("expected_base") == "G")
    part = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("weighted_reads"))), F.lit(0))
    total, right, n = F.coalesce(F.sum("weighted_reads"), F.lit(0)), part(F.col("observed_base") == "G"), part(F.col("observed_base") == "N")
    other = total - right - n
    return g.agg(total.alias("expected_g"), right.alias("g_to_g"), n.alias("g_to_n"), other.alias("g_to_other"), pct(n, total).alias("g_to_n_percent"), pct(other, total).alias("g_to_other_percent"))


def orientation_votes(near: DataFrame) -> DataFrame:
    """Reads per orientation of the nearest barcode; ``preferred`` marks the most, ties by name."""
    votes = near.groupBy("orientation").agg(F.sum("count").alias("votes"))  # three rows at most
    first = votes.agg(F.min(F.struct(-F.col("votes"), F.col("orientation").alias("o"))).alias("f")).select(F.col("f.o").alias("_first"))
    return votes.join(first, F.col("orientation") == F.col("_first"), "left").select("orientation", "votes", F.col("_first").isNotNull().alias("preferred"))


def source_figures(sources: dict[str, DataFrame]) -> DataFrame:
    """One row: reads counted and different barcodes of each source of SOURCES."""
    every = None
    for name, counts in sources.items():
        part = counts.select(F.lit(name).alias("source"), "barcode", "count")
        every = part if every is None else every.unionByName(part)
    reads = lambda n: F.coalesce(F.sum(F.when(F.col("source") == n, F.col("count"))), F.lit(0)).cast("long")
    kinds = lambda n: F.count_if(F.col("source") == n)
    raw, head, unknown = SOURCES
    return every.groupBy("source", "barcode").agg(F.sum("count").alias("count")).agg(
        reads(raw).alias("raw_I1_I2_index_reads_counted"), kinds(raw).alias("raw_I1_I2_unique_retained"),
        reads(head).alias("header_index_reads_counted"), kinds(head).alias("header_index_unique_retained"), reads(unknown).alias("top_unknown_reads_counted"),
    )


def unit_figures(totals: DataFrame) -> DataFrame:
    """One row from totals(undetermined, units, phix): how the units split into assigned and undetermined, spike-in and others."""
    part = lambda c, und: F.coalesce(F.sum(F.when(F.col("undetermined") == und, F.col(c))), F.lit(0)).cast("long")
    rest = lambda und: F.greatest(F.lit(0).cast("long"), part("units", und) - part("phix", und))
    a, u = part("units", False), part("units", True)
    return totals.agg(
        a.alias("assigned_read_pairs_or_reads"), u.alias("undetermined_read_pairs_or_reads"), pct(a, a + u).alias("assigned_read_fraction_percent"), pct(u, a + u).alias("undetermined_read_fraction_percent"),
        part("phix", False).alias("assigned_phix_reads"), part("phix", True).alias("undetermined_phix_reads"), rest(False).alias("assigned_non_phix_reads"), rest(True).alias("undetermined_non_phix_reads"),
        pct(rest(True), rest(False) + rest(True)).alias("undetermined_non_phix_fraction_percent"),
    )


def summary(near: DataFrame, max_distance: int = 2) -> DataFrame:
    """One row: reads analysed, exactly expected and within the distance, the expected-G profile and the preferred orientation. One pass over ``near``."""
    d, weight = F.col("distance"), F.col("count")
    reads = lambda ok: F.coalesce(F.sum(F.when(ok, weight)), F.lit(0))
    figures = {"observed_index_reads_analyzed": reads(d >= 0), "exact_expected_index_reads": reads(d == 0), f"within_{max_distance}_bp_expected_reads": reads(d <= max_distance), "incomparable_index_reads": reads(d >= INCOMPARABLE)}
    letters = F.zip_with(F.split("nearest_expected", ""), F.split("observed_barcode", ""), lambda e, o: F.when(e == "G", o))  # what expected G bases were read as
    at_g = lambda ok: F.coalesce(F.sum(F.when(d <= max_distance, weight * F.size(F.filter("_letters", ok)))), F.lit(0)).cast("long")
    figures |= {"expected_G_position_weighted_reads_within_threshold": at_g(lambda x: x.isNotNull()), "expected_G_to_G": at_g(lambda x: x == "G"), "expected_G_to_N": at_g(lambda x: x == "N")}
    voted = near.withColumn("_letters", letters).groupBy("orientation").agg(*[f.alias(n) for n, f in figures.items()])
    votes = F.struct(-F.col("observed_index_reads_analyzed"), F.col("orientation"))
    head = voted.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in figures], F.min_by("orientation", votes).alias("preferred_i5_orientation"))
    all_, right, n = (F.col(c) for c in ("expected_G_position_weighted_reads_within_threshold", "expected_G_to_G", "expected_G_to_N"))
    return head.withColumns({"expected_G_to_other": all_ - right - n, "expected_G_to_N_percent": pct(n, all_), "expected_G_to_other_percent": pct(all_ - right - n, all_)})


def one_row(*frames: DataFrame) -> DataFrame:
    """Frames of one row each, side by side."""
    out = frames[0].withColumn("_k", F.lit(0))
    for f in frames[1:]:
        out = out.join(f.withColumn("_k", F.lit(0)), "_k")
    return out.drop("_k")
