"""Abundance of designs per sample and the library statistics derived from it.

Counts are a long frame (sample, ref_index, exact, near); designs without reads are filled in with zeros before
any statistic. All statistics come from one pass of window columns and one grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.functions.scalars import log10_count, pct
from seqloom.operators.numbering import numbered
from seqloom.sinks.store import kept

ASSIGNED, EVERYTHING = "ALL_ASSIGNED", "ALL_WITH_UNDETERMINED"


def count_matches(matches: DataFrame) -> DataFrame:
    """(sample, ref_index, exact, near) from matches(sample, ref_index, match_type)."""
    hit = matches.where(F.col("match_type").isin("exact", "near") & F.col("ref_index").isNotNull())
    return hit.groupBy("sample", "ref_index").agg(F.count_if(F.col("match_type") == "exact").alias("exact"), F.count_if(F.col("match_type") == "near").alias("near"))


def zero_filled(counts: DataFrame, designs: DataFrame, samples: DataFrame) -> DataFrame:
    """Every design of ``designs`` for every sample, with exact, near and total; absent counts are 0.

    ``samples`` has the sample names of a run; the result has designs times samples rows by definition.
    """
    grid = designs.crossJoin(samples.select("sample").distinct())
    full = grid.join(counts, ["sample", "ref_index"], "left").fillna(0, ["exact", "near"])
    return full.withColumn("total", F.col("exact") + F.col("near"))


def frequencies(full: DataFrame) -> DataFrame:
    """Adds frequency_percent and reads_per_million (null for a sample without reads) and detected."""
    own = F.sum("total").over(W.partitionBy("sample"))
    return full.withColumns({"frequency_percent": pct(F.col("total"), own), "reads_per_million": F.try_divide(1e6 * F.col("total").cast("double"), own.cast("double")), "detected": F.col("total") > 0})


def dropouts(full: DataFrame) -> DataFrame:
    return full.where(F.col("total") == 0)


def top_designs(full: DataFrame, key: str = "ref_index", n: int = 100) -> DataFrame:
    place = F.row_number().over(W.partitionBy("sample").orderBy(F.desc("total"), key))
    return full.withColumn("place", place).where(F.col("place") <= n)


def rank_abundance(full: DataFrame) -> DataFrame:
    """Points of the rank-abundance curve: place by falling count, log10(count + 1)."""
    place = F.row_number().over(W.partitionBy("sample").orderBy(F.desc("total"), "ref_index"))
    return full.select("sample", place.alias("place"), log10_count(F.col("total")).alias("log_count"))


def _steps(cells: DataFrame, by: str) -> DataFrame:
    """Values of ``by`` per sample with their number ``m``, how many are below and above, and their average ``rank``."""
    up, down = W.partitionBy("sample").orderBy(by), W.partitionBy("sample").orderBy(F.desc(by))
    seen = lambda line: F.coalesce(F.sum("m").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    steps = cells.groupBy("sample", by).agg(F.sum("m").alias("m")).withColumns({"below": seen(up), "above": seen(down)})
    return steps.withColumn("rank", F.col("below") + (F.col("m") + 1) / F.lit(2.0))


def _spearman(cells: DataFrame, x: str, y: str, name: str, least: int = 3) -> DataFrame:
    """Correlation of the average ranks of two columns per sample; null under ``least`` rows or without variance."""
    side = lambda c, k: _steps(cells, c).select(F.col("sample").alias(f"_s{k}"), F.col(c).alias(f"_v{k}"), F.col("rank").alias(f"_r{k}"))
    joint = cells.groupBy("sample", x, y).agg(F.sum("m").alias("m"))
    for c, k in ((x, 0), (y, 1)):
        joint = joint.join(side(c, k), (F.col("sample") == F.col(f"_s{k}")) & F.col(c).eqNullSafe(F.col(f"_v{k}")))
    n, total = F.sum("m").cast("double"), lambda v: F.sum(F.col("m") * v)
    a, b = F.col("_r0"), F.col("_r1")
    var = lambda v: total(v * v) - total(v) * total(v) / n
    return joint.groupBy("sample").agg(F.when(F.sum("m") >= least, F.try_divide(total(a * b) - total(a) * total(b) / n, F.sqrt(var(a) * var(b)))).alias(name))


CELL = ["sample", "length", "gc", "total"]


def summed_cells(cells: DataFrame) -> DataFrame:
    """Cells(sample, length, gc, total, m, ids, exact, near) with equal keys added up."""
    return cells.groupBy(*CELL).agg(*[F.sum(c).alias(c) for c in ("m", "ids", "exact", "near")])


def library_metrics(full: DataFrame) -> DataFrame:
    """One row per sample of full(sample, ref_index, n_ids, length, gc, exact, near, total).

    Designs are added up to cells of equal length, gc and count once; everything is computed from those with their numbers, so
    no window or sort sees single designs.
    """
    return cell_metrics(full.groupBy(*CELL).agg(F.count("*").alias("m"), F.sum("n_ids").alias("ids"), F.sum("exact").alias("exact"), F.sum("near").alias("near")))


def cell_metrics(cells: DataFrame) -> DataFrame:
    """The statistics of ``library_metrics`` from its cells: m designs of one length, gc and total, with the sums of their ids, exact and near."""
    cells = kept(cells, "cells")
    own = W.partitionBy("sample")
    total, m = F.col("total"), F.col("m")
    steps = _steps(cells, "total").withColumns({"n": F.sum("m").over(own), "all": F.sum(m * total).over(own)})
    mean = F.try_divide(F.col("all").cast("double"), F.col("n").cast("double"))
    top = lambda share: F.sum(F.least(F.greatest(F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(share))) - F.col("above"), F.lit(0)), m) * total)
    p = total / F.col("all").cast("double")
    n, all_ = F.sum("m"), F.sum(m * total)
    quantile = lambda q: F.percentile("total", F.lit(q), m)
    some = lambda ok: F.coalesce(F.sum(F.when(ok, m)), F.lit(0))
    detected = [x.alias(f"detected_{k}x{end}") for k in (1, 10, 100, 500) for c in [some(total >= k)] for x, end in ((c, ""), (pct(c, n), "_percent"))]
    places = m * F.col("below") + m * (m + 1) / F.lit(2.0)  # the sum of the places that a step's designs take
    figures = steps.groupBy("sample").agg(
        n.alias("unique_design_sequences"), all_.alias("mapped_reads"), *detected,
        some(total == 0).alias("dropout_sequences"), F.max(mean).alias("mean_coverage"), quantile(0.5).alias("median_coverage"),
        F.min(F.when(total > 0, total)).alias("min_nonzero_coverage"), F.max("total").alias("max_coverage"),
        F.try_divide(F.sqrt(F.sum(m * (total - mean) * (total - mean)) / n), F.max(mean)).alias("coverage_cv"),
        quantile(0.05).alias("p05_coverage"), quantile(0.10).alias("p10_coverage"), quantile(0.90).alias("p90_coverage"), quantile(0.95).alias("p95_coverage"),
        F.try_divide(quantile(0.90), quantile(0.10)).alias("p90_over_p10"), F.try_divide(quantile(0.95), quantile(0.05)).alias("p95_over_p05"),
        (F.try_divide(2.0 * F.sum(places * total), n * all_.cast("double")) - F.when(all_ > 0, (n + 1.0) / n)).alias("gini"),
        pct(top(0.01), all_).alias("top_1_percent_read_share_percent"), pct(top(0.10), all_).alias("top_10_percent_read_share_percent"),
        F.when(all_ > 0, F.exp(-F.sum(F.when(total > 0, m * p * F.log(p)).otherwise(0.0)))).alias("effective_library_size"),
    )
    sums = cells.groupBy("sample").agg(F.sum("ids").alias("designed_ids"), F.sum("exact").alias("exact_mapped_reads"), F.sum("near").alias("near_mapped_reads"))
    logged = cells.withColumn("log", log10_count(total))
    out = sums.join(figures, "sample")
    for c in ("length", "gc"):
        out = out.join(_spearman(logged, c, "log", f"spearman_{c}_logcount"), "sample")
    return out


def sample_totals(matches: DataFrame) -> DataFrame:
    """Additive counters per sample of matches(sample, match_type, left_anchor, right_anchor, disagreements, header_mismatch)."""
    flag = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    kind = lambda k: F.count_if(F.col("match_type") == k)
    both = F.count_if(F.coalesce(F.col("left_anchor") & F.col("right_anchor"), F.lit(False)))
    return matches.groupBy("sample").agg(
        F.count("*").alias("total_units"), kind("phix").alias("phix_reads"), (kind("exact") + kind("near")).alias("mapped_reads"),
        flag("left_anchor").alias("anchor_left"), flag("right_anchor").alias("anchor_right"), both.alias("anchors_both"),
        flag("header_mismatch").alias("pair_header_mismatches"), F.coalesce(F.sum("disagreements"), F.lit(0)).alias("pair_base_disagreements"),
        kind("ambiguous").alias("ambiguous_reads"), kind("anchor_missing").alias("anchor_missing_reads"),
    )


def control_metrics(totals: DataFrame) -> DataFrame:
    """Spike-in and anchor figures from sample_totals."""
    rest = F.greatest(F.lit(0), F.col("total_units") - F.col("phix_reads"))
    lost = F.greatest(F.lit(0), rest - F.col("mapped_reads"))
    return totals.withColumns({
        "mapped_fraction_percent": pct(F.col("mapped_reads"), F.col("total_units")), "phix_fraction_percent": pct(F.col("phix_reads"), F.col("total_units")),
        "non_phix_units": rest, "mapped_fraction_non_phix_percent": pct(F.col("mapped_reads"), rest), "unresolved_non_phix_reads": lost,
        "unresolved_non_phix_percent": pct(lost, rest), "library_to_phix_read_ratio": F.try_divide(rest.cast("double"), F.col("phix_reads").cast("double")),
        "left_anchor_percent": pct(F.col("anchor_left"), rest), "right_anchor_percent": pct(F.col("anchor_right"), rest), "both_anchors_percent": pct(F.col("anchors_both"), rest),
    })


def with_rollups(rows: DataFrame, undetermined: Column) -> DataFrame:
    """Each row under its sample and under the roll-ups it belongs to; aggregates over ``sample`` then cover all."""
    labels = F.array_compact(F.array(F.col("sample"), F.when(~undetermined, F.lit(ASSIGNED)), F.lit(EVERYTHING)))
    return rows.withColumn("sample", F.explode(labels))


def rolled_up(counts: DataFrame, keys: list[str], undetermined: Column) -> DataFrame:
    """Additive counts(sample, keys, ..) of each sample, and summed for the roll-ups: few rows are repeated, not the units."""
    sums = [c for c in counts.columns if c not in ("sample", *keys)]
    return with_rollups(counts, undetermined).groupBy("sample", *keys).agg(*[F.sum(c).alias(c) for c in sums])


def category_counts(rows: DataFrame, by: list[str], category: str) -> DataFrame:
    return rows.groupBy(*by, F.col(category).alias("category")).agg(F.count("*").alias("count"))


def classification(n: DataFrame, by: list[str]) -> DataFrame:
    """Category counts with the percent of each category that occurs."""
    return n.withColumn("percent", pct(F.col("count"), F.sum("count").over(W.partitionBy(*by) if by else W.partitionBy(F.lit(0)))))


def count_matrix(full: DataFrame, keys: list[str], samples: list[str]) -> DataFrame:
    """Designs by samples; counts."""
    return full.groupBy(*keys).pivot("sample", samples).agg(F.sum("total")).fillna(0, samples)


def rpm_matrix(full: DataFrame, keys: list[str], samples: list[str]) -> DataFrame:
    """Designs by samples; reads per million, null for samples without reads."""
    return frequencies(full).groupBy(*keys).pivot("sample", samples).agg(F.sum("reads_per_million"))


def unique_designs(rows: DataFrame, ordinal: str = "ord") -> DataFrame:
    """Unique sequences of rows(ord, id, sequence) with their ids in input order."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col("id").alias("id")))), lambda s: s["id"])
    return rows.groupBy("sequence").agg(ids.alias("ids")).withColumn("n_ids", F.size("ids").cast("long"))


def group_designs(rows: DataFrame, ordinal: str = "ord") -> DataFrame:
    """The same with ref_index, their place by (first id, sequence)."""
    return numbered(unique_designs(rows, ordinal).withColumn("first_id", F.col("ids")[0]), ["first_id", "sequence"], "ref_index").drop("first_id")


def duplicates(groups: DataFrame) -> DataFrame:
    return groups.where(F.col("n_ids") > 1).select("sequence", F.array_join("ids", "|").alias("ids"), F.col("n_ids").alias("id_count"))


def observed_sequences(matches: DataFrame) -> DataFrame:
    """Counts of observed targets without N by sample, design and match type."""
    seen = matches.where((F.col("observed") != "") & ~F.col("observed").contains("N"))
    return seen.groupBy("sample", "design_key", "observed", "match_type").agg(F.count("*").alias("count"))
