"""Registered queries of the sequencing engine over the star tables, and their SQL counterparts.

The tables hold no reads, so each query maps columns to sequences the same way in both engines: the letters of a
text become bases (``text_dna``) or qualities. All queries read whole tables and whole texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.functions.session import register
from seqloom.operators import anchors, controls, indexqc, library, matcher, numbering, qc
from seqloom.sinks.store import shared_dir
from seqloom.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])


_UP = "upper(regexp_replace({0}, '[^A-Za-z]', '', 'g'))"


def _dna(x: str, bases: str = S.LETTER_BASES) -> str:
    return f"translate({_UP.format(x)}, '{S.LETTERS}', '{bases}')"


def _rc(x: str) -> str:
    return f"reverse(translate({x}, '{S.COMPLEMENT[0]}', '{S.COMPLEMENT[1]}'))"


def _n(x: str, chars: str) -> str:
    return f"length(regexp_replace({x}, '[^{chars}]', '', 'g'))"


# --- designs and matches: parts are designs, line items are reads, samples are line status and shipping month

_SAMPLE = "concat(l_linestatus, '_', month(l_shipdate))"
_SQL_COUNTS = f"""
refs as (select p_partkey ref_index, {_dna("p_name")} sequence, 1::bigint n_ids from part),
designs as (select ref_index, sequence, n_ids, length(sequence) length, 100.0::double * {_n("sequence", "GC")} / length(sequence) gc from refs),
hits as (select {_SAMPLE} sample, l_partkey ref_index, count(*) filter (l_returnflag = 'A') e, count(*) filter (l_returnflag = 'R') n from lineitem group by 1, 2),
samples as (select distinct sample from hits),
f as (select s.sample, d.*, coalesce(e, 0)::bigint exact, coalesce(n, 0)::bigint near, (coalesce(e, 0) + coalesce(n, 0))::bigint total
  from designs d cross join samples s left join hits h on h.sample = s.sample and h.ref_index = d.ref_index)"""


def _designs(spark: SparkSession, d: str) -> DataFrame:
    seq = S.text_dna(F.col("p_name"))
    parts = _t(spark, d, "part").select(F.col("p_partkey").alias("ref_index"), seq.alias("sequence"), F.lit(1).cast("long").alias("n_ids"))
    return parts.withColumns({"length": F.length("sequence"), "gc": S.gc_percent(F.col("sequence"))})


def _matches(spark: SparkSession, d: str, which: Column | None = None) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "exact").when(F.col("l_returnflag") == "R", "near").otherwise("ambiguous")
    lines = _t(spark, d, "lineitem")
    lines = lines if which is None else lines.where(which)
    return lines.select(F.expr(_SAMPLE).alias("sample"), F.col("l_partkey").alias("ref_index"), kind.alias("match_type"))


def _full(spark: SparkSession, d: str) -> DataFrame:
    m = _matches(spark, d)
    return library.zero_filled(library.count_matches(m), _designs(spark, d), m)


@query(f"""with {_SQL_COUNTS} select sample, ref_index, sequence, exact, near, total,
round(100.0::double * total / nullif(sum(total) over (partition by sample), 0), 6) frequency_percent,
round(1e6::double * total / nullif(sum(total) over (partition by sample), 0), 6) reads_per_million, total > 0 detected from f""")
def variant_counts(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(library.frequencies(_full(spark, d)).select("sample", "ref_index", "sequence", "exact", "near", "total", "frequency_percent", "reads_per_million", "detected"))


_RANK = "rank() over (partition by sample order by {0}) + (count(*) over (partition by sample, {0}) - 1) / 2.0::double"
_CORR = "round(case when count(*) >= 3 then (sum({0} * rc) - sum({0}) * sum(rc) / count(*)) / nullif(sqrt((sum({0} * {0}) - sum({0}) * sum({0}) / count(*)) * (sum(rc * rc) - sum(rc) * sum(rc) / count(*))), 0) end, 6)"
_DETECTED = ", ".join(f"count(*) filter (total >= {k}) detected_{k}x, round(100.0::double * count(*) filter (total >= {k}) / count(*), 6) detected_{k}x_percent" for k in (1, 10, 100, 500))


@query(f"""with {_SQL_COUNTS},
w as (select *, count(*) over (partition by sample) n, sum(total) over (partition by sample) s, log10(total + 1.0::double) lc,
 row_number() over (partition by sample order by total, ref_index) up, row_number() over (partition by sample order by total desc, ref_index) down from f),
r as (select *, {_RANK.format("length")} rl, {_RANK.format("gc")} rg, {_RANK.format("lc")} rc from w)
select sample, sum(n_ids)::bigint designed_ids, count(*) unique_design_sequences, sum(total)::bigint mapped_reads, sum(exact)::bigint exact_mapped_reads, sum(near)::bigint near_mapped_reads,
{_DETECTED}, count(*) filter (total = 0) dropout_sequences, round(avg(total), 6) mean_coverage, round(median(total), 6) median_coverage,
min(total) filter (total > 0) min_nonzero_coverage, max(total) max_coverage, round(stddev_pop(total) / nullif(avg(total), 0), 6) coverage_cv,
round(quantile_cont(total, 0.05), 6) p05_coverage, round(quantile_cont(total, 0.10), 6) p10_coverage, round(quantile_cont(total, 0.90), 6) p90_coverage, round(quantile_cont(total, 0.95), 6) p95_coverage,
round(quantile_cont(total, 0.90) / nullif(quantile_cont(total, 0.10), 0), 6) p90_over_p10, round(quantile_cont(total, 0.95) / nullif(quantile_cont(total, 0.05), 0), 6) p95_over_p05,
round(2.0::double * sum(up * total) / nullif(count(*) * sum(total), 0)::double - case when sum(total) > 0 then (count(*) + 1.0::double) / count(*) end, 6) gini,
round(100.0::double * coalesce(sum(total) filter (down <= greatest(1, ceil(n * 0.01::double))), 0) / nullif(sum(total), 0), 6) top_1_percent_read_share_percent,
round(100.0::double * coalesce(sum(total) filter (down <= greatest(1, ceil(n * 0.10::double))), 0) / nullif(sum(total), 0), 6) top_10_percent_read_share_percent,
round(case when sum(total) > 0 then exp(-sum(case when total > 0 then total / s::double * ln(total / s::double) else 0 end)) end, 6) effective_library_size,
{_CORR.format("rl")} spearman_length_logcount, {_CORR.format("rg")} spearman_gc_logcount from r group by sample""")
def library_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(library.library_metrics(_full(spark, d)))


_ARRIVALS = ("1994-01-01", "1996-01-01", None)


@query(ORACLE_SQL["library_metrics"])
def followed_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The same, kept up to date by a stream: line items come in three batches by shipping date, the last with those that have none, and
    each batch is followed from the checkpoint of the one before."""
    folder = f"{shared_dir(spark)}/seqloom-follow-{uuid.uuid4().hex}"
    designs, since = _designs(spark, d), F.lit(False)
    for number, end in enumerate(_ARRIVALS):
        upto = F.coalesce(F.col("l_shipdate") < end, F.lit(False)) if end else F.lit(True)
        counts = library.count_matches(_matches(spark, d, upto & ~since))
        counts.withColumn("ref_index", F.col("ref_index").cast("long")).write.parquet(f"{folder}/counts/batch={number}")
        since = upto
        incremental.follow_counts(spark, designs, f"{folder}/counts", f"{folder}/cells", f"{folder}/checkpoint", once=True).awaitTermination()
    return _rounded(incremental.latest_metrics(spark, designs, f"{folder}/cells", _matches(spark, d)))


@query(f"with {_SQL_COUNTS} select sample, ref_index, sequence from f where total = 0")
def dropout_designs(spark: SparkSession, d: str) -> DataFrame:
    return library.dropouts(_full(spark, d)).select("sample", "ref_index", "sequence")


@query(f"with {_SQL_COUNTS}, r as (select *, row_number() over (partition by sample order by total desc, ref_index) place from f) select sample, place, ref_index, total from r where place <= 100")
def top_variants(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(library.top_designs(_full(spark, d)).select("sample", "place", "ref_index", "total"))


@query(f"with {_SQL_COUNTS} select sample, row_number() over (partition by sample order by total desc, ref_index) place, round(log10(total + 1.0::double), 6) log_count from f")
def rank_abundance(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(library.rank_abundance(_full(spark, d)))


_FLAGS = ["A", "N", "R"]
_SQL_FLAGS = "f as (select p_partkey ref_index, " + ", ".join(f"count(*) filter (l_returnflag = '{x}') {x}" for x in _FLAGS) + " from part left join lineitem on l_partkey = p_partkey group by 1)"


def _by_flag(spark: SparkSession, d: str) -> DataFrame:
    m = _t(spark, d, "lineitem").select(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("ref_index"), F.lit("exact").alias("match_type"))
    return library.zero_filled(library.count_matches(m), _designs(spark, d).select("ref_index"), m)


@query(f"with {_SQL_FLAGS} select * from f")
def count_matrix(spark: SparkSession, d: str) -> DataFrame:
    return library.count_matrix(_by_flag(spark, d), ["ref_index"], _FLAGS)


@query(f"with {_SQL_FLAGS} select ref_index, " + ", ".join(f"round(1e6::double * {x} / nullif(sum({x}) over (), 0), 6) {x}" for x in _FLAGS) + " from f")
def rpm_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(library.rpm_matrix(_by_flag(spark, d), ["ref_index"], _FLAGS))


@query("""with e as (select event_type, user_id from events), r as (select event_type sample, user_id from e union all select 'ALL_ASSIGNED', user_id from e where event_type <> 'error' union all select 'ALL_WITH_UNDETERMINED', user_id from e),
c as (select sample, user_id, count(*) n from r group by 1, 2) select sample, count(*) designs, sum(n)::bigint reads, max(n) most, round(quantile_cont(n, 0.9), 6) p90 from c group by 1""")
def rollup_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "events").select(F.col("event_type").alias("sample"), "user_id")
    counts = library.rolled_up(rows.groupBy("sample", "user_id").agg(F.count("*").alias("n")), ["user_id"], F.col("sample") == "error")
    return _rounded(counts.groupBy("sample").agg(F.count("*").alias("designs"), F.sum("n").alias("reads"), F.max("n").alias("most"), F.percentile("n", F.lit(0.9)).alias("p90")))


@query("select event_type category, count(*) count, round(100.0::double * count(*) / sum(count(*)) over (), 6) percent from events group by 1")
def classification(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(library.classification(library.category_counts(_t(spark, d, "events"), [], "event_type"), []))


@query("select l_linestatus sample, l_returnflag category, count(*) count, round(100.0::double * count(*) / sum(count(*)) over (partition by l_linestatus), 6) percent from lineitem group by 1, 2")
def classification_by_sample(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(library.classification(library.category_counts(_t(spark, d, "lineitem").withColumnRenamed("l_linestatus", "sample"), ["sample"], "l_returnflag"), ["sample"]))


@query(f"""with m as (select {_SAMPLE} sample, case l_returnflag when 'A' then 'exact' when 'R' then 'near' else case when l_discount < 0.03 then 'phix' else 'ambiguous' end end k, l_discount >= 0.02 l, l_tax >= 0.02 r, l_linenumber dis, l_quantity < 5 hm from lineitem),
t as (select sample, count(*) n, count(*) filter (k = 'phix') p, count(*) filter (k in ('exact', 'near')) m, count(*) filter (l) al, count(*) filter (r) ar, count(*) filter (l and r) ab, count(*) filter (hm) h, sum(dis)::bigint dis, count(*) filter (k = 'ambiguous') amb from m group by 1)
select sample, n total_units, p phix_reads, m mapped_reads, h pair_header_mismatches, dis pair_base_disagreements, amb ambiguous_reads, n - p non_phix_units, n - p - m unresolved_non_phix_reads,
round(100.0::double * m / n, 6) mapped_fraction_percent, round(100.0::double * p / n, 6) phix_fraction_percent, round(100.0::double * m / nullif(n - p, 0), 6) mapped_fraction_non_phix_percent, round(100.0::double * (n - p - m) / nullif(n - p, 0), 6) unresolved_non_phix_percent,
round((n - p)::double / nullif(p, 0), 6) library_to_phix_read_ratio, round(100.0::double * al / nullif(n - p, 0), 6) left_anchor_percent, round(100.0::double * ar / nullif(n - p, 0), 6) right_anchor_percent, round(100.0::double * ab / nullif(n - p, 0), 6) both_anchors_percent from t""")
def control_metrics(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "exact").when(F.col("l_returnflag") == "R", "near").when(F.col("l_discount") < 0.03, "phix").otherwise("ambiguous")
    m = _t(spark, d, "lineitem").select(F.expr(_SAMPLE).alias("sample"), kind.alias("match_type"), (F.col("l_discount") >= 0.02).alias("left_anchor"), (F.col("l_tax") >= 0.02).alias("right_anchor"), F.col("l_linenumber").alias("disagreements"), (F.col("l_quantity") < 5).alias("header_mismatch"))
    return _rounded(library.control_metrics(library.sample_totals(m)).drop("anchor_left", "anchor_right", "anchors_both", "anchor_missing_reads"))


# --- read quality: documents are reads, the last two letters of the alphabet are N


def _reads(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", "lang", "source", S.text_dna(F.col("text"), S.LETTER_BASES_N).alias("seq"), S.text_quality(F.col("text")).alias("qual"))


_SQL_READS = f"reads as (select doc_id, lang, source, {_dna('text', S.LETTER_BASES_N)} seq, translate({_UP.format('text')}, '{S.LETTERS}', '{S.LETTER_QUALITIES}') qual from documents)"
_SQL_BASES = f"{_SQL_READS}, b as (select lang, doc_id, i cycle, substr(seq, i::int, 1) base, greatest(0, ascii(substr(qual, i::int, 1)) - 33) q from (select *, unnest(range(1, length(seq) + 1)) i from reads))"


@query(f"""with {_SQL_BASES}, t as (select lang, sum(q) q, count(*) filter (q >= 20) q20, count(*) filter (q >= 30) q30, count(*) filter (base = 'N') n from b group by 1),
p as (select lang, count(*) total_reads, sum(length(seq))::bigint total_bases, avg(length(seq)) mean_length, min(length(seq)) min_length, nullif(max(length(seq)), 0) max_length, count(*) filter (contains(seq, 'N')) wn from reads group by 1)
select lang, total_reads, total_bases, round(mean_length, 6) mean_length, min_length, max_length, round(q::double / nullif(total_bases, 0), 6) mean_q, round(100.0::double * q20 / nullif(total_bases, 0), 6) q20_base_percent,
round(100.0::double * q30 / nullif(total_bases, 0), 6) q30_base_percent, round(100.0::double * n / nullif(total_bases, 0), 6) n_base_percent, round(100.0::double * wn / total_reads, 6) reads_with_n_percent from p join t using (lang)""")
def run_qc(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(qc.read_qc(_reads(spark, d), ["lang"]))


_SHARES = ", ".join(f"round(100.0::double * count(*) filter (base = '{x.upper()}') / count(*), 6) {x}_percent" for x in "acgtn")


@query(f"with {_SQL_BASES} select lang, cycle, count(*) total_bases, round(avg(q), 6) mean_q, round(100.0::double * count(*) filter (q >= 20) / count(*), 6) q20_percent, round(100.0::double * count(*) filter (q >= 30) / count(*), 6) q30_percent, {_SHARES} from b group by 1, 2")
def per_cycle_qc(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(qc.cycle_qc(_reads(spark, d), ["lang"]))


def _sql_kmers(k: int) -> str:
    return f"""with g as (select {_dna("text")} s from benchmark), w as (select s || left(s, {k - 1}) s from g where length(s) >= {k}), st as (select s from w union all select {_rc("s")} from w),
k as (select distinct substr(s, i::int, {k}) kmer from (select s, unnest(range(1, length(s) - {k - 2})) i from st)),
r as (select doc_id, {_dna("text")} s from documents), p as (select doc_id, s, unnest(list_distinct(list_append(range(0, length(s) - {k - 1}, 7), length(s) - {k}))) i from r where length(s) >= {k})
select doc_id, count(*) hits from p where substr(s, i::int + 1, {k}) in (select kmer from k) group by 1"""


def _kmers(spark: SparkSession, d: str, k: int) -> DataFrame:
    genomes = _t(spark, d, "benchmark").select(S.text_dna(F.col("text")).alias("sequence"))
    units = _t(spark, d, "documents").select("doc_id", S.text_dna(F.col("text")).alias("s"))
    return controls.kmer_hits(units, ["doc_id"], [F.col("s")], controls.genome_kmers(genomes, k), k)


@query(_sql_kmers(27))
def spikein_kmers(spark: SparkSession, d: str) -> DataFrame:
    return _kmers(spark, d, 27)


@query(_sql_kmers(51))
def spikein_kmers_51(spark: SparkSession, d: str) -> DataFrame:
    return _kmers(spark, d, 51)


_ANCHOR = "CTACGACA"


@query(f"""with r as (select doc_id, {_dna("text")} s from documents), p as (select doc_id, i, hamming(substr(s, i::int + 1, {len(_ANCHOR)}), '{_ANCHOR}') dist from (select doc_id, s, unnest(range(0, least(length(s) - {len(_ANCHOR)}, 70) + 1)) i from r where length(s) >= {len(_ANCHOR)}))
select doc_id, arg_min(i, dist * 1000 + i)::bigint as position, min(dist)::bigint as distance from p where dist <= 1 group by 1""")
def anchor_search(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "documents").select("doc_id", S.text_dna(F.col("text")).alias("s"))
    found = anchors.find_anchor(rows, "s", _ANCHOR, max_mismatches=1)
    return _rounded(found.where("anchor is not null").select("doc_id", F.col("anchor.position").alias("position"), F.col("anchor.distance").alias("distance")))


_SIG = 8
# The decision table in SQL: candidates by ends within one substitution, consensus base by base, best candidate and ties.
_SQL_MATCH = f"""r as (select p_partkey unit, {_dna("p_name || p_type")} s, p_size, translate({_UP.format("p_type || p_name")}, '{S.LETTERS}', '{S.LETTER_QUALITIES}') q from part),
u as (select unit, s, q, reverse(q) sq, left(s, (p_size % length(s))::int) || 'A' || substr(s, (p_size % length(s))::int + 2) p from r),
ids as (select s sequence, min(unit) f from r group by 1),
designs as (select sequence, row_number() over (order by f::varchar, sequence) - 1 ref_index from ids),
lists as (select list(distinct left(sequence, {_SIG})) a, list(distinct right(sequence, {_SIG})) b from designs),
heads as (select x from (select unnest(a) x from lists)), tails as (select x from (select unnest(b) x from lists)),
up as (select unit, x from (select unit, left(p, {_SIG}) k from u) join heads on hamming(k, x) <= 1), us as (select unit, x from (select unit, right(s, {_SIG}) k from u) join tails on hamming(k, x) <= 1),
cp as (select unit, ref_index from up join designs on left(sequence, {_SIG}) = x), cs as (select unit, ref_index from us join designs on right(sequence, {_SIG}) = x),
both_ as (select unit, ref_index from cp intersect select unit, ref_index from cs), either_ as (select unit, ref_index from cp union select unit, ref_index from cs),
c as (select * from both_ union all select * from either_ where unit not in (select unit from both_)),
w as (select unit, ref_index, sequence, length(sequence) n, p, q, s, sq, least(length(sequence), length(p)) np, least(length(sequence), length(s)) ns from c join u using (unit) join designs using (ref_index)),
b as (select *, unnest(range(1, n + 1)) i from w),
l as (select unit, ref_index, n, i, substr(sequence, i::int, 1) want, case when i <= np then substr(p, i::int, 1) end a, case when i <= np then greatest(0, ascii(substr(q, i::int, 1)) - 33) end qa,
 case when i > n - ns then substr(s, (length(s) - n + i)::int, 1) end z, case when i > n - ns then greatest(0, ascii(substr(sq, (length(sq) - n + i)::int, 1)) - 33) end qz from b),
m as (select *, case when a is null then z when z is null or z = a or qz <= qa then a else z end base from l),
d as (select unit, ref_index, count(*) filter (base <> want) distance, count(*) filter (a <> z) disagreements, string_agg(coalesce(base, 'N'), '' order by i) observed, count(base) / any_value(n)::double >= 0.95 enough from m group by 1, 2),
k as (select *, row_number() over (partition by unit order by distance, disagreements, ref_index, observed) rn, count(*) over (partition by unit, distance) tied from d where enough),
f as (select unit, ref_index, distance, disagreements, observed, case when tied > 1 then 'ambiguous' when distance = 0 then 'exact' when distance <= 2 then 'near' else 'too_many_mismatches' end match_type from k where rn = 1)"""


@query(f"""with {_SQL_MATCH} select unit, coalesce(match_type, case when unit in (select unit from c) then 'insufficient_evidence' else 'no_candidate' end) match_type,
case when match_type in ('exact', 'near') then ref_index end ref_index, observed, distance, coalesce(disagreements, 0) disagreements from u left join f using (unit)""")
def near_match(spark: SparkSession, d: str) -> DataFrame:
    """Parts as designs (names and types); every part also is a pair of reads, one with a changed base."""
    parts = _t(spark, d, "part").select("p_partkey", S.text_dna(F.concat("p_name", "p_type")).alias("s"), F.col("p_size"), S.text_quality(F.concat("p_type", "p_name")).alias("q"))
    rows = parts.select(F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("id"), F.col("s").alias("sequence"))
    designs = library.group_designs(rows)
    at = F.pmod("p_size", F.length("s")) + 1
    changed = F.concat(F.left("s", at - 1), F.lit("A"), F.substring("s", at + 1, F.length("s")))
    units = parts.select(
        F.col("p_partkey").alias("unit"), changed.alias("prefix"), F.col("q").alias("prefix_q"), F.col("s").alias("suffix"), F.reverse("q").alias("suffix_q"),
        F.array().cast("array<string>").alias("fulls"), F.lit(True).alias("left_anchor"), F.lit(True).alias("right_anchor"),
    )
    return _rounded(matcher.match(units, designs.select("ref_index", "sequence"), ["unit"], signature=8, max_mismatches=2))


_FULL = _dna("p_name || p_type")


@query(f"""with r as (select p_partkey unit, {_FULL} s from part), ids as (select s, min(unit) f from r group by 1), designs as (select s, row_number() over (order by f::varchar, s) - 1 ref_index from ids)
select unit, case when unit % 3 < 2 then 'exact' else 'no_candidate' end match_type, case when unit % 3 < 2 then ref_index end ref_index, case when unit % 3 < 2 then s end observed, case when unit % 3 < 2 then 0 end::bigint distance, 0::bigint disagreements from r join designs using (s)""")
def full_target_match(spark: SparkSession, d: str) -> DataFrame:
    """Every part as a design, and as a pair whose whole target is read at its first or second place, or is none of the designs'."""
    parts = _t(spark, d, "part").select("p_partkey", S.text_dna(F.concat("p_name", "p_type")).alias("s"))
    designs = library.group_designs(parts.select(F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("id"), F.col("s").alias("sequence")))
    kind, none = F.col("p_partkey") % 3, F.lit(None).cast("string")
    fulls = F.when(kind == 0, F.array("s")).when(kind == 1, F.array(F.lit("ACGT"), "s")).otherwise(F.array(F.lit("ACGT")))
    units = parts.select(F.col("p_partkey").alias("unit"), *[none.alias(c) for c in ("prefix", "prefix_q", "suffix", "suffix_q")], fulls.alias("fulls"), F.lit(True).alias("left_anchor"), F.lit(False).alias("right_anchor"))
    return _rounded(matcher.match(units, designs.select("ref_index", "sequence"), ["unit"]))


# --- sample indexes: part type and name are the two parts of a barcode, each type is a sample

_SQL_NEAR = f"""o as (select {_dna("p_type")} || '+' || {_dna("p_name")} b, count(*) n from part group by 1),
e as (select p_type sample, {_dna("p_type")} i7, {_dna("min(p_name)")} i5 from part group by 1),
c as (select sample, i7 || '+' || i5 b, 'as_given' o from e union all select sample, i7 || '+' || {_rc("i5")}, 'i5_reverse_complement' from e where {_rc("i5")} <> i5),
x as (select o.b observed_barcode, n, c.sample, c.b expected, c.o orientation, case when length(split_part(o.b, '+', 1)) = length(split_part(c.b, '+', 1)) and length(split_part(o.b, '+', 2)) = length(split_part(c.b, '+', 2)) then hamming(o.b, c.b) else 999 end d from o cross join c),
y as (select *, row_number() over (partition by observed_barcode order by d, sample, orientation) rn, min(d) over (partition by observed_barcode) md from x),
near as (select observed_barcode, n count, max(sample) filter (rn = 1) nearest_sample, max(expected) filter (rn = 1) nearest_expected, md::bigint distance, max(orientation) filter (rn = 1) orientation, count(*) filter (d = md) tied_best_candidates from y group by observed_barcode, n, md)"""
_SQL_SUBS = f"""{_SQL_NEAR}, pp as (select count n, p, split_part(observed_barcode, '+', p) o, split_part(nearest_expected, '+', p) e from near, (values (1), (2)) v(p) where distance <= 2),
subs as (select 'I' || p index_read, i as position, substr(e, i::int, 1) expected_base, substr(o, i::int, 1) observed_base, sum(n)::bigint weighted_reads from (select *, unnest(range(1, length(e) + 1)) i from pp) group by 1, 2, 3, 4)"""


def _nearest(spark: SparkSession, d: str) -> DataFrame:
    parts = _t(spark, d, "part")
    observed = parts.select(F.concat_ws("+", S.text_dna(F.col("p_type")), S.text_dna(F.col("p_name"))).alias("barcode")).groupBy("barcode").agg(F.count("*").alias("count"))
    sheet = parts.groupBy("p_type").agg(F.min("p_name").alias("n")).select(F.col("p_type").alias("sample"), S.text_dna(F.col("p_type")).alias("i7"), S.text_dna(F.col("n")).alias("i5"))
    return indexqc.nearest(observed, sheet)


@query(f"with {_SQL_NEAR} select * from near")
def barcode_nearest(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_nearest(spark, d))


@query(f"with {_SQL_SUBS} select * from subs")
def barcode_substitutions(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(indexqc.substitutions(_nearest(spark, d)))


@query(f"""with {_SQL_SUBS}, g as (select coalesce(sum(weighted_reads), 0)::bigint t, coalesce(sum(weighted_reads) filter (observed_base = 'G'), 0)::bigint g, coalesce(sum(weighted_reads) filter (observed_base = 'N'), 0)::bigint n from subs where expected_base = 'G')
select t expected_g, g g_to_g, n g_to_n, t - g - n g_to_other, round(100.0::double * n / nullif(t, 0), 6) g_to_n_percent, round(100.0::double * (t - g - n) / nullif(t, 0), 6) g_to_other_percent from g""")
def expected_g_profile(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(indexqc.expected_g(indexqc.substitutions(_nearest(spark, d))))


@query(f"with {_SQL_NEAR}, v as (select orientation, sum(count)::bigint votes from near group by 1) select orientation, votes, row_number() over (order by votes desc, orientation) = 1 preferred from v")
def orientation_vote(spark: SparkSession, d: str) -> DataFrame:
    return indexqc.orientation_votes(_nearest(spark, d))


_SOURCE_COLUMNS = dict(zip(indexqc.SOURCES, ("p_name", "p_type", "p_brand"), strict=True))


def _sources(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    parts = _t(spark, d, "part")
    return {n: parts.groupBy(S.text_dna(F.col(c)).alias("barcode")).agg(F.count("*").alias("count")) for n, c in _SOURCE_COLUMNS.items()}


@query(f"""with {_SQL_SUBS}, g as (select coalesce(sum(weighted_reads), 0)::bigint t, coalesce(sum(weighted_reads) filter (observed_base = 'G'), 0)::bigint g, coalesce(sum(weighted_reads) filter (observed_base = 'N'), 0)::bigint n from subs where expected_base = 'G'),
h as (select sum(count)::bigint a, coalesce(sum(count) filter (distance = 0), 0)::bigint z, coalesce(sum(count) filter (distance <= 2), 0)::bigint w, coalesce(sum(count) filter (distance >= 999), 0)::bigint i from near),
v as (select orientation from near group by 1 order by sum(count) desc, orientation limit 1),
u as (select count(*) filter (l_linestatus = 'O') a, count(*) filter (l_linestatus = 'F') u, count(*) filter (l_linestatus = 'O' and l_returnflag = 'R') ap, count(*) filter (l_linestatus = 'F' and l_returnflag = 'R') up from lineitem),
k as (select count(*) n, count(distinct {_dna("p_name")}) a, count(distinct {_dna("p_type")}) b from part)
select (select count(*) from e) expected_index_count, u.a assigned_read_pairs_or_reads, u.u undetermined_read_pairs_or_reads, round(100.0::double * u.a / nullif(u.a + u.u, 0), 6) assigned_read_fraction_percent, round(100.0::double * u.u / nullif(u.a + u.u, 0), 6) undetermined_read_fraction_percent,
ap assigned_phix_reads, up undetermined_phix_reads, u.a - ap assigned_non_phix_reads, u.u - up undetermined_non_phix_reads, round(100.0::double * (u.u - up) / nullif(u.a - ap + u.u - up, 0), 6) undetermined_non_phix_fraction_percent,
k.n raw_I1_I2_index_reads_counted, k.a raw_I1_I2_unique_retained, k.n header_index_reads_counted, k.b header_index_unique_retained, k.n top_unknown_reads_counted,
h.a observed_index_reads_analyzed, z exact_expected_index_reads, w within_2_bp_expected_reads, i incomparable_index_reads, t expected_G_position_weighted_reads_within_threshold, g.g expected_G_to_G, g.n expected_G_to_N, t - g.g - g.n expected_G_to_other,
round(100.0::double * g.n / nullif(t, 0), 6) expected_G_to_N_percent, round(100.0::double * (t - g.g - g.n) / nullif(t, 0), 6) expected_G_to_other_percent, v.orientation preferred_i5_orientation from g, h, u, k, v""")
def index_summary(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "lineitem").groupBy((F.col("l_linestatus") == "F").alias("undetermined")).agg(F.count("*").alias("units"), F.count_if(F.col("l_returnflag") == "R").alias("phix"))
    sheet = _t(spark, d, "part").agg(F.count_distinct("p_type").alias("expected_index_count"))
    return _rounded(indexqc.one_row(sheet, indexqc.unit_figures(lines), indexqc.source_figures(_sources(spark, d)), indexqc.summary(_nearest(spark, d))))


@query("with s as (" + " union all ".join(f"select {_dna(c)} barcode, count(*) count, '{n}' source, {i} o from part group by 1" for i, (n, c) in enumerate(_SOURCE_COLUMNS.items())) + ") select barcode, count, source from s order by count desc, barcode, o limit 5000")
def top_barcodes(spark: SparkSession, d: str) -> DataFrame:
    return indexqc.top_barcodes(_sources(spark, d))


_SQL_INDEX = f"case when length({_dna('event_type')}) >= 6 then {_dna('event_type')} end"


@query(f"select event_id, '@T:1:F:1:1:1:' || event_id read_id, {_SQL_INDEX} header_index from events")
def read_headers(spark: SparkSession, d: str) -> DataFrame:
    letters = S.text_dna(F.col("event_type"))
    index = F.when(F.col("event_id") % 2 == 1, F.lower(letters)).otherwise(letters)
    e = _t(spark, d, "events").select("event_id", F.concat(F.lit("@T:1:F:1:1:1:"), "event_id", F.lit("/1 1:N:0:"), index).alias("h"))
    return e.select("event_id", S.canonical_read_id(F.col("h")).alias("read_id"), S.header_index(F.col("h")).alias("header_index"))


@query(f"""with p as (select {_dna("o_orderpriority")} a, {_dna("o_orderpriority || o_orderstatus")} b from orders), i as (select case when length(a) between 6 and 40 then a end a, case when length(b) between 6 and 40 then b end b from p),
u as (select a x from i where a is not null union all select b from i where b is not null and (a is null or b <> a)) select x barcode, count(*) count from u group by 1""")
def header_index_counts(spark: SparkSession, d: str) -> DataFrame:
    cased = lambda x: F.when(F.col("o_orderkey") % 2 == 1, F.lower(x)).otherwise(x)
    head = lambda *c: S.header_index(F.concat(F.lit("@r 1:N:0:"), cased(S.text_dna(F.concat(*c)))))
    pairs = _t(spark, d, "orders").select(head("o_orderpriority").alias("i1"), head("o_orderpriority", "o_orderstatus").alias("i2"))
    return indexqc.header_counts(pairs, "i1", "i2")


@query(f"with {_SQL_READS} select lang sample, source design_key, seq observed, 'exact' match_type, count(*) count from reads where seq <> '' and not contains(seq, 'N') group by 1, 2, 3")
def observed_sequences(spark: SparkSession, d: str) -> DataFrame:
    return library.observed_sequences(_reads(spark, d).select(F.col("lang").alias("sample"), F.col("source").alias("design_key"), F.col("seq").alias("observed"), F.lit("exact").alias("match_type")))


@query(f"select {_dna('p_name')} sequence, string_agg(p_partkey::varchar, '|' order by p_partkey) ids, count(*) id_count from part group by 1 having count(*) > 1")
def design_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("id"), S.text_dna(F.col("p_name")).alias("sequence"))
    return library.duplicates(library.unique_designs(rows))


@query(f"select doc_id, {_rc(_dna('text', S.LETTER_BASES_N))} rc, round(100.0::double * {_n(_dna('text'), 'GC')} / nullif(length({_dna('text')}), 0), 6) gc_percent from documents")
def reverse_complement_gc(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_t(spark, d, "documents").select("doc_id", S.reverse_complement(S.text_dna(F.col("text"), S.LETTER_BASES_N)).alias("rc"), S.gc_percent(S.text_dna(F.col("text"))).alias("gc_percent")))


_LEFT, _RIGHT = "ACGTACGTACGTACGTACGT", "TTGCATTGCATTGCATTGCA"


@query(f"""with s as (select doc_id, case doc_id % 3 when 0 then '{_LEFT}' || d || {_rc(f"'{_RIGHT}'")} when 1 then right('{_LEFT}', 15) || d || left({_rc(f"'{_RIGHT}'")}, 15) else d end x, d from (select doc_id, {_dna("text")} d from documents where length({_dna("text")}) > 0))
select doc_id, case when starts_with(x, '{_LEFT}') and ends_with(x, {_rc(f"'{_RIGHT}'")}) and length(x) > 40 then substr(x, 21, length(x) - 40) when starts_with(x, right('{_LEFT}', 15)) and ends_with(x, left({_rc(f"'{_RIGHT}'")}, 15)) and length(x) > 30 then substr(x, 16, length(x) - 30) else x end target from s""")
def reference_trim(spark: SparkSession, d: str) -> DataFrame:
    """Documents with whole primers, with their inner arms or with none, by id."""
    right = _RIGHT.translate(str.maketrans(*S.COMPLEMENT))[::-1]
    seq = S.text_dna(F.col("text"))
    kind = F.col("doc_id") % 3
    flanked = F.when(kind == 0, F.concat(F.lit(_LEFT), seq, F.lit(right))).when(kind == 1, F.concat(F.lit(_LEFT[-15:]), seq, F.lit(right[:15]))).otherwise(seq)
    return _t(spark, d, "documents").where(F.length(seq) > 0).select("doc_id", S.trim_flanks(flanked, _LEFT, _RIGHT).alias("target"))


@query("select p_partkey, p_name, case when levenshtein(p_name, 'small ring') > 4 then 5 else levenshtein(p_name, 'small ring') end edits, case when length(p_name) = 10 then hamming(p_name, 'small ring') else greatest(length(p_name), 10) end differing from part")
def name_distances(spark: SparkSession, d: str) -> DataFrame:
    parts = _t(spark, d, "part")
    return _rounded(parts.select("p_partkey", "p_name", S.bounded_levenshtein(F.col("p_name"), F.lit("small ring"), 4).alias("edits"), S.hamming(F.col("p_name"), F.lit("small ring")).alias("differing")))


# The layouts that file names are tried in: (before the read, mark before the read, read, rest, sample, lane, chunk).
_LAYOUTS = [
    ("{s}_S7_L{l}", "_", "R{r}", "_001.fastq.gz", "{s}", "{l}", "001"), ("{s}", ".", "R{r}", ".fastq.gz", "{s}", "", ""), ("{s}_S12", "_", "{r}", ".fq", "{s}", "", ""),
    ("{s}", "_", "R{r}", "_0001.fastq", "{s}", "", "0001"), ("{s}_L{l}", ".", "I{r}", ".2.FQ.GZ", "{s}", "{l}", "2"), ("{s}_S3_S4", "_", "r{r}", "_1.fastq", "{s}", "", "1"), ("", "_", "R{r}", "_003.fastq", "", "", "003"), ("{s}", "-", "R{r}", ".txt", None, None, None),
]


def _layout_case(field: int, sample: str, lane: str, read: str) -> str:
    def text(pattern: str | None) -> str:
        if pattern is None:
            return "null"
        parts = pattern.replace("{s}", "\0{s}\0").replace("{l}", "\0{l}\0").replace("{r}", "\0{r}\0").split("\0")
        return "concat('', " + ", ".join({"{s}": sample, "{l}": lane, "{r}": read}.get(x, f"'{x}'") for x in parts) + ")"

    return "case p_partkey % 8 " + " ".join(f"when {i} then {text(''.join(x[:4]) if field < 0 else x[field])}" for i, x in enumerate(_LAYOUTS)) + " end"


_PLATE = ("concat('Plate ', p_brand)", "lpad(cast(p_size % 8 + 1 as varchar(3)), 3, '0')", "cast((p_partkey % 2 + 1) as varchar(3))")


@query(f"""select p_partkey, {_layout_case(4, *_PLATE)} as sample, case when p_partkey % 8 = 7 then null else coalesce(nullif(trim(regexp_replace(concat({_layout_case(4, *_PLATE)}, '.'), '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'sample') end safe,
{_layout_case(5, *_PLATE)} as lane, case p_partkey % 8 when 7 then null when 4 then concat('I', {_PLATE[2]}) else concat('R', {_PLATE[2]}) end as "read", {_layout_case(6, *_PLATE)} as chunk from part""")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of all layouts, by part."""
    parts = _t(spark, d, "part").select("p_partkey", S.file_parts(F.expr(_layout_case(-1, *_PLATE))).alias("f"))
    safe = F.when(F.col("f").isNotNull(), S.safe_name(F.concat("f.sample", F.lit("."))))
    return parts.select("p_partkey", F.col("f.sample").alias("sample"), safe.alias("safe"), F.col("f.lane").alias("lane"), F.col("f.read").alias("read"), F.col("f.chunk").alias("chunk"))


@query("select l_returnflag, l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_returnflag order by l_orderkey, l_linenumber, l_partkey) rn from lineitem) where rn <= 1000")
def max_reads_prefix(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", F.expr("l_orderkey div 1024").alias("chunk"))
    rows = numbering.first_rows(rows, ["l_returnflag"], ["chunk"], ["l_orderkey", "l_linenumber", "l_partkey"], 1000)
    return _rounded(rows.drop("chunk"))


@query("""with a as (select conv_id, turn // 2 ord, text from conversations where turn % 2 = 0), b as (select conv_id, turn // 2 ord, text from conversations where turn % 2 = 1)
select coalesce(a.conv_id, b.conv_id) chunk, count(*) filter (a.text is not null and b.text is not null) pairs, count(*) filter (b.ord is null) r1_only, count(*) filter (a.ord is null) r2_only from a full join b on a.conv_id = b.conv_id and a.ord = b.ord group by 1""")
def positional_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Turns of a conversation as the two read files of a chunk, joined by position; unequal counts show as singles."""
    c = _t(spark, d, "conversations").withColumn("ord", F.expr("turn div 2"))
    side = lambda k: c.where(F.col("turn") % 2 == k).select(F.col("conv_id").alias("chunk"), "ord", F.col("text").alias(f"t{k}"), F.lit(True).alias(f"in{k}"))
    both = side(0).join(side(1), ["chunk", "ord"], "full")
    return both.groupBy("chunk").agg(F.count_if(F.col("t0").isNotNull() & F.col("t1").isNotNull()).alias("pairs"), F.count_if(F.col("in1").isNull()).alias("r1_only"), F.count_if(F.col("in0").isNull()).alias("r2_only"))


@query("""with p as (select p_partkey, case when p_partkey % 3 = 0 then p_type else p_name end || '|' || p_size chunk, case when p_partkey % 2 = 0 then 'R1' else 'R2' end r from part),
paired as (select chunk from p group by 1 having count(distinct r) = 2) select p_partkey, chunk, r as "read" from p where chunk not in (select chunk from paired)""")
def leftover_files(spark: SparkSession, d: str) -> DataFrame:
    """Parts as files of chunks, even ones R1 and odd ones R2: the anti-join that finds files no pair consumed."""
    chunk = F.concat_ws("|", F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(F.col("p_name")), "p_size")
    files = _t(spark, d, "part").select("p_partkey", chunk.alias("chunk"), F.when(F.col("p_partkey") % 2 == 0, "R1").otherwise("R2").alias("read"))
    paired = files.groupBy("chunk").agg(F.count_distinct("read").alias("n")).where("n = 2")
    return files.join(paired, "chunk", "left_anti").select("p_partkey", "chunk", "read")


# --- SQL text with the session's functions


@query(f"""with p as (select p_partkey, p_name, {_dna("p_name")} n, {_dna("p_type")} t from part) select p_partkey, {_rc("n")} rc, round(100.0::double * {_n("n", "GC")} / nullif(length(n), 0), 6) gc_percent,
case when length(n) = length(t) then hamming(n, t) else greatest(length(n), length(t)) end differing, case when length(n) = length(t) then hamming(n, t) else 999 end index_distance, case when levenshtein(p_name, 'small ring') > 4 then 5 else levenshtein(p_name, 'small ring') end edits,
case when length(n) between 6 and 40 then n end header_index, '@r' || p_partkey read_id from p""")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    register(spark)
    dna = lambda c: f"translate(upper(regexp_replace({c}, '[^A-Za-z]', '')), '{S.LETTERS}', '{S.LETTER_BASES}')"
    text = f"""with p as (select p_partkey, p_name, {dna("p_name")} n, {dna("p_type")} t, concat('@r', p_partkey, '/1 1:N:0:', lower({dna("p_name")})) h from {{parts}})
        select p_partkey, seq_reverse_complement(n) rc, round(seq_gc_percent(n), 6) gc_percent, cast(seq_differing(n, t) as bigint) differing, cast(seq_index_distance(n, t) as bigint) index_distance,
        cast(seq_edits(p_name, 'small ring', 4) as bigint) edits, seq_header_index(h) header_index, seq_read_id(h) read_id from p"""
    return spark.sql(text, parts=_t(spark, d, "part"))


@query(f"""with r as (select doc_id, {_dna("text")} s from documents), p as (select doc_id, s, unnest(list_distinct(list_append(range(0, length(s) - 10, 5), length(s) - 11))) i from r where length(s) >= 11)
select doc_id, count(*) windows, count(distinct substr(s, i::int + 1, 11)) kmers, max(i)::bigint last_place, min(substr(s, i::int + 1, 11)) first_kmer from p group by 1""")
def sql_kmer_table(spark: SparkSession, d: str) -> DataFrame:
    register(spark)
    docs = _t(spark, d, "documents").select("doc_id", S.text_dna(F.col("text")).alias("seq"))
    return spark.sql("select id doc_id, count(*) windows, count(distinct kmer) kmers, max(place) last_place, min(kmer) first_kmer from seq_kmers(table(select doc_id, seq from {docs}), 11, 5) group by id", docs=docs)
