"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

A token budget is handed down a domain - language - source tree. At each node the children get shares in
proportion to integer weights; a child whose whole subtree holds less (tokens times the allowed epochs)
keeps what it holds, and its shortage goes to its siblings before it can reach an ancestor's siblings.
Each leaf then takes whole seeded epochs and a token-prefix of one more, in that epoch's seeded order.

The prefix needs no sort of a leaf: token sums by the leading hex digits of the order key find the one
small range in which the prefix ends, two digits at a time, and only that range is ordered. A group of a
level has at most 256 rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.llm.common import free_name, stage

LEAF = ["domain", "lang", "source"]
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Parameters: shares of the budget in percent of all tokens, weights by node (default 1), seed."""

    percent: int = 60
    max_epochs: int = 3
    seed: int = 17
    domains: int = 4
    domain_weights: dict[str, int] = field(default_factory=lambda: {"d0": 4, "d1": 3, "d2": 2, "d3": 1})
    lang_weights: dict[str, int] = field(default_factory=lambda: {"en": 6, "de": 2, "fr": 2})

    def domain(self, source: Column) -> Column:
        """The domain a source belongs to: its checksum modulo the number of domains."""
        return F.concat(F.lit("d"), F.conv(F.substring(F.md5(source), 1, 4), 16, 10).cast("int") % self.domains)


def _weight(key: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for k, w in sorted(weights.items()):
        out = F.when(key == k, F.lit(w)).otherwise(out)
    return out.cast("long")


def _share(children: DataFrame, parents: list[str], key: str) -> DataFrame:
    """Water-filling in whole tokens: children(parents, key, w, cap, budget) get ``alloc``, at most cap each."""
    order = W.partitionBy(*parents).orderBy(F.col("cap") / F.col("w"), key)
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.currentRow, W.unboundedFollowing)
    node = W.partitionBy(*parents)
    d = children.withColumns({"_p": F.coalesce(F.sum("cap").over(before), F.lit(0)), "_w": F.sum("w").over(after)})
    d = d.withColumn("_full", (F.col("budget") - F.col("_p")) * F.col("w") >= F.col("cap") * F.col("_w"))
    d = d.withColumn("_full", F.min("_full").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    d = d.withColumns({"_left": F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(node), F.lit(0)), "_open": F.sum(F.when(~F.col("_full"), F.col("w"))).over(node)})
    d = d.withColumn("_a", F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("(_left * w) div _open")))
    d = d.withColumn("_r", F.col("budget") - F.sum("_a").over(node))
    d = d.withColumn("_n", F.row_number().over(W.partitionBy(*parents, "_full").orderBy(key)))
    more = ~F.col("_full") & (F.col("_n") <= F.col("_r"))
    return d.withColumn("alloc", F.least("cap", F.col("_a") + F.when(more, 1).otherwise(0))).drop("_p", "_w", "_full", "_left", "_open", "_a", "_r", "_n")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves(domain, lang, source, tokens) with ``quota`` in tokens."""
    cap = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    langs = cap.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("root", F.lit(0))
    budget = F.expr(f"least((sum(cap) over (partition by root) div {mix.max_epochs}) * {mix.percent} div 100, sum(cap) over (partition by root))")
    domains = _share(domains.withColumns({"w": _weight(F.col("domain"), mix.domain_weights), "budget": budget}), ["root"], "domain")
    langs = langs.join(domains.select("domain", F.col("alloc").alias("budget")), "domain").withColumn("w", _weight(F.col("lang"), mix.lang_weights))
    langs = _share(langs, ["domain"], "lang")
    out = cap.join(langs.select("domain", "lang", F.col("alloc").alias("budget")), ["domain", "lang"]).withColumn("w", F.lit(1).cast("long"))
    return _share(out, ["domain", "lang"], "source").select(*LEAF, "tokens", F.col("alloc").alias("quota"))


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Rows that the mixture takes: doc_id, leaf, n_tokens, epochs (whole uses), prefix_tokens (of one more use).

    ``docs(doc_id, text, lang, source)``: tokens are runs of non-blank characters; null texts have none;
    null keys count as ''. A row without tokens is taken only with whole epochs. Ties of the order key
    (rows that repeat a doc_id) follow doc_id and n_tokens. An empty table gives an empty result.
    """
    source = F.coalesce("source", F.lit(""))
    rows = docs.select(
        "doc_id", mix.domain(source).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), source.alias("source"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
    )
    rows = stage(rows, "mix-rows")
    leaves = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    quota = leaf_budgets(leaves, mix).withColumns({"epochs": F.expr("if(tokens = 0, 0, quota div tokens)"), "rest": F.expr("if(tokens = 0, 0, quota % tokens)")})
    quota = stage(quota.select(*LEAF, "epochs", "rest"), "mix-leaves")
    keyed = rows.join(quota, LEAF).withColumn("h", F.md5(F.concat_ws("|", F.lit(mix.seed), "epochs", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    keyed = stage(keyed.where("epochs > 0 or rest > 0"), "mix-keyed")
    ends = quota.where("rest > 0").withColumn("stem", F.lit(""))
    for level in range(2):
        at = F.substring("h", 2 * level + 1, 2)
        within = keyed.drop("rest", "epochs").join(ends.select(*LEAF, "stem", "rest"), LEAF).where(F.col("h").startswith(F.col("stem")))
        sums = within.groupBy(*LEAF, "stem", "rest", at.alias("d")).agg(F.sum("n_tokens").alias("t"))
        upto = F.sum("t").over(W.partitionBy(*LEAF).orderBy("d"))
        ends = sums.withColumn("upto", upto).where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("t") < F.col("rest")))
        ends = ends.select(*LEAF, F.concat("stem", "d").alias("stem"), (F.col("rest") - F.col("upto") + F.col("t")).alias("rest"))
        ends = stage(ends, "mix-ends")
    marks = keyed.drop("rest").join(ends.select(*LEAF, "stem", "rest"), LEAF, "left")
    out = ["doc_id", *LEAF, "n_tokens", "epochs"]
    place = F.substring("h", 1, 4)
    inside = marks.where(place == F.col("stem"))
    run = F.sum("n_tokens").over(W.partitionBy(*LEAF).orderBy("h", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, W.currentRow))
    inside = inside.withColumn("upto", run).select(*out, F.greatest(F.lit(0), F.least("n_tokens", F.col("rest") - F.col("upto") + F.col("n_tokens"))).alias("prefix_tokens"))
    clear = marks.where(F.col("stem").isNull() | (place != F.col("stem"))).select(*out, F.when(place < F.col("stem"), F.col("n_tokens")).otherwise(0).alias("prefix_tokens"))
    return clear.union(inside).where("epochs > 0 or prefix_tokens > 0")


def take(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` as the mixture takes them, each at most once: a prefix keeps the text's first tokens.

    Rows that share an id are all taken as far as the most that one of them is taken; rows without an id count as sharing one. Null and empty texts
    have no tokens and come only with whole epochs. Columns may have any name; an empty table gives an empty result.
    """
    key, some, every = (free_name(docs, c) for c in ("_id", "_take", "_all"))
    taken = mixture(docs, mix).groupBy(F.col("doc_id").alias(key)).agg(F.max(F.when(F.col("epochs") > 0, F.col("n_tokens")).otherwise(F.col("prefix_tokens"))).alias(some), F.max("n_tokens").alias(every))
    joined = docs.join(taken.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col(key)))
    blank_first = F.when(F.col("text").rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    cut = F.array_join(F.slice(F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1), 1, F.col(some).cast("int") + blank_first), "")
    short = F.col(some) < F.col(every)
    change = {"text": F.when(short, cut).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        change["n_chars"] = F.when(short, F.length(cut).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.withColumns(change).select(*docs.columns)


def _share_sql(name: str, source: str, parents: list[str], key: str, weight: str) -> str:
    """SQL of ``_share``: ctes ending in ``name``."""
    by = f"partition by {', '.join(parents)}" if parents else "partition by 1"
    keys = ", ".join([*parents, key])
    return f"""{name}_a as (select *, {weight} w from {source}),
{name}_b as (select *, (budget - coalesce(sum(cap) over ({by} order by cap / w::double, {key} rows between unbounded preceding and 1 preceding), 0)) * w >= cap * sum(w) over ({by} order by cap / w::double, {key} rows between current row and unbounded following) f0 from {name}_a),
{name}_c as (select *, bool_and(f0) over ({by} order by cap / w::double, {key} rows between unbounded preceding and current row) f from {name}_b),
{name}_d as (select *, case when f then cap else ((budget - coalesce(sum(cap) filter (f) over ({by}), 0)) * w) // sum(w) filter (not f) over ({by}) end a from {name}_c),
{name} as (select {keys}, cap, least(cap, a + case when not f and row_number() over (partition by {', '.join([*parents, 'f'])} order by {key}) <= budget - sum(a) over ({by}) then 1 else 0 end)::bigint alloc from {name}_d)"""


def _weight_sql(key: str, weights: dict[str, int]) -> str:
    return f"(case {key} " + " ".join(f"when '{k}' then {w}" for k, w in sorted(weights.items())) + " else 1 end)::bigint"


def oracle(mix: Mix = Mix()) -> str:
    pattern = WORD.replace("'", "''")
    total = "(select sum(cap) from domains0)"
    return f"""with docs as (select doc_id, coalesce(source, '') source, coalesce(lang, '') lang, len(regexp_extract_all(coalesce(text, ''), '{pattern}'))::bigint n_tokens from documents),
rows_ as (select doc_id, 'd' || (('0x' || substr(md5(source), 1, 4))::int % {mix.domains}) as domain, lang, source, n_tokens from docs),
leaves as (select domain, lang, source, sum(n_tokens)::bigint tokens, sum(n_tokens)::bigint * {mix.max_epochs} cap from rows_ group by 1, 2, 3),
langs0 as (select domain, lang, sum(cap)::bigint cap from leaves group by 1, 2), domains0 as (select domain, sum(cap)::bigint cap from langs0 group by 1),
domains1 as (select *, least(({total} // {mix.max_epochs}) * {mix.percent} // 100, {total})::bigint budget from domains0),
{_share_sql("domains2", "domains1", [], "domain", _weight_sql("domain", mix.domain_weights))},
langs1 as (select langs0.*, d.alloc budget from langs0 join domains2 d using (domain)),
{_share_sql("langs2", "langs1", ["domain"], "lang", _weight_sql("lang", mix.lang_weights))},
leaves1 as (select leaves.*, l.alloc budget from leaves join langs2 l using (domain, lang)),
{_share_sql("leaves2", "leaves1", ["domain", "lang"], "source", "1::bigint")},
quota as (select domain, lang, source, case when tokens = 0 then 0 else alloc // tokens end epochs, case when tokens = 0 then 0 else alloc % tokens end rest from leaves2 join leaves using (domain, lang, source)),
keyed as (select rows_.*, epochs, rest, md5({mix.seed} || '|' || epochs || '|' || coalesce(doc_id::varchar, '')) h from rows_ join quota using (domain, lang, source)),
run as (select *, sum(n_tokens) over (partition by domain, lang, source order by h, doc_id, n_tokens rows between unbounded preceding and current row) upto from keyed),
taken as (select doc_id, domain, lang, source, n_tokens, epochs::bigint epochs, greatest(0, least(n_tokens, rest - upto + n_tokens))::bigint prefix_tokens from run)
select * from taken where epochs > 0 or prefix_tokens > 0"""


ORACLE_SQL = oracle()
