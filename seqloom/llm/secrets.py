"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. A scan reads only pairs of
blob and rule version that the ledger doesn't hold yet: one representative version of each new blob is
scanned, its findings are appended to the ledger, and the ledger's findings are joined back to all paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.llm.common import free_name, stage


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count if group ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The three base rules.
_WORDS = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
RULES = (
    Rule("assign", 1, rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # a run of these characters matches as a whole or not at all, so its least length may stand in the pattern
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
SPAN = "array<struct<start:int,end:int,first:int,last:int>>"
HIT = "array<struct<gap:struct<n:int,b:int>,size:struct<n:int,b:int>,ok:boolean>>"
MARK = "[SECRET]"


def rule_hits(text: Column, rule: Rule) -> Column:
    """A rule's matches in order: lengths of each and of the gap before it, in code points (n) and bytes (b), and
    whether it counts. The text is read a fixed number of times, however many matches it has."""
    both = lambda x: F.struct(F.length(x).alias("n"), F.octet_length(x).alias("b"))
    pattern = F.lit(rule.pattern)
    hits = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), both).alias("gap"), F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), both).alias("size"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda v: F.length(v) >= rule.least).alias("ok"),
    )
    return F.when(text.rlike(rule.pattern), hits.cast(HIT)).otherwise(F.array().cast(HIT))


def spans_of(rows: DataFrame) -> DataFrame:
    """rows(blob, kind, version, hits) with ``spans`` (code points and bytes) for hits: running sums over one text's matches."""
    key = ["blob", "kind", "version"]
    line = W.partitionBy(*key).orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = lambda unit: F.sum(F.col(f"h.gap.{unit}") + F.col(f"h.size.{unit}")).over(line).cast("int")
    each = rows.where(F.size("hits") > 0).select(*key, F.posexplode("hits").alias("i", "h")).where("h.size is not null").withColumns({"end": upto("n"), "last": upto("b")})
    span = F.struct((F.col("end") - F.col("h.size.n")).alias("start"), "end", (F.col("last") - F.col("h.size.b")).alias("first"), "last")
    found = each.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(F.col("h.ok"), span))).cast(SPAN).alias("spans"))
    return found.union(rows.where(F.size("hits") == 0).select(*key, F.array().cast(SPAN).alias("spans")))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(ledger with the new pairs, versions(doc_id, blob)).

    ``versions(doc_id, text)``: null text is empty. The ledger has a row for each scanned pair:
    blob, kind, version, spans. Rows that repeat, whole or in part, share their blob's one scan: of each blob the text of one version is
    scanned, and where rows repeat that version they are made one beforehand.
    """
    docs = versions.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = stage(docs.select("doc_id", "blob"), "secret-paths")
    named = paths.groupBy("blob", "doc_id").agg(F.count("*").alias("n")).groupBy("blob").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "n")).alias("first"))
    todo = named.select("blob", F.col("first.doc_id").alias("rep"), F.col("first.n").alias("n"))
    every = F.array(*[F.concat_ws(":", F.lit(r.kind), F.lit(r.version)) for r in rules])
    if ledger is None:
        todo = todo.withColumn("open", every)
    else:
        had = ledger.select("blob", F.concat_ws(":", "kind", "version").alias("pair")).groupBy("blob").agg(F.collect_set("pair").alias("had"))
        todo = todo.join(had, "blob", "left").withColumn("open", F.array_except(every, F.coalesce("had", F.array().cast("array<string>")))).drop("had")
        todo = todo.where(F.size("open") > 0)
    todo = todo.withColumnRenamed("blob", "_blob")
    met = docs.join(todo, (docs["blob"] == F.col("_blob")) & docs["doc_id"].eqNullSafe(F.col("rep"))).select("blob", "text", "open", "n")
    new = met.where("n = 1").union(met.where("n > 1").dropDuplicates(["blob"]))
    scans = [
        F.when(F.array_contains("open", f"{r.kind}:{r.version}"), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), rule_hits(F.col("text"), r).alias("hits")))
        for r in rules
    ]
    wide = stage(new.select("blob", F.array_compact(F.array(*scans)).alias("scans")), "secret-scans")
    rows = stage(spans_of(wide.select("blob", F.inline("scans"))), "secret-ledger")
    return (rows if ledger is None else ledger.select(rows.columns).union(rows)), paths


def of_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(_blob, found): all spans of each blob that has any, as (start, kind's place, end, first and last byte) in order."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind}:{r.version}", i)])
    hits = ledger.where(F.size("spans") > 0).withColumn("k", order[F.concat_ws(":", "kind", "version")]).where("k is not null")
    placed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("k").alias("k"), s["end"].alias("end"), s["first"].alias("first"), s["last"].alias("last")))
    return stage(hits.groupBy(F.col("blob").alias("_blob")).agg(F.array_sort(F.flatten(F.collect_list(placed))).alias("found")), "secret-found")


def findings(ledger: DataFrame, paths: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per path version: its blob's spans of each rule as an array ``found`` of (start, kind's place, end, ..).

    Both sides of the join are tables of their own, so that Spark may split a blob that very many paths hold.
    """
    hits = of_blob(ledger, rules)
    none = F.array().cast(hits.schema["found"].dataType)
    return paths.join(hits, paths["blob"] == F.col("_blob"), "left").select("doc_id", "blob", F.coalesce("found", none).alias("found"))


def span_list(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["k"]), s["start"], s["end"])), ",")


def report(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans and all spans, a row per row of ``versions``.

    Null and empty texts have no span: counts 0, the digest of the empty string, spans ''. Equal rows give
    equal rows; an empty table an empty result; further columns are ignored.
    """
    ledger, paths = scan(versions, ledger)
    found = findings(ledger, paths)
    count = lambda k: F.size(F.filter("found", lambda s: s["k"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_list(F.col("found")), 256).alias("base_sha256"), span_list(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by a mark (one for spans that overlap) and n_chars counted anew.

    Rows without spans, null and empty texts are unchanged; every row stays, repeated ones and those without an id
    too; columns may have any name. An empty table gives an empty result.
    """
    ledger, _ = scan(docs)
    blob, own = (free_name(docs, c) for c in ("_blob", "_cuts"))
    spans = of_blob(ledger).select("_blob", F.posexplode("found").alias("i", "s"))
    line = W.partitionBy("_blob").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("clear", F.coalesce(F.max("s.last").over(line), F.lit(0)))  # the byte up to which all is done
    piece = F.when(F.col("s.first") >= F.col("clear"), F.struct(F.col("clear").alias("a"), F.col("s.first").alias("b")))
    cuts = stage(spans.groupBy(F.col("_blob").alias(blob)).agg(F.struct(F.sort_array(F.collect_list(piece)).alias("pieces"), F.max("s.last").alias("end")).alias(own)), "secret-cuts")
    joined = docs.join(cuts, F.sha2(F.coalesce("text", F.lit("")), 256) == F.col(blob), "left")
    # the text's bytes are bound to a variable once, so that each piece costs its own length alone
    bytes_of = F.array(F.col("text").cast("binary"))
    part = lambda raw, c: F.concat(F.substring(raw, c["a"] + 1, c["b"] - c["a"]).cast("string"), F.lit(MARK))
    clean = F.transform(bytes_of, lambda raw: F.concat(F.array_join(F.transform(F.col(f"{own}.pieces"), lambda c: part(raw, c)), ""), F.substring(raw, F.col(f"{own}.end") + 1, F.octet_length(raw)).cast("string")))[0]
    found = F.col(own).isNotNull()
    joined = joined.withColumn("text", F.when(found, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(found, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)


def _oracle() -> str:
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"select doc_id, {i} k, '{r.kind}' kind, m, v, s - l a, s b from (select doc_id, l, v, m, "
            f"sum(l + g) over (partition by doc_id order by i) s from (select doc_id, i, length(ms[i]) l, length(vs[i]) v, length(gs[i]) g, ms[i] m from "
            f"(select doc_id, ms, vs, gs, unnest(range(1, len(ms) + 1)) i from (select doc_id, regexp_extract_all(t, '{p}', 0) ms, regexp_extract_all(t, '{p}', {r.group}) vs, regexp_split_to_array(t, '{p}') gs from d)))) where v >= {r.least}"
        )
    return (
        "with d as (select doc_id, coalesce(text, '') t from documents), hits as (" + " union all ".join(parts) + "), "
        "g as (select doc_id, count(*) filter (k = 0) n_assign, count(*) filter (k = 1) n_access, count(*) filter (k = 2) n_hex, "
        "string_agg(kind || ':' || cast(a as bigint) || ':' || cast(b as bigint), ',' order by a, k) spans from hits group by 1) "
        "select d.doc_id, coalesce(n_assign, 0)::bigint n_assign, coalesce(n_access, 0)::bigint n_access, coalesce(n_hex, 0)::bigint n_hex, "
        "sha256(coalesce(spans, '')) base_sha256, coalesce(spans, '') spans from d left join g using (doc_id)"
    )


ORACLE_SQL = _oracle()
