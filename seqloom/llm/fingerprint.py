"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions only.

A paragraph (line) is hashed to a wide vector: four lanes of its own 32-bit hashes, and 256 lanes in which each pair
of neighbouring words of the paragraph counts +1 or -1 by a bit of the pair's hashes. A document's
fingerprint is the sum of its paragraphs' vectors modulo powers of two. It doesn't depend on their order, and
paragraphs are inserted or deleted by adding or subtracting their vectors. The first lanes tell equality;
the cosine of the others estimates how much of two texts is alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.llm.common import stage

HASHES = 4
FIELD = 16
LANES = HASHES * 64
PART_BITS = 15
STRONG = 4
STRONG_MOD = 1 << 32
LANE_MOD = 1 << 20
_STRONG_COLS = [f"s{i}" for i in range(STRONG)]


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def strong_lanes(text: Column) -> list[Column]:
    """Sums of the paragraphs' 32-bit hashes modulo 2**32."""
    lanes = []
    for seed in range(STRONG // 2):
        hashes = F.transform(paragraphs(text), lambda p: F.xxhash64(F.lit(seed), p))  # noqa: B023
        for shift in (0, 32):
            lanes.append(F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: acc + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(STRONG_MOD - 1)), lambda acc: F.pmod(acc, F.lit(STRONG_MOD))))  # noqa: B023
    return lanes


def pair_hashes(text: Column) -> Column:
    """Hashes of all neighbouring words of each paragraph; its first word is paired with nothing."""
    words = lambda p: F.filter(F.split(p, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    pairs = lambda ws: F.transform(ws, lambda w, i: F.xxhash64(F.lit(7), F.get(ws, i - 1), w))
    return F.flatten(F.transform(F.transform(paragraphs(text), words), pairs))


def with_lanes(texts: DataFrame, keys: list[str], text: str, carried: list[str]) -> DataFrame:
    """keys, carried, s0..s3 and ``lanes`` of each row's text; no two rows have equal keys.

    A sum holds four lanes of FIELD bits, so PART pairs of words are added up before they could run into each other; the parts
    of a longer text are added lane by lane. ``carried`` are numbers, so that pairs are hashed to their sums and not sorted.
    """
    none = F.array(F.lit(None).cast("long"))
    strong = [c.alias(n) for c, n in zip(strong_lanes(F.col(text)), _STRONG_COLS, strict=True)]
    wide = texts.select(*keys, *carried, *strong, F.concat(none, pair_hashes(F.col(text))).alias("units"))  # below the explode, so once a text
    rows = wide.select(*keys, *carried, *_STRONG_COLS, F.posexplode_outer("units").alias("pos", "h"))  # outer: no filter that computes the units again
    hashed = rows.select(*keys, *carried, *_STRONG_COLS, F.shiftright("pos", PART_BITS).alias("_part"), F.col("h").isNotNull().alias("_some"), *[F.xxhash64(F.lit(k), "h").alias(f"h{k}") for k in range(HASHES)])
    field = F.lit(sum(1 << FIELD * i for i in range(4)))
    packed = [F.sum(F.when(F.col("_some"), F.shiftrightunsigned(f"h{k}", j).bitwiseAND(field)).otherwise(F.lit(0).cast("long"))).alias(f"b{k}_{j}") for k in range(HASHES) for j in range(FIELD)]
    sums = hashed.groupBy(*keys, "_part").agg(*packed, F.count_if("_some").alias("n"), *[F.max(c).alias(c) for c in [*carried, *_STRONG_COLS]])
    ones = lambda s, i: F.shiftrightunsigned(s, FIELD * i).bitwiseAND(F.lit((1 << FIELD) - 1))
    counts = F.flatten(F.transform(F.array(*[f"b{k}_{j}" for k in range(HASHES) for j in range(FIELD)]), lambda s: F.array(*[ones(s, i) for i in range(4)])))
    parts = sums.select(*keys, *carried, *_STRONG_COLS, F.struct("n", counts.alias("c")).alias("p")).groupBy(*keys).agg(F.collect_list("p").alias("p"), *[F.max(c).alias(c) for c in [*carried, *_STRONG_COLS]])
    lane_sums = lambda ps: F.aggregate(F.slice(ps, 2, F.size(ps)), ps[0]["c"], lambda acc, x: F.zip_with(acc, x["c"], lambda u, v: u + v))
    pairs = F.aggregate("p", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    lanes = F.transform(F.array(F.struct(lane_sums(F.col("p")).alias("c"), pairs.alias("n"))), lambda x: F.transform(x["c"], lambda v: wrapped(2 * v - x["n"])))[0]
    return parts.select(*keys, *carried, *_STRONG_COLS, lanes.alias("lanes"))


def wrapped(x: Column) -> Column:
    """Modulo LANE_MOD, between -LANE_MOD / 2 and LANE_MOD / 2."""
    return (F.pmod(x + LANE_MOD // 2, F.lit(LANE_MOD)) - LANE_MOD // 2).cast("int")


def as_text(strong: list[Column], lanes: Column) -> Column:
    """Fixed-width hexadecimal form of a fingerprint."""
    head = [F.lpad(F.hex(s), 8, "0") for s in strong]
    return F.lower(F.concat(*head, F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(F.pmod(x, F.lit(LANE_MOD)).cast("long")), 5, "0")), "")))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of two texts put together (sign 1), or of a without b (sign -1)."""
    return F.zip_with(a, b, lambda x, y: wrapped(x + sign * y))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two lane vectors above what chance gives unlike texts (one over the root of the number of lanes); vectors of empty texts are alike only to each other."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda acc, v: acc + v)
    size, chance = F.sqrt(dot(a, a) * dot(b, b)), 1 / math.sqrt(LANES)
    return F.when(a == b, F.lit(1.0)).when(size == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (dot(a, b) / size - chance) / (1 - chance))))


LAST = 2**63 - 1  # key of rows without an id


def with_next(keys: DataFrame) -> DataFrame:
    """keys(doc, hash, ..) with next_doc and next_hash by ascending doc, then hash; the first follows the last.

    Keys alone are ordered: dealt by range to the session's shuffle partitions, so by their number and not by how ids are spread, and followed up inside each. What
    joins the partitions is the first key of each.
    """
    spark = keys.sparkSession
    dealt = keys.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc", "hash")
    dealt = stage(dealt.withColumn("cell", F.spark_partition_id()), "fingerprint-order")
    pair = F.struct(F.col("doc").alias("i"), F.col("hash").alias("h"))
    every = W.partitionBy(F.lit(0)).orderBy("cell")  # one row a partition
    heads = dealt.groupBy("cell").agg(F.min(pair).alias("head"))
    after = heads.select("cell", F.coalesce(F.lead("head").over(every), F.first("head").over(every)).alias("after"))
    following = F.coalesce(F.lead(pair).over(W.partitionBy("cell").orderBy("doc", "hash")), F.col("after"))
    out = dealt.join(after, "cell").withColumn("_next", following).drop("cell", "after")
    return out.withColumns({"next_doc": F.col("_next.i"), "next_hash": F.col("_next.h")}).drop("_next")


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` and of its edited text, and their likeness.

    Null texts are empty. Rows that repeat doc_id and text are one document with equal result rows; rows that share a doc_id
    with other texts follow each other by hash. A row without an id is edited with nothing and is near no
    next document. Further columns are ignored; empty input gives an empty result.

    The texts are shuffled once, by their key; each document asks its next one for as many characters as it loses, and gets those alone.
    """
    text, unnamed = F.coalesce("text", F.lit("")), F.col("doc_id").isNull()
    mark = F.xxhash64(text).bitwiseAND(F.lit(-2).cast("long")).bitwiseOR(unnamed.cast("long"))  # the last bit says that there is no id
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), mark.alias("hash"), text.alias("text"))
    key = ["doc", "hash"]
    keys = stage(docs.groupBy(*key).agg(F.count("*").alias("times"), F.max(F.length("text")).alias("n_chars")), "fingerprint-keys")
    if not keys.where("times > 1").isEmpty():
        docs = docs.dropDuplicates(key)
    named, none = F.col("hash").bitwiseAND(F.lit(1).cast("long")) == 0, F.lit(None).cast("long")
    order = with_next(keys.where(named)).unionByName(keys.where(~named).withColumns({"next_doc": none, "next_hash": none}))
    order = stage(order.withColumns({"n_chars": F.col("n_chars").cast("long"), "k": F.expr("n_chars div 4").cast("int")}), "fingerprint-next")
    asked = order.where("next_doc is not null and k > 0").select(F.col("next_doc").alias("doc"), F.col("next_hash").alias("hash"), F.col("doc").alias("to_doc"), F.col("hash").alias("to_hash"), "k")
    given = docs.join(asked.hint("shuffle_hash"), key).select(F.col("to_doc").alias("doc"), F.col("to_hash").alias("hash"), F.left("text", F.col("k")).alias("given"))
    pairs = docs.join(order.hint("shuffle_hash"), key).join(given.hint("shuffle_hash"), key, "left")
    pairs = pairs.withColumn("edited", F.concat(F.left("text", F.col("n_chars").cast("int") - F.col("k")), F.coalesce("given", F.lit(""))))
    about = ["times", "next_doc", "next_hash", "n_chars"]
    both = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"))))
    rows = pairs.withColumn("edited_sha256", F.sha2("edited", 256)).select(*key, "edited_sha256", *about, both.alias("x")).select("*", "x.which", F.col("x.t").alias("t"))
    prints = with_lanes(rows, [*key, "edited_sha256", "which"], "t", about)
    prints = prints.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("which", "edited_sha256", *about, *_STRONG_COLS, "lanes"))).alias("two"))
    own = F.col("two")[0]
    prints = prints.select(*key, *[own[c].alias(c) for c in ("edited_sha256", *about)], own.alias("own"), F.col("two")[1].alias("edited"))
    prints = stage(prints.withColumn("near_edited", likeness(F.col("own.lanes"), F.col("edited.lanes"))), "fingerprints")
    after = prints.where(named).select(F.col("doc").alias("_doc"), F.col("hash").alias("_hash"), F.col("own.lanes").alias("_next"))
    joined = prints.join(after, (F.col("next_doc") == F.col("_doc")) & (F.col("next_hash") == F.col("_hash")), "left")
    near_next = F.coalesce(likeness(F.col("own.lanes"), F.col("_next")), F.lit(0.0))
    shown = lambda c: as_text([F.col(f"{c}.{s}") for s in _STRONG_COLS], F.col(f"{c}.lanes"))
    out = joined.select(
        F.when(named, F.col("doc")).alias("doc_id"), "n_chars", "edited_sha256", shown("own").alias("fingerprint"), shown("edited").alias("edited_fingerprint"),
        "near_edited", near_next.alias("near_next"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))),
    )
    return out.drop("col")
