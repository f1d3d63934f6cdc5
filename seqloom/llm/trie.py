"""Conversation prefix trie: how often beginnings of conversations are shared, rolled up in depth bands.

A node is a distinct sequence of first turns. Turns are hashed with their position, and a prefix is the sum of its turns'
hashes in four lanes of 32 bits, so one window over the small hashed rows names the prefixes of a conversation of any length; its parent's name is the sum
less the last turn. Nodes are then counted by partial aggregation: the root or a first turn that all conversations share never meets in one task.

Subtree totals. Depths are cut into bands of fixed height. A node with something to count is exploded to its ancestors within its band only,
found as the prefixes of its smallest member there. From the deepest band upwards the completed totals of a band's top nodes are
exploded once more to their ancestors in the band above. So a node makes at most one row for each depth of a band, and there are as many
rounds as bands; the height is ``HEIGHT``, or the root of the greatest depth where that is more.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seqloom.llm.common import salted_join, stage

HEIGHT = 64
SPAN, MOST_SHARED = 20, 4  # conversations of one base; fewer than so many of its turns are shared
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "k1", "k2"]
CHUNK = 1 << 17  # ids that one string holds
_LOW = 0xFFFFFFFF


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, role, digest, words) of every rebuilt turn, and (conv, turns) of every conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), F.md5(text).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    place = F.row_number().over(W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")).cast("long")
    turns = stage(rows.select("conv", place.alias("depth"), "role", "digest", "words"), "trie-turns")
    shared = F.crc32(F.col("conv").cast("string")) % MOST_SHARED
    convs = turns.groupBy("conv").agg(F.count("*").alias("n")).select("conv", "n", shared.alias("h"), (F.col("conv") - F.col("conv") % SPAN).alias("base"))
    heads = turns.where((F.col("conv") % SPAN == 0) & (F.col("depth") < MOST_SHARED)).withColumnRenamed("conv", "base")
    lengths = heads.groupBy("base").agg(F.count("*").alias("given"))
    convs = convs.join(lengths, "base", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0))))
    convs = stage(convs.select("conv", "base", "h", "given", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), "trie-convs")
    own = turns.join(convs, "conv").where(F.col("depth") > F.col("h")).withColumn("depth", F.col("depth") - F.col("h") + F.col("given"))
    first = convs.join(heads, "base").where(F.col("depth") <= F.col("h"))
    names = ["conv", "depth", "turns", "role", "digest", "words"]
    return own.select(*names).union(first.select(*names)), convs.select("conv", "turns")


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, words, last) of every conversation and depth, 0 included: names of prefix and parent."""
    hashed = turns.select("*", *[F.xxhash64(F.lit(seed), "depth", "role", "digest").alias(f"x{seed}") for seed in (1, 2)])
    high, low = (lambda c: F.shiftrightunsigned(c, 32)), (lambda c: F.col(c).bitwiseAND(F.lit(_LOW)))
    upto = W.partitionBy("conv").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    lanes = {f"{side}{k}": F.sum(f(f"x{k}")).over(upto) for k in (1, 2) for side, f in (("a", high), ("b", low))}
    pack = lambda a, b: F.shiftleft(a.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(b.bitwiseAND(F.lit(_LOW)))
    summed = hashed.withColumns(lanes)
    name = [pack(F.col(f"a{k}"), F.col(f"b{k}")).alias(f"k{k}") for k in (1, 2)]
    up = [pack(F.col(f"a{k}") - high(f"x{k}"), F.col(f"b{k}") - low(f"x{k}")).alias(f"p{k}") for k in (1, 2)]
    below = summed.select("conv", "depth", *name, *up, "words", (F.col("depth") == F.col("turns")).alias("last"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    return convs.select("conv", zero, zero, zero, none, none, zero, F.col("turns") == 0).union(below).toDF(*below.columns)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order of node and id, as comma-joined strings of one node each."""
    for batch in batches:
        cols = [batch.column(k).to_numpy() for k in range(4)]
        conv = cols[3]
        new = np.zeros(len(conv), bool)
        new[::CHUNK] = True
        for c in cols[:3]:
            new[1:] |= c[1:] != c[:-1]
        at = np.flatnonzero(new)
        joined = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(conv)], strict=True)]
        yield pa.RecordBatch.from_arrays([*[pa.array(c[at]) for c in cols], pa.array(joined, pa.string())], [*KEY, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's strings, which come one after the other; nothing but the running digest is kept."""
    key, digest = None, None
    for batch in batches:
        out = []
        for *k, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"]), strict=True):
            if k != key:
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _table(out)
    if key:
        yield _table([(*key, digest.hexdigest())])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], [*KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame, height: int | None = None) -> DataFrame:
    """A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows of ``conversations(conv_id, turn, role, text)`` without a conv_id belong to no conversation and are left out. Turns are ordered, null first;
    rows with one turn number follow role and the text's MD5, and repeated rows are turns of their own. Null roles and texts are empty, and such turns count
    as turns. Further columns are ignored; an empty table has no node, not even a root.
    """
    rows = stage(_prefixes(*_rebuilt(conversations)), "trie-prefixes")
    nodes = rows.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = stage(nodes, "trie-counts")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = stage(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    height = height or max(HEIGHT, math.isqrt(deepest) + 1)
    band = F.floor(F.col("depth") / height).alias("band")
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    above = rows.select("conv", band, *[F.col(c).alias(f"_{c}") for c in KEY])
    back = [F.col(f"_{c}").alias(c) for c in KEY]
    counted = nodes.select("conv", "depth", band, (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    inside = counted.where("leaves > 0 or saved > 0").join(above, ["conv", "band"]).where("_depth <= depth").groupBy(*back).agg(*sums)
    inside = stage(nodes.select(*KEY, "conv").join(inside, KEY, "left").na.fill(0, ["leaves", "saved"]), "trie-bands")
    extra: list[DataFrame] = []
    for k in range(deepest // height, 0, -1):
        tops = inside.where(F.col("depth") == k * height)
        if extra:
            tops = tops.unionByName(extra[-1].where(F.col("depth") == k * height).join(tops.select(*KEY, "conv"), KEY)).groupBy("conv").agg(*sums)
        lifted = tops.select("conv", "leaves", "saved").join(above.where(F.col("band") == k - 1), "conv").groupBy(*back).agg(*sums)
        extra.append(stage(lifted, "trie-lifted"))
    total = reduce(DataFrame.unionByName, extra, inside.drop("conv")).groupBy(*KEY).agg(*sums)
    ended = rows.where("last").select(*KEY, "conv")
    strings = ended.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(_strings, "depth long, k1 long, k2 long, first long, ids string")
    digests = strings.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"), "n_children")
    linked = salted_join(nodes.where("depth > 0").select(*KEY, "p1", "p2"), parents, ["depth", "p1", "p2"], "n_children").select(*KEY, "parent_conv_id")
    result = nodes.join(total, KEY).join(linked, KEY, "left").join(digests, KEY, "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return result.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )


ORACLE_SQL = """with shift as (select list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t),
ordered as (select conv_id c, coalesce(role, '') role, coalesce(text, '') text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) pos from conversations where conv_id is not null),
convs as (select c, c - c % 20 base, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda s: ascii(s)::bigint)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 h
from (select distinct c from ordered), shift),
own as (select o.c, role, text, pos - h + least(h, (select count(*) from ordered b where b.c = base)) depth from ordered o join convs using (c) where pos > h),
turns as (select * from own union all select convs.c, role, text, pos from convs join ordered o on o.c = base where pos <= h),
named as (select c, depth, md5(string_agg(md5(role) || md5(text), '' order by depth) over (partition by c order by depth)) k, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::bigint words from turns),
paths as (select c, depth, k, words from named union all select c, 0, '', 0 from convs),
length as (select c, max(depth) depth from paths group by 1),
nodes as (select depth, k, min(c) c, count(*) n_convs, max(words) words from paths group by 1, 2),
ups as (select n.depth, n.k, p.k up from nodes n left join paths p on p.c = n.c and p.depth = n.depth - 1),
kids as (select depth - 1 depth, up k, count(*) n from ups where depth > 0 group by 1, 2),
full_ as (select nodes.*, ups.up, coalesce(kids.n, 0) n_children from nodes join ups using (depth, k) left join kids using (depth, k)),
sums as (select p.depth, p.k, sum((n_children = 0)::bigint)::bigint n_leaves, sum((n_convs - 1) * f.words)::bigint saved_tokens from full_ f join paths p on p.c = f.c and p.depth <= f.depth group by 1, 2),
ends as (select depth, k, string_agg(c::varchar, ',' order by c) ids from paths join length using (c, depth) group by 1, 2)
select f.c::bigint conv_id, f.depth::bigint depth, p.c::bigint parent_conv_id, f.n_convs::bigint n_convs, f.n_children::bigint n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) ends_sha256
from full_ f join sums using (depth, k) left join ends using (depth, k) left join nodes p on p.depth = f.depth - 1 and p.k = f.up"""
