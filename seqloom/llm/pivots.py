"""Embedding near-duplicates by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots), seeded random directions. An inverted list per label and pivot holds the vectors near that pivot; two vectors are retrieved if they
share at least ``SHARED`` pivots, counted in the list of the smallest pivot they share, and are then verified by
cosine in double precision. A list longer than ``block`` is cut into blocks that meet pairwise.

The index is fitted on a bounded sample (``SAMPLE`` vectors of a dimension; every row is indexed). Vectors that have a direction in common, as text embeddings do, would all be near the same pivots, so
they may be described less the mean of their label's sample. Whether they are, how many pivots there are (up to ``MOST_PIVOTS``, by the root of the number of vectors) and how many
of them describe a vector is what costs the fewest pairs on the sample while no pair of the sample that links is missed, and at most one in a thousand made ones at exactly the least
cosine. If nothing does better than that, all pairs of a label meet, so no data cost more than all pairs.

Equal vectors of a label form a class first and count by their number. Lists return link counts and a
spanning forest of the links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import components, free_name, stage

COSINE = 0.93
SHARED, BLOCK, MOST_PIVOTS = 2, 2048, 8192
PREFIXES = (8, 12, 16, 24, 32, 48, 64)
SAMPLE, TRIALS, OWN_MEAN = 4096, 2000, 32  # vectors of a sample; pairs of each kind that are tried; vectors that a label's own mean takes
MISSES = 1000  # one in so many made pairs at the least cosine may be missed, and none that the sample holds


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    scale = np.abs(m).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    m = m / scale
    return m / np.sqrt((m * m).sum(1, keepdims=True))


@dataclass
class Fit:
    """How vectors of one dimension are described: less their label's mean (or ``mean``), by their ``prefix`` nearest ``points``."""

    points: np.ndarray
    prefix: int
    means: dict[str, np.ndarray]
    mean: np.ndarray
    cost: float = 1.0  # pairs that meet, of all pairs of the sample with one label

    def less_mean(self, unit: np.ndarray, labels: list[str]) -> np.ndarray:
        if not len(unit) or not self.mean.any() and not self.means:
            return unit
        names = sorted(set(labels))
        offsets = np.array([self.means.get(n, self.mean) for n in names])
        place = {n: i for i, n in enumerate(names)}
        rest = unit - offsets[[place[x] for x in labels]]
        flat = np.abs(rest).max(1) < 1e-9  # a vector that is the mean
        rest[flat] = unit[flat]
        return _unit(rest)

    def nearest(self, unit: np.ndarray, labels: list[str]) -> np.ndarray:
        return _nearest(self.less_mean(unit, labels), self.points, self.prefix)


def _nearest(unit: np.ndarray, points: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest points of each row, nearest first."""
    out = []
    for k in range(0, max(len(unit), 1), 1024):
        near = unit[k : k + 1024].astype(np.float32) @ points.T
        if prefix < len(points):
            some = np.argpartition(-near, prefix, axis=1)[:, :prefix]
            by = np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable")
            out.append(np.take_along_axis(some, by, 1))
        else:
            out.append(np.argsort(-near, axis=1, kind="stable"))
    return np.concatenate(out).astype(np.int32)


def _linked_pairs(unit: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Some pairs of the sample that link."""
    a, b = [], []
    for name in np.unique(labels):
        at = np.flatnonzero(labels == name)
        for k in range(0, len(at), 512):
            x, y = np.nonzero(unit[at[k : k + 512]] @ unit[at].T >= COSINE)
            new = x + k < y
            a.append(at[x[new] + k])
            b.append(at[y[new]])
    a, b = np.concatenate(a), np.concatenate(b)
    some = rng.permutation(len(a))[:TRIALS]
    return a[some], b[some]


def fit(labels: list[str], vectors: np.ndarray, total: int) -> Fit:
    """The description for ``total`` vectors of one dimension, of which a bounded sample is given."""
    dimension = vectors.shape[1]
    rng = np.random.default_rng([5, dimension])
    unit, names = _unit(vectors), np.array(labels)
    zero = np.zeros(dimension)
    every = Fit(_unit(np.ones((1, dimension))).astype(np.float32), 1, {}, zero)
    want = min(MOST_PIVOTS, max(64, 1 << math.ceil(math.log2(16 * math.sqrt(total)))))
    points = _unit(rng.standard_normal((want, dimension))).astype(np.float32)
    own = {n: unit[names == n].mean(0) for n in np.unique(names) if (names == n).sum() >= OWN_MEAN}
    i, j = _linked_pairs(unit, names, rng)
    x = rng.integers(len(unit), size=TRIALS)
    aside = rng.standard_normal((TRIALS, dimension))
    if len(unit) > 2:  # half of the made pairs lie in the data's own directions
        half = TRIALS // 2
        aside[:half] = unit[rng.integers(len(unit), size=half)] - unit[rng.integers(len(unit), size=half)]
    aside -= (aside * unit[x]).sum(1, keepdims=True) * unit[x]
    real = np.abs(aside).max(1) > 1e-9
    x = x[real]
    made = COSINE * unit[x] + math.sqrt(1 - COSINE * COSINE) * _unit(aside[real])
    _, place = np.unique(names, return_inverse=True)
    pairs = (np.bincount(place).astype(float) ** 2).sum()
    best = every
    for means, mean in (({}, zero), (own, unit.mean(0))):
        this = Fit(points, 1, means, mean)
        rest, y, with_label = this.less_mean(unit, labels), made, x
        if mean.any() or means:  # only made vectors as far from the mean as the data are
            offsets = np.array([means.get(n, mean) for n in labels])
            far, made_far = np.linalg.norm(unit - offsets, axis=1), np.linalg.norm(made - offsets[x], axis=1)
            usual = made_far <= far.max() * 1.05
            y, with_label = made[usual], x[usual]
            if len(y) + len(i) < TRIALS // 4:
                continue
        y = this.less_mean(y, names[with_label].tolist())
        most = want
        while most >= 64:
            near, near_y = (_nearest(v, points[:most], min(PREFIXES[-1], most)) for v in (rest, y))
            for prefix in [k for k in PREFIXES if k < most]:
                size = np.bincount((place[:, None] * most + near[:, :prefix]).ravel()).astype(float)
                cost = (size**2).sum() / pairs
                if cost >= best.cost:
                    break
                if not _missed(near[:, :prefix], near[:, :prefix], i, j) and _missed(near[:, :prefix], near_y[:, :prefix], with_label, np.arange(len(y))) * MISSES <= len(y):
                    best = Fit(points[:most], prefix, means, mean, cost)
                    break
            most //= 2
    return best


def _missed(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> int:
    """How many of the pairs of rows i of ``a`` and j of ``b`` share fewer than SHARED pivots."""
    return sum(int(((a[i[k : k + 256]][:, :, None] == b[j[k : k + 256]][:, None, :]).any(2).sum(1) < SHARED).sum()) for k in range(0, len(i), 256))


def _indexer(fits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size = fits.value
        for batch in batches:
            size = np.array([len(v) for v in batch.column(3).to_pylist()])
            for n in np.unique(size):
                part = batch.filter(pa.array(size == n))
                top = by_size[int(n)].nearest(_unit(_matrix(part.column(3))), part.column(0).to_pylist())
                k = top.shape[1]
                own = np.repeat(np.arange(part.num_rows), k)
                take = pa.array(own)
                perm = pa.ListArray.from_arrays(pa.array(np.arange(0, len(own) + 1, k, dtype=np.int32)), pa.array(top.ravel())).take(take)
                yield pa.RecordBatch.from_arrays([*[c.take(take) for c in part.columns], perm, pa.array(top.ravel())], [*part.schema.names, "perm", "pivot"])

    return run


def _verified(ok: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the retrieved pairs those at the least cosine; few are looked at one by one."""
    if ok.sum() * 20 > ok.size:
        return ok & (x @ y.T >= COSINE)
    a, b = np.nonzero(ok)
    ok = np.zeros_like(ok)
    for k in range(0, len(a), 1 << 14):
        p, q = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
        ok[p, q] = np.einsum("ij,ij->i", x[p], y[q]) >= COSINE
    return ok


def _links(key, table):
    """Links inside one list, or between two blocks of it: (node, links, root) of its vectors."""
    pivot, bi, bj = key[1].as_py(), key[3].as_py(), key[4].as_py()
    ids, weight, block = (table.column(c).to_numpy() for c in ("node", "weight", "block"))
    unit = _unit(_matrix(table.column("v")))
    perm = np.array(table.column("perm").to_pylist())
    names, at = np.unique(perm, return_inverse=True)
    hot = np.zeros((len(ids), len(names)), np.float32)
    np.put_along_axis(hot, at.reshape(perm.shape), 1, axis=1)
    x, y = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
    least = min(SHARED, perm.shape[1])
    ok = hot[x] @ hot[y].T >= least
    ok &= hot[x][:, names < pivot] @ hot[y][:, names < pivot].T == 0
    ok &= ids[x][:, None] != ids[y][None, :]
    ok = _verified(ok, unit[x], unit[y])
    links = np.zeros(len(ids), np.int64)
    links[x] += ok @ weight[y]
    if bi != bj:
        links[y] += ok.T @ weight[x]
    root = np.arange(len(ids))
    while True:
        before = root.copy()
        root[x] = np.minimum(root[x], np.where(ok, root[y][None, :], len(ids)).min(1, initial=len(ids)))
        root[y] = np.minimum(root[y], np.where(ok, root[x][:, None], len(ids)).min(0, initial=len(ids)))
        if (before == root).all():
            break
    some = links > 0
    return pa.table({"node": pa.array(ids[some]), "links": pa.array(links[some]), "root": pa.array(ids[root[some]])})


def near_vectors(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors(vec_id, embedding, label)``.

    Vectors that are null, empty, zero or hold null or non-finite components, and those without a label,
    link with nothing; so do vectors of different lengths with each other. vec_id identifies a row: rows that
    repeat one share its result. Further columns are ignored; empty input gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding", "label")
    plain = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    good = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", plain) & F.exists("embedding", lambda x: x != 0)
    keyed = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    keyed = keyed.withColumns({"k1": F.xxhash64("embedding"), "k2": F.hash("embedding")})
    member = stage(keyed.select("vec_id", "label", "good", "k1", "k2").distinct(), "pivot-members")
    key = ["label", "k1", "k2"]
    classes = member.where("good").groupBy(*key).agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    reps = keyed.where("good").join(classes, (keyed["vec_id"] == classes["node"]) & (keyed["k1"] == classes["k1"]) & (keyed["k2"] == classes["k2"]))
    reps = reps.select(keyed["label"].cast("string").alias("label"), "node", "weight", F.col("embedding").cast("array<double>").alias("v")).dropDuplicates(["label", "node"])
    reps = stage(reps, "pivot-classes")
    fits = {}
    for r in reps.groupBy(F.size("v").alias("n")).count().collect():
        some = reps.where(F.size("v") == r["n"]).orderBy(F.xxhash64(F.lit(11), "node"), "label", "node").limit(SAMPLE).select("label", "v").collect()
        fits[r["n"]] = fit([x["label"] for x in some], np.array([x["v"] for x in some], float), r["count"])
    lists = reps.mapInArrow(_indexer(spark.sparkContext.broadcast(fits)), "label string, node long, weight long, v array<double>, perm array<int>, pivot int")
    lists = stage(lists.withColumn("n", F.size("v")), "pivot-lists")
    lens = lists.groupBy("label", "pivot", "n").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    lists = lists.join(lens, ["label", "pivot", "n"]).withColumn("block", F.pmod(F.xxhash64(F.lit(9), "node"), F.col("blocks")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("bi"), F.greatest("block", j).alias("bj")))
    lists = lists.select("*", F.inline(meet))
    found = lists.groupBy("label", "pivot", "n", "bi", "bj").applyInArrow(_links, "node long, links long, root long")
    found = stage(found, "pivot-links")
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_class = classes.join(total, "node", "left").join(parts, "node", "left")
    of_class = of_class.select(*[F.col(k).alias(f"_{k}") for k in key], (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component_id", "node").alias("component"))
    same = member["good"] & (member["label"] == F.col("_label")) & (member["k1"] == F.col("_k1")) & (member["k2"] == F.col("_k2"))
    result = member.join(of_class, same, "left").groupBy("vec_id").agg(F.max(F.coalesce("links", F.lit(0))).alias("n_links"), F.min(F.coalesce("component", "vec_id")).alias("component_id"))
    return result.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def drop_near_vectors(vectors: DataFrame) -> DataFrame:
    """The rows of ``vectors`` whose vec_id is the smallest of its component.

    Vectors that link with nothing stay, null ones too; rows that repeat an id stay or go together, rows without an id stay. Columns may have any name; an
    empty table gives an empty result.
    """
    key = free_name(vectors, "_id")
    gone = near_vectors(vectors).where("not kept").select(F.col("vec_id").alias(key))
    return vectors.join(gone, vectors["vec_id"] == F.col(key), "left_anti")
