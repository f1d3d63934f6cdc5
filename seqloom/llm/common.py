"""Helpers that the training-data operators share.

* ``stage``: write an intermediate result to the folder all executors share and read it back.
* ``components``: connected components of a (possibly skewed) edge list.
* byte-level helpers for Arrow string columns: texts stay one flat NumPy array per slice.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one NumPy step works on; bounds a Python worker's memory and stays near the caches.
SLICE_BYTES = 1 << 19


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where a local session names none (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/seqloom-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added the first such name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, how: str = "inner", share: int = 1000) -> DataFrame:
    """``left`` joined with ``right``, whose non-null ``keys`` are unique and have ``weight`` rows each in ``left``.

    Keys with over one in ``share`` of the rows are dealt to several tasks by salts. Fewer than ``share`` keys are so, hence the
    broadcast list of their hashes is bounded. ``right`` is read more than once. The join is a merge at every size, so what is shuffled grows with the input.
    """
    hash_, salts, salt = (free_name(left.join(right, keys), c) for c in ("_hash", "_salts", "_salt"))
    least = max(1, (right.agg(F.sum(weight)).first()[0] or 0) // share)
    named = F.xxhash64(*keys).alias(hash_)
    hot = right.where(F.col(weight) > least).groupBy(named).agg(F.ceil(F.max(weight) / least).cast("int").alias(salts))
    dealt = left.select("*", named).join(F.broadcast(hot), hash_, "left").withColumn(salt, F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col(salts)), F.lit(0)).cast("int"))
    copied = right.select("*", named).join(F.broadcast(hot), hash_, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)))
    return dealt.drop(hash_, salts).join(copied.drop(hash_, salts).hint("merge"), [*keys, salt], how).drop(salt)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component_id): the smallest node each node of ``edges(a, b)`` reaches.

    Every round hooks each node to the neighbour of least seeded hash and contracts the edges, so
    chains and stars alike shrink by a constant factor a round whatever order their ids have; nodes without
    edges left take no further part. All grouping is by partial aggregation: a node with very many edges
    never meets in one task. Nulls and self loops are ignored; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null and a <> b")
    edges = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        if len(hooks) == max_rounds:
            raise RuntimeError("components did not settle")
        both = edges.union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(hooks)), c).alias("h"), c.alias("v"))
        hook = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m")).select(F.col("a").alias("old"), F.least(F.col("m"), rank(F.col("a")))["v"].alias("new"))
        hook = stage(hook, "cc-hook")
        hooks.append(hook)
        left = edges.join(hook, edges["a"] == hook["old"]).select(F.col("new").alias("a"), "b")
        edges = left.join(hook, left["b"] == hook["old"]).select("a", F.col("new").alias("b")).where("a <> b")
        edges = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    if not hooks:
        return spark.createDataFrame([], "node long, component_id long")
    roots = hooks[-1]
    for hook in hooks[-2::-1]:
        later = roots.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
        roots = hook.join(later, hook["new"] == F.col("_old"), "left").select("old", F.coalesce("_new", "new").alias("new"))
    roots = stage(roots.select(F.col("old").alias("node"), F.col("new").alias("label")), "cc-roots")
    least = roots.groupBy("label").agg(F.min("node").alias("component_id"))
    return roots.join(least, "label").select("node", "component_id")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into row ranges of about ``limit`` bytes: (first row, end row, bytes, offsets from 0).

    Null texts are empty. A single longer text makes a slice of its own.
    """
    array = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_large_string(array.type) or pa.types.is_string_view(array.type):
        array = array.cast(pa.string())
    if array.null_count:
        array = array.fill_null("")
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int32)
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None and array.buffers()[2].size else np.zeros(0, np.uint8)
    i = 0
    while i < len(array):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, len(array))
        yield i, j, data[offsets[i] : offsets[j]], (offsets[i : j + 1] - offsets[i]).astype(np.int64)
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: xor-shift and odd multipliers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(seed: int) -> np.ndarray:
    """256 seeded 64-bit values, one for each byte."""
    return mix64(np.arange(256, dtype=np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64))


def powers(base: int, n: int, _cache: dict = {}) -> np.ndarray:  # noqa: B006
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _cache.get(base)
    if have is None or len(have) < n:
        size = max(n, 1024)
        have = np.ones(size, np.uint64)
        have[1:] = np.uint64(base)
        have = np.cumprod(have)
        if size <= 4 << 20:
            _cache[base] = have
    return have[:n]
