"""Tables that executors write: bytes, copies, empty keys, and nothing left of a write that fails."""

import os

import pytest
from pyspark.sql import functions as F

from seqloom.sinks import tables as sink


@pytest.fixture
def rows(spark):
    made = spark.range(3000).select(
        F.when(F.col("id") % 7 < 4, "big").when(F.col("id") % 7 == 4, "ü b").when(F.col("id") % 7 == 5, "unwanted").otherwise("other").alias("k"),
        "id", (F.col("id") / 7).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("maybe"), F.array(F.lit("a"), F.col("id").cast("string")).alias("both"),
    )
    return made.repartition(9)


def plain(rows, key, names):
    """The same file by way of the driver."""
    found = sorted((r.asDict() for r in rows.where(F.col("k") == key).collect()), key=lambda r: -r["id"])
    return "\t".join(names) + "\n" + "".join("\t".join(sink.cell(r[n]) for n in names) + "\n" for r in found)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_files_by_key(rows, tmp_path, scheme):
    folder = lambda k: "u_b" if k == "ü b" else k
    at = lambda k: [f"{scheme}{tmp_path}/{folder(k)}/t.tsv"] + ([f"{scheme}{tmp_path}/copies/deep/{k}.tsv"] if k == "big" else [])
    sink.write_tsvs(rows, "k", at, [F.desc("id")], ["big", "ü b", "other", "none"], ["both", "x", "maybe"])
    for k in ("big", "ü b", "other", "none"):
        with open(tmp_path / folder(k) / "t.tsv", encoding="utf-8") as f:
            assert f.read() == plain(rows, k, ["both", "x", "maybe"])
    assert (tmp_path / "copies/deep/big.tsv").read_bytes() == (tmp_path / "big/t.tsv").read_bytes()
    assert sorted(os.listdir(tmp_path)) == ["big", "copies", "none", "other", "u_b"] and all(len(os.listdir(tmp_path / k)) == 1 for k in ("big", "u_b", "other", "none"))
    sink.write_tsv(rows.where("k = 'big'"), f"{scheme}{tmp_path}/one.tsv", [F.desc("id")], ["both", "x", "maybe"])
    assert (tmp_path / "one.tsv").read_bytes() == (tmp_path / "big/t.tsv").read_bytes()


def test_failed_write_leaves_nothing(rows, tmp_path):
    bad = rows.withColumn("x", F.when(F.col("id") == 2990, F.raise_error(F.lit("no"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="no"):
        sink.write_tsvs(bad, "k", lambda k: [f"{tmp_path}/{k}.tsv"], ["id"], ["big", "ü b", "other"], ["x"])
    assert os.listdir(tmp_path) == []


def test_folder(tmp_path):
    for path in (f"{tmp_path}/a/b", f"file://{tmp_path}/c/d"):
        sink.prepare_folder(path, False)
        with pytest.raises(FileExistsError):
            sink.prepare_folder(path, False)
        sink.write_figures(f"{path}/x.tsv", {"n": 1, "f": 0.123456789})
        sink.prepare_folder(path, True)
    assert sorted(os.listdir(tmp_path)) == ["a", "c"] and os.listdir(tmp_path / "a/b") == []
