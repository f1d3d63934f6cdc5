import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.operators import anchors, library
from seqloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    r = duck.execute(catalogue.ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(e[i] for i in at) for e in r.fetchall()), key=str)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)


@given(st.text("ACGTN", max_size=60))
@settings(max_examples=50)
def test_reverse_complement_twice(s):
    assert anchors.reverse_complement(anchors.reverse_complement(s)) == s


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_scalars(spark):
    L = F.lit
    assert one(spark, S.safe_name(L("a b/c.")), S.safe_name(L("..")), S.pct(L(1), L(0)), S.hamming(L("ACG"), L("ACGTT"))) == ("a_b_c", "sample", None, 5)
    assert one(spark, S.header_index(L("@x 1:N:0:ACGT-ACGT")), S.header_index(L("@x")), S.header_index(L("@x 1:N:0:ACG"))) == ("ACGT+ACGT", None, None)
    assert one(spark, S.index_distance(L("ACGT+AA"), L("ACGA+AA")), S.index_distance(L("ACGT"), L("ACGT+AA"))) == (1, 999)
    assert one(spark, S.kmer_windows(L("ACGTACGTA"), 4, 3), S.kmer_windows(L("AC"), 4)) == (["ACGT", "TACG", "CGTA"], [])
    assert one(spark, S.bounded_levenshtein(L("abc"), L("abd"), 1), S.bounded_levenshtein(L("abc"), L("xyz"), 1)) == (1, 2)
    assert one(spark, S.normalize_dna(L("ac-g u")), S.phred_values(L("!I "))) == ("ACGT", [0, 40, 0])


def test_metrics_without_reads_or_variance(spark):
    full = spark.createDataFrame([("s", i, 1, 80, 50.0, 0, 0, 0) for i in range(4)], "sample string, ref_index int, n_ids long, length int, gc double, exact long, near long, total long")
    r = library.library_metrics(full).first()
    assert r["gini"] is None and r["effective_library_size"] is None and r["spearman_gc_logcount"] is None and r["coverage_cv"] is None and r["dropout_sequences"] == 4


def test_rollups_are_sums(spark):
    rows = spark.createDataFrame([("a", False), ("a", False), ("u", True)], "sample string, und boolean")
    got = {r["sample"]: r["count"] for r in library.with_rollups(rows, F.col("und")).groupBy("sample").count().collect()}
    assert got == {"a": 2, "u": 1, library.ASSIGNED: 2, library.EVERYTHING: 3}
