"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quire.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql(data):
    connection = duckdb.connect()
    for t in TABLES:
        path = f"{data}/{t}.parquet"
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return connection


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return round(float(v), 9) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(name, spark, data, sql):
    df = catalogue.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    assert got
    assert name in catalogue.SQL
    if name in catalogue.SQL:
        found = sql.execute(catalogue.SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        want = sorted(repr(tuple(plain(row[names.index(c)]) for c in columns)) for row in found.fetchall())
        assert got == want


def test_chk_merge_on_headings_and_empty_texts(spark, tmp_path):
    texts = ["a\na\na", "# x\n# y\n# z", "", "  ", None, "# x\n# x\n\n# x", "a\na\nb\na"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in catalogue.QUERIES["chk_merge"](spark, str(tmp_path)).collect())
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(connection.execute(catalogue.SQL["chk_merge"]).fetchall()) == [(i, "consecutive_duplicate_detected") for i in (0, 5)]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_partitions_change_nothing(spark, data):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(str, catalogue.QUERIES["set_overlap_dedup"](spark, data).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]
