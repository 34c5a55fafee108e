"""Every registered query against its SQL, and against itself with other numbers of partitions."""

import pathlib
import sys

import pytest

import __spark_entry__ as entry
from loadlake.plans import workload

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(pathlib.Path(entry.__file__).parent / "tools"))
from check_oracles import rows_of  # noqa: E402

FOLDER = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def result(spark, name):
    df = entry.queries()[name](spark, str(FOLDER))
    return df.columns, rows_of(df.columns, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_same_rows_as_sql(spark, db, name):
    columns, rows = result(spark, name)
    cursor = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(names)
    assert rows == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", ["latest_readings", "profile_all_grains", "revisions", "gated_ledger", "overlay_summary", "price_quantiles"])
def test_same_rows_with_other_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = result(spark, name)
        spark.conf.set("spark.sql.shuffle.partitions", "29")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert result(spark, name) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
