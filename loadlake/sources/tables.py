"""Stored tables of the lake: metadata ledgers, products and reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

LAYERS = ("raw", "bronze", "silver", "gold", "metadata", "quarantine")


def layer_path(root: str, layer: str, *names: str) -> str:
    """Path of a table in one of the lake's layers."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    return "/".join([root.rstrip("/"), layer, *names])


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet table at ``path``, or an empty one when nothing is stored there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, by: Sequence[str] = ("year", "month"), whole: bool = False
) -> None:
    """Write a product by ``by``, replacing only the partitions ``df`` has rows of, or with ``whole`` all of them.

    Rows of a partition are gathered (AQE splits a large one over tasks), so it becomes few files.
    """
    placed = df.hint("rebalance", *[F.col(c) for c in by])
    placed.sortWithinPartitions(*by).write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic").partitionBy(
        *by
    ).parquet(path)


def write_report(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """CSV with a header, sorted. The sort is distributed; small reports end up in one file by themselves."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def write_product(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_files(files: DataFrame, folder: str) -> int:
    """One file per row: its ``text``, at its ``path`` below a folder. Returns the number of files.

    Spark's own writer names files itself; a folder for each, its commit and its listing cost far more than a small file.
    Tasks write the files with pyarrow, under a hidden name first, so that a file that is there is whole, and a task that
    runs again puts the same files. The folder has to be on a file system that pyarrow knows.
    """
    spark = files.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    home = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()

    def write(batches: Iterator) -> Iterator:
        from uuid import uuid4

        import pyarrow as pa
        from pyarrow import fs

        local = home.startswith("file:/")
        store, root = (fs.LocalFileSystem(), "/" + home[5:].lstrip("/")) if local else fs.FileSystem.from_uri(home)
        there = set()
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
                at, name = f"{root}/{path}".rsplit("/", 1)
                if at not in there:
                    store.create_dir(at, recursive=True)
                    there.add(at)
                part = f"{at}/.{name}-{uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(text.encode())
                store.move(part, f"{at}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return files.select("path", "text").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column]) -> dict[str, object]:
    """Overwrite a table and return aggregates of the rows written, from the pass that writes them."""
    seen = Observation()
    df.observe(seen, *[m.alias(name) for name, m in metrics.items()]).write.mode("overwrite").parquet(path)
    return seen.get


def write_ordered(df: DataFrame, path: str, by: str) -> None:
    """A table whose files hold ranges of ``by`` that follow one another, each sorted; its bounds beside it.

    The ranges are dealt by a sample of the column, so that files are of about equal size whatever its distribution; equal
    values are in one file only if they are fewer than a file's rows, else they are dealt by the rest of the row.
    """
    rest = [c for c in df.columns if c != by]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that small ranges are not put together
    placed = df.repartitionByRange(parts, F.col(by), F.xxhash64(*rest)).sortWithinPartitions(by)
    placed.write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    bounds = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file_name"))
    bounds = bounds.agg(F.min(by).alias("low"), F.max(by).alias("high"), F.count(F.lit(1)).alias("n_rows"))
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{path}_bounds")


def read_between(spark: SparkSession, path: str, by: str, low: object, high: object) -> DataFrame:
    """Rows of an ordered table with ``by`` from ``low`` to ``high``; only files whose bounds reach into it are opened."""
    bounds = spark.read.parquet(f"{path}_bounds").where((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
    files = [f"{path}/{r.file_name}" for r in bounds.orderBy("low", "file_name").toLocalIterator()]
    whole = spark.read.schema(spark.read.parquet(path).schema)
    rows = whole.parquet(*files) if files else spark.createDataFrame([], spark.read.parquet(path).schema)
    return rows.where(F.col(by).between(F.lit(low), F.lit(high)))
