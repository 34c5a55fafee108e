"""Small helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of an Arrow batch on its way to a Python worker. Both sides hold some copies of a batch, the JVM outside its heap; by
#: rows alone (10,000) a batch grows with the texts.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: ASCII white space, ``[\x20\x09-\x0D]``.
BLANKS = b" \t\n\v\f\r"


def struct(**kinds: T.DataType) -> T.StructType:
    """A struct type that needs no session, unlike one given as text."""
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, as their functions run there."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    home = Path(__file__).resolve().parent
    package = home.parent
    target = Path(tempfile.mkdtemp(prefix="modules-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in [package / "__init__.py", package / "session.py", *sorted(home.glob("*.py"))]:
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context._llm_shipped = True


def shipping(function: Callable) -> Callable:
    """For functions that take the session first: makes sure that executors have the modules, and bounds Arrow batches."""

    @functools.wraps(function)
    def run(spark: SparkSession, *args):
        ship(spark)
        spark.conf.set(_BATCH, str(BATCH_BYTES))
        return function(spark, *args)

    return run


def give_back() -> None:
    """At a Python task's end: return free memory to the system. Spark keeps idle workers, and each would go on holding it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def collect_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage once its heap has grown past half of its limit.

    An operator of many small jobs leaves plans, compiled code and broadcast tables behind; the JVM would rather take its
    whole heap from the system than collect them, and frees broadcasts on all machines only when it does.
    """
    jvm = spark.sparkContext._jvm
    heap = jvm.java.lang.Runtime.getRuntime()
    if 2 * heap.totalMemory() > heap.maxMemory():
        gc.collect()  # what Python still refers to is no garbage
        jvm.java.lang.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; without one a temporary one, on one machine only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder, so that later jobs and lost executors reread them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


class Tables:
    """Tables that one operator writes to the shared folder and deletes as soon as they are used up.

    Lost executors reread them; the shuffles behind a written table are freed at once.
    """

    _FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.home = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
        self.kept: list[tuple[DataFrame, str]] = []
        self.written = 0

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.home}/{self.written}"
        self.written += 1
        before = self.spark.conf.get(self._FREED, "false")
        self.spark.conf.set(self._FREED, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(self._FREED, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.kept.append((table, path))
        collect_driver(self.spark)
        return table

    def drop(self, *tables: DataFrame) -> None:
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        for table, path in self.kept:
            if any(table is t for t in tables):
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(context.hadoopConfiguration()).delete(place, True)
        self.kept = [(t, p) for t, p in self.kept if not any(t is x for x in tables)]


FILTER_BITS_PER_ID = 16
MAX_FILTER_BITS = 1 << 28


def id_filter(ids: DataFrame, name: str, max_bits: int = MAX_FILTER_BITS) -> Callable[[Column], Column]:
    """A condition that holds for all the ids of a column and for few others, from a broadcast Bloom filter.

    The filter has 16 bits an id and at most ``max_bits`` (32 MB); a fuller one only lets more others through, so an exact
    join has to follow.
    """
    spark = ids.sparkSession
    n = ids.count()
    bits = 1 << 12
    while bits < min(n * FILTER_BITS_PER_ID, max_bits):
        bits *= 2
    hashed = F.xxhash64(name)
    probes = F.array(*[F.shiftrightunsigned(hashed, 18 * k).bitwiseAND(F.lit(bits - 1)) for k in range(3)])
    cells = ids.select(F.explode(probes).alias("bit")).select(F.expr("bit div 32").alias("cell"), F.expr("shiftleft(1, cast(bit % 32 AS int))").alias("bits"))
    found = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 32, np.uint32)
    words[found.column("cell").to_numpy()] = found.column("bits").to_numpy().astype(np.int64).astype(np.uint32)
    sent = spark.sparkContext.broadcast(words)

    @F.pandas_udf(T.BooleanType())
    def seems_in(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hashes in batches:
            h = hashes.to_numpy().view(np.uint64)
            own = np.ones(len(h), bool)
            for k in range(3):
                bit = ((h >> np.uint64(18 * k)) & np.uint64(bits - 1)).astype(np.int64)
                own &= sent.value[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1) == 1
            yield pd.Series(own)
        give_back()

    return lambda column: seems_in(F.xxhash64(column))


def split_join(rows: DataFrame, keyed: DataFrame, on: str, weight: str, parts: int = 1000) -> DataFrame:
    """Inner join of many rows to a table with one row per key, in which ``weight`` counts the key's rows.

    A key with more than 1/``parts`` of all rows is hot; there are fewer than ``parts`` of them, so these few are
    broadcast and their rows stay where they are. The other keys are joined by shuffle. Without hot keys there is one join,
    and so there is with fewer than ``parts`` rows in all.
    Both inputs are read more than once: pass stored ones.
    """
    told = keyed.agg(F.sum(weight).alias("total"), F.max(weight).alias("top")).first()
    limit = (told.total or 0) // parts
    if not limit or told.top <= limit:
        return rows.join(keyed if limit else F.broadcast(keyed), on)
    hot = keyed.where(F.col(weight) > limit)
    rest = keyed.where(F.col(weight) <= limit)
    few = rows.join(F.broadcast(hot), on)
    many = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(rest, on)
    return few.unionByName(many)
