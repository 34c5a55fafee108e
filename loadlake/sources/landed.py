"""Readers of the landed files: one scan for any number of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from loadlake.operators.catalog import CATALOG_TYPE
from loadlake.operators.curves import CATEGORY_COLUMNS, type_class_curves
from loadlake.sources import delimited

Paths = str | Sequence[str]

# Fields of the published reading and class-curve files.
READING_FIELDS = (
    "cod_areacarga",
    "dat_referencia",
    "din_referenciautc",
    "din_atualizacao",
    "val_cargaglobal",
    "val_cargaglobalsmmg",
    "val_cargaglobalsmmgd",
    "val_cargammgd",
    "val_cargaglobalcons",
    "val_consistencia",
    "val_cargasupervisionada",
    "val_carganaosupervisionada",
)
CLASS_CURVE_FIELDS = (
    "DatGeracaoConjuntoDados",
    "IdeCcs",
    "SigCcs",
    "AnoPrcCal",
    "DscPrcCal",
    "NomSubGrupoTarifario",
    "DscDemandante",
    "DscTipoDia",
    "HorInicial",
    "HorFinal",
    "VlrDmd",
)
MONTHLY_ENERGY_FIELDS = (
    "Data",
    "DataExcel",
    "UF",
    "Regiao",
    "Sistema",
    "Classe",
    "TipoConsumidor",
    "Consumo",
    "Consumidores",
    "DataVersao",
)


def _reader(spark: SparkSession, modified_after: str | None) -> DataFrameReader:
    """A reader that lists only files changed after a UTC time, if one is given."""
    return spark.read if modified_after is None else spark.read.option("modifiedAfter", modified_after)


def _listed(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def literal_path(path: str) -> str:
    """The path of one file, with the characters escaped that a reader would take for a pattern."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


def plain_path(file_path: Column) -> Column:
    """A file's path as the file system has it, from the URL form of ``_metadata.file_path``."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def read_readings(spark: SparkSession, paths: Paths, modified_after: str | None = None) -> DataFrame:
    """Reading files as text fields plus ``file_path`` and ``problem``; see ``parse_readings``.

    A file is read whole by one task, as JSON cannot be split.
    """
    files = _reader(spark, modified_after).text(_listed(paths), wholetext=True)
    return parse_readings(files.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col("value").alias("text")))


def parse_readings(files: DataFrame) -> DataFrame:
    """Records of landed JSON texts (``file_path, text``).

    A text is a list of records, or an object holding them under ``data`` or else ``result``, or one record. Missing
    fields are null. A text that is no JSON, is cut off, or has no records of these fields yields one row with
    ``problem`` and no values, which ``split_rejects`` sets aside.
    """

    def listed(path: str) -> Column:
        return F.try_variant_get("__v", path, "array<variant>")

    parsed = files.withColumn("__v", F.try_parse_json("text"))
    one = [F.try_variant_get("__v", f"$.{f}", "string") for f in READING_FIELDS]
    bare = F.when(F.coalesce(*one).isNotNull(), F.array("__v"))
    records = F.coalesce(listed("$"), listed("$.data"), listed("$.result"), bare)
    problem = F.when(F.col("__v").isNull(), "not readable as JSON").when(records.isNull(), "no reading fields")
    held = F.coalesce(records, F.array(F.lit(None).cast("variant")))
    rows = parsed.select("file_path", problem.alias("problem"), F.explode(held).alias("__r"))
    return rows.select("file_path", "problem", *[F.try_variant_get("__r", f"$.{f}", "string").alias(f) for f in READING_FIELDS])


def read_class_curves(spark: SparkSession, paths: Paths, fields: Sequence[str] = CLASS_CURVE_FIELDS) -> DataFrame:
    """Class-curve files, parquet or delimited text by each file's suffix, with typed demand.

    Paths may be files, folders or patterns, with both kinds of files below them.
    """
    listed = spark.read.format("binaryFile").load(_listed(paths)).select("path")
    files = [r.path for r in listed.orderBy("path").toLocalIterator()]
    parquet = [p for p in files if p.lower().endswith(".parquet")]
    text = [p for p in files if p not in set(parquet)]
    parts = []
    if parquet:
        stored = spark.read.option("mergeSchema", True).parquet(*map(literal_path, parquet))
        parts.append(stored.select(*[_as_text(stored, f) for f in fields]))
    if text:
        parts.append(read_delimited(spark, list(map(literal_path, text)), fields).select(*fields))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return type_class_curves(rows) if set(CATEGORY_COLUMNS) <= set(fields) else rows


def _as_text(df: DataFrame, field: str) -> Column:
    return (F.col(field) if field in df.columns else F.lit(None)).cast("string").alias(field)


def delimited_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """``file_path, line_no, value``: the lines of text files, as bytes that may be no UTF-8."""
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return spark.read.text(_listed(paths)).select(plain_path(F.col("_metadata.file_path")).alias("file_path"), at.alias("line_no"), "value")


def dialects(spark: SparkSession, paths: Paths, fields: Sequence[str] = ()) -> DataFrame:
    """What ``delimited.dialects`` tells of files."""
    return delimited.dialects(delimited_lines(spark, paths), fields)


def read_delimited(spark: SparkSession, paths: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Delimited text files, each in its own dialect and column order, as text ``fields`` plus ``file_path``; see
    ``delimited.parse``. Files without a usable header have no rows; ``undetected_files`` lists them.
    """
    return delimited.parse(delimited_lines(spark, paths), fields).where("problem IS NULL").drop("problem")


def undetected_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files whose first line is no header, with their ``problem``."""
    return dialects(spark, paths).where(F.col("problem").isNotNull()).select("file_path", "problem")


def read_monthly_energy(spark: SparkSession, paths: Paths) -> DataFrame:
    """Monthly-energy files as delimited text, with ``Consumo`` and ``Consumidores`` as numbers."""
    from loadlake.functions.parsing import decimal_comma

    rows = read_delimited(spark, _listed(paths), MONTHLY_ENERGY_FIELDS)
    return rows.withColumns({c: decimal_comma(F.col(c)) for c in ("Consumo", "Consumidores")})


def read_catalog(spark: SparkSession, paths: Paths) -> DataFrame:
    """Landed catalog answers: ``file_path`` and a ``payload`` struct for ``catalog_resources``."""
    inner = CATALOG_TYPE[len("struct<") : -1]
    schema = inner.replace("success:", "success ", 1).replace("result:", "result ", 1)
    files = spark.read.schema(schema).json(_listed(paths), multiLine=True)
    return files.select(
        plain_path(F.col("_metadata.file_path")).alias("file_path"), F.struct("success", "result").alias("payload")
    )


def listed_files(spark: SparkSession, paths: Paths) -> DataFrame:
    """``file_path, file_size, modified_at`` of files, or of those directly in folders; no content is read."""
    files = spark.read.format("binaryFile").load(_listed(paths))
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"))


#: Files of more bytes are fingerprinted by their lines, in pieces; smaller ones whole, each by one task.
LARGE_FILE = 1 << 28


def fingerprints(spark: SparkSession, paths: Paths, modified_after: str | None = None, large: int = LARGE_FILE) -> DataFrame:
    """Fingerprint and size of every file: SHA-256 of its bytes, or for a file of more than ``large`` bytes
    ``lines-<number>-<sum>`` from ``content_mark``, which any number of tasks share and which does not see the order of
    lines. Lines have to be shorter than 2 GB. Empty files are no rows of a scan, and so have none here.
    """
    files = _reader(spark, modified_after).format("binaryFile").load(_listed(paths))
    small = files.where(F.col("length") <= large).select(F.col("path").alias("file_path"), "content")
    long = files.where(F.col("length") > large).select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))
    names = [r.file_path for r in long.select("file_path").orderBy("file_path").toLocalIterator()]
    if not names:
        return fingerprints_of(small)
    lines = spark.read.text(list(map(literal_path, names)))
    marks = content_mark(lines.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), "value"), ["file_path"])
    mark = F.concat_ws("-", F.lit("lines"), F.col("row_count").cast("string"), F.col("content_sum").cast("string"))
    told = long.withColumn("at", F.regexp_replace("file_path", "^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/"))
    told = told.join(marks.select(F.regexp_replace("file_path", "^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/").alias("at"), mark.alias("hash_sha256")), "at", "left")
    empty = F.lit("lines-0-0")
    return fingerprints_of(small).unionByName(told.select("file_path", F.coalesce("hash_sha256", empty).alias("hash_sha256"), "file_size"))


def fingerprints_of(files: DataFrame) -> DataFrame:
    """``file_path, hash_sha256, file_size`` of files with their ``content``."""
    size = F.octet_length("content").cast("long")
    return files.select("file_path", F.sha2("content", 256).alias("hash_sha256"), size.alias("file_size"))


def content_mark(rows: DataFrame, resource: Sequence[str]) -> DataFrame:
    """Fingerprint of a version too large to hash as one file: equal for equal rows in any order.

    60 bits of each row's MD5 are added as decimals, with the row count beside them, so parts merge before the shuffle.
    Nulls are told from empty texts.
    """
    content = [c for c in rows.columns if c not in resource]
    text = F.concat(*[F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in content])
    wide = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(*resource).agg(F.sum(wide).alias("content_sum"), F.count(F.lit(1)).alias("row_count"))


def read_profile(spark: SparkSession, paths: Paths) -> DataFrame:
    """Stored 24-hour profile CSV (``hour``, ``avg_mw`` and whatever else the header names)."""
    files = _listed(paths)
    wanted = ("hour", "avg_mw", "median_mw", "p05_mw", "p95_mw", "normalized_load")
    rows = read_delimited(spark, files, wanted)
    return rows.select(
        "file_path",
        F.col("hour").try_cast("int").alias("hour"),
        *[F.col(c).try_cast("double").alias(c) for c in wanted[1:]],
    )
