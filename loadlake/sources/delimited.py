"""Delimited text, parsed inside one plan whatever the number of files, headers, separators and encodings.

The only thing that is resolved per file is a small row: its separator, its encoding and where its header has the wanted
fields. Lines meet that row by a join, so neither headers nor file names come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATORS = (";", ",", "\t")
#: A first line of more characters is no header: such a file is rejected.
MAX_HEADER = 1 << 16
NO_SEPARATOR = "no separator in the first line"
LONG_HEADER = "first line too long for a header"


def cells(line: Column, separator: Column) -> Column:
    """The raw cells of a record, quotes included."""
    by = [
        F.when(separator == s, F.regexp_extract_all(line, F.lit(f'(?:^|{s})("(?:[^"]++|"")*+"[^{s}]*+|[^{s}]*+)'), F.lit(1))) for s in SEPARATORS
    ]
    return F.coalesce(*by)


def unquoted(cell: Column) -> Column:
    """A cell's value: null if nothing is there, without the quotes around it, and with doubled ones single."""
    plain = F.endswith(cell, F.lit('"')) & (F.length(cell) > 1)  # no need to look for the last quote
    inner = F.when(plain, F.substring(cell, F.lit(2), F.length(cell) - 2)).otherwise(F.regexp_extract(cell, '(?s)^"(.*)"', 1))
    return F.when(cell == "", None).when(F.startswith(cell, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)


def dialects(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per ``file_path``: ``separator``, ``is_utf8``, ``has_breaks`` (a quoted value may hold a line break), ``places`` of the
    fields in the header (0: not there), ``first`` line number, and ``problem`` of a file that has no usable header.

    The separator is the first of ``;``, ``,`` and tab that the first line has. It is not the most frequent one: decimal
    commas would mislead that.
    """
    line = F.col("value")
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    seen = lines.groupBy("file_path").agg(
        F.min("line_no").alias("first"),
        F.min_by(F.substring(line, 1, MAX_HEADER + 1), "line_no").alias("header"),
        F.every(F.is_valid_utf8(line)).alias("is_utf8"),
        F.bool_or(odd).alias("has_breaks"),
    )
    header = F.regexp_replace(decoded(F.col("header"), F.col("is_utf8")), "^\ufeff", "")
    separator = F.coalesce(*[F.when(F.contains(F.col("header"), F.lit(s)), F.lit(s)) for s in SEPARATORS])
    seen = seen.withColumn("header", header).withColumn("separator", separator)
    names = F.transform(cells(F.col("header"), F.col("separator")), lambda c: F.trim(unquoted(c)))
    problem = F.when(F.length("header") > MAX_HEADER, LONG_HEADER).when(F.col("separator").isNull(), NO_SEPARATOR)
    seen = seen.withColumn("problem", problem).withColumn("names", F.when(F.col("problem").isNull(), names))
    places = F.array(*[F.coalesce(F.array_position("names", f), F.lit(0)) for f in fields])
    return seen.select("file_path", "first", "separator", "is_utf8", "has_breaks", places.alias("places"), "problem")


def decoded(value: Column, is_utf8: Column) -> Column:
    return F.when(is_utf8, value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))


def parse(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``file_path, problem`` and the text ``fields`` of delimited lines (``file_path, line_no, value``).

    ``line_no`` orders a file's lines. Only a file's first line is its header, blank lines are no rows, missing columns are
    null, columns not asked for and surplus values are dropped. A file without a usable header is one row with its
    ``problem``. Lines of files in which a quoted value may hold a line break are put together in one task per file.
    """
    known = dialects(lines, fields)

    def met(files: DataFrame) -> DataFrame:
        return lines.join(files, "file_path").where(F.col("problem").isNull() & (F.col("line_no") != F.col("first")))

    whole = met(known.where(~F.col("has_breaks"))).select("file_path", "value", "separator", "is_utf8", "places")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    before = Window.partitionBy("file_path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum(quotes % 2).over(before), F.lit(0)) % 2
    # Moved as a step of its own (by one more column, or Spark takes that for needless): where no file has breaks, adaptive
    # execution sees it and does not read and sort the lines for this branch.
    broken = met(known.where("has_breaks").repartition("file_path", "first")).withColumn("opens", F.when(opened == 0, 1).otherwise(0))
    broken = broken.withColumn("record", F.sum("opens").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"]), "\n")
    merged = broken.groupBy("file_path", "record").agg(
        joined.alias("value"), *[F.first(c).alias(c) for c in ("separator", "is_utf8", "places")]
    )
    every = whole.unionByName(merged.drop("record"))
    every = every.select("file_path", "places", "separator", decoded(F.col("value"), F.col("is_utf8")).alias("line"))
    # Blank lines go after the join: a condition that Spark could push below it would build each line again, and keep the
    # two joins from sharing one exchange of the lines.
    cut = every.where(F.trim("line") != "").select("file_path", "places", cells(F.col("line"), F.col("separator")).alias("cells"))

    def value(i: int) -> Column:
        place = F.col("places")[i].cast("int")
        return F.when(place > 0, unquoted(F.get("cells", place - 1)))

    rows = cut.select("file_path", F.lit(None).cast("string").alias("problem"), *[value(i).alias(f) for i, f in enumerate(fields)])
    bad = known.where(F.col("problem").isNotNull()).select("file_path", "problem", *[F.lit(None).cast("string").alias(f) for f in fields])
    return rows.unionByName(bad)
