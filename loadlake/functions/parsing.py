"""Text-to-value expressions for the landed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as they appear in published resource names.
PORTUGUESE_MONTHS = (
    ("janeiro", 1),
    ("fevereiro", 2),
    ("marco", 3),
    ("abril", 4),
    ("maio", 5),
    ("junho", 6),
    ("julho", 7),
    ("agosto", 8),
    ("setembro", 9),
    ("outubro", 10),
    ("novembro", 11),
    ("dezembro", 12),
)

# The two ways a resource name states its period.
NUMERIC_PERIOD = r"(20\d{2})[-_/]?(0[1-9]|1[0-2])"
NAMED_PERIOD = (
    r"(?i)(janeiro|fevereiro|mar[cçÇ]o|abril|maio|junho|julho|agosto|setembro|outubro|novembro|dezembro)"
    r"[\s_/-]*(?:de)?[\s_/-]*(20\d{2})"
)

# Digits only: the JVM's own parser would also take "1d" and "1f".
DECIMAL_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def decimal_comma(text: Column) -> Column:
    """Text with a decimal comma or point to double; anything else is null."""
    pointed = F.regexp_replace(text.cast("string"), "^([^,]*),", "$1.")
    return F.when(pointed.rlike(DECIMAL_NUMBER), pointed.try_cast("double"))


def clock_hour(text: Column) -> Column:
    """Hour of an ``HH:MM[:SS]`` text, null when it is not one."""
    return F.split(text.cast("string"), ":").getItem(0).try_cast("int")


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def reference_period(name: Column) -> Column:
    """``YYYY-MM`` stated in a resource name: digits first, then a month name; null when neither is there."""
    digits = F.regexp_replace(F.regexp_substr(name, F.lit(NUMERIC_PERIOD)), r"^(\d{4})\D?(\d{2})$", "$1-$2")
    month_of = F.create_map(*[F.lit(x) for word, number in PORTUGUESE_MONTHS for x in (word, f"{number:02d}")])
    stated = F.regexp_substr(name, F.lit(NAMED_PERIOD))
    word = F.translate(F.lower(F.regexp_extract(stated, NAMED_PERIOD, 1)), "ç", "c")
    return F.coalesce(digits, F.concat(F.right(stated, F.lit(4)), F.lit("-"), F.try_element_at(month_of, word)))
