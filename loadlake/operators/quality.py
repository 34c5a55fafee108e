"""Quality checks: one row per (resource, check).

Every check yields ``check_name, passed, severity, details, rows_affected`` after the resource's columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.numeric import ratio
from loadlake.operators.keys import join_null_safe, with_previous

OUTCOME = ("check_name", "passed", "severity", "details", "rows_affected")
# Fixed value: scales a median absolute deviation to a standard deviation.
MAD_SCALE = 0.6745


def outcome(name: str, severity: str, passed: Column, details: Column, rows: Column | None = None) -> Column:
    affected = F.lit(None) if rows is None else rows
    return F.struct(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        F.lit(severity).alias("severity"),
        details.alias("details"),
        affected.cast("long").alias("rows_affected"),
    )


def table_checks(
    df: DataFrame,
    resource: Sequence[str],
    *,
    min_rows: int = 1,
    key: Sequence[str] = (),
    required: Sequence[str] = (),
    value: str | None = None,
    allow_negative: bool = False,
    date: str | None = None,
    hour: str | None = None,
    expected_end: Column | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """not_empty, duplicates, unexpected_nulls, negative_values, missing_hours and completeness_window.

    Checks whose columns are not named are left out; named columns that do not exist are skipped, except
    that ``negative_values`` then reports "not applicable". ``expected`` lists the resources that must be
    there; one without rows fails ``not_empty``.

    All counts come from one aggregation. Its distinct key count makes Spark merge equal keys before the
    rows meet per resource, so a resource with most of the rows is counted in parallel. The hours of a date
    are bits of one number, merged in the same way.
    """
    resource = list(resource)
    required = [c for c in required if c in df.columns]
    aggregates = [F.count(F.lit(1)).alias("__n")]
    if key:
        aggregates.append(F.count_distinct(F.struct(*key)).alias("__keys"))
    aggregates += [F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in required]
    negatives = value is not None and value in df.columns and not allow_negative
    if negatives:
        aggregates.append(F.count_if(F.col(value) < 0).alias("__negative"))
    if date is not None and expected_end is not None:
        aggregates.append(F.max(date).alias("__last"))
    counted = df.groupBy(*resource).agg(*aggregates)

    if date is not None and hour is not None:
        per_date = df.groupBy(*resource, date).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1), F.col(hour).cast("int"))).alias("__hours")
        )
        full = F.bit_count(F.coalesce(F.col("__hours"), F.lit(0)))
        short = per_date.groupBy(*resource).agg(F.count_if(full < 24).alias("__short_dates"))
        counted = join_null_safe(counted, short, resource, "left")
    if expected is not None:
        counted = join_null_safe(expected.select(*resource).distinct(), counted, resource, "left")

    n = F.coalesce(F.col("__n"), F.lit(0))
    cells = [
        outcome("not_empty", "error", n >= min_rows, F.format_string(f"%d rows, at least {min_rows} expected", n), n)
    ]
    if key:
        extra = F.coalesce(F.col("__n") - F.col("__keys"), F.lit(0))
        text = F.format_string(f"%d rows repeat the key {', '.join(key)}", extra)
        cells.append(outcome("duplicates", "error", extra == 0, text, extra))
    if required:
        nulls = [F.coalesce(F.col(f"__null_{c}"), F.lit(0)) for c in required]
        total = nulls[0]
        for x in nulls[1:]:
            total = total + x
        text = F.concat_ws(", ", *[F.format_string(f"{c}=%d", x) for c, x in zip(required, nulls, strict=True)])
        cells.append(outcome("unexpected_nulls", "error", total == 0, text, total))
    if negatives:
        below = F.coalesce(F.col("__negative"), F.lit(0))
        text = F.format_string(f"%d negative values in {value}", below)
        cells.append(outcome("negative_values", "warning", below == 0, text, below))
    elif value is not None:
        cells.append(outcome("negative_values", "warning", F.lit(True), F.lit("not applicable")))
    if date is not None and hour is not None:
        short_dates = F.coalesce(F.col("__short_dates"), F.lit(0))
        text = F.format_string("%d dates with fewer than 24 hours", short_dates)
        cells.append(outcome("missing_hours", "warning", short_dates == 0, text, short_dates))
    if date is not None and expected_end is not None:
        last = F.col("__last")
        reached = F.coalesce(last >= F.date_sub(expected_end, 1), F.lit(False))
        text = F.when(last.isNull(), F.lit("no dates")).otherwise(
            F.concat(F.lit("last date "), last.cast("string"), F.lit(", expected up to "), expected_end.cast("string"))
        )
        cells.append(outcome("completeness_window", "error", reached, text))
    return counted.select(*resource, F.inline(F.array(*cells)))


def schema_checks(columns: DataFrame, resource: Sequence[str], expected: Sequence[str]) -> DataFrame:
    """``columns`` has one row per resource and ``column_name``. Missing columns fail, extra ones are noted."""
    wanted = F.array(*[F.lit(c) for c in expected])
    found = columns.groupBy(*resource).agg(F.collect_set("column_name").alias("__found"))
    missing = F.array_sort(F.array_except(wanted, F.col("__found")))
    extra = F.array_sort(F.array_except(F.col("__found"), wanted))
    text = F.when((F.size(missing) == 0) & (F.size(extra) == 0), F.lit("as expected")).otherwise(
        F.concat(
            F.lit("missing: "), F.array_join(missing, ", "), F.lit("; extra: "), F.array_join(extra, ", ")
        )
    )
    return found.select(*resource, F.inline(F.array(outcome("schema", "error", F.size(missing) == 0, text))))


def coverage_regression(
    versions: DataFrame, resource: Sequence[str], order: Sequence[str], block: Column, max_date: str = "max_date"
) -> DataFrame:
    """Per version: its last date must not lie before that of the version before; nothing to compare passes."""
    chained = with_previous(versions, resource, order, [max_date], block)
    now, before = F.col(max_date), F.col(f"previous_{max_date}")
    comparable = now.isNotNull() & before.isNotNull()
    text = F.when(
        comparable, F.concat(F.lit("now up to "), now.cast("string"), F.lit(", before up to "), before.cast("string"))
    ).otherwise("nothing to compare with")
    passed = F.coalesce(now >= before, F.lit(True))
    return chained.select(
        *resource, *order, F.inline(F.array(outcome("coverage_regression", "error", passed, text)))
    )


def row_count_anomaly(
    versions: DataFrame,
    resource: Sequence[str],
    order: Sequence[str],
    row_count: str = "row_count",
    threshold: float = 3.0,
) -> DataFrame:
    """Newest version's row count against its earlier versions, by a score of median and absolute deviation.

    Fewer than three earlier versions pass. With no deviation at all, only the median itself passes.
    Medians are exact. A resource has one row per version, which is sorted in one task; sorting spills.
    """
    resource = list(resource)
    x, current = F.col("__x"), F.col("__current")
    # One placement by resource: its newest version first, the medians of the others from their place in sorted order.
    newest_first = Window.partitionBy(*resource).orderBy(*[F.desc(c) for c in order])
    placed = versions.select(*resource, *order, F.col(row_count).alias("__x")).withColumn("__back", F.row_number().over(newest_first))
    own = Window.partitionBy(*resource, F.col("__back") > 1)
    whole = Window.partitionBy(*resource)
    known = F.count("__x").over(own)

    def middle(value: str) -> Column:
        """Midpoint median of a column over the earlier versions, on every row of the resource."""
        at = F.row_number().over(own.orderBy(F.col(value).asc_nulls_last())) - 1
        half = (known - 1) / 2
        among = (F.col("__back") > 1) & ((at == F.floor(half)) | (at == F.ceil(half)))
        return F.when(among, F.col(value))

    centred = placed.withColumn("__middle", middle("__x")).withColumn("__median", F.avg("__middle").over(whole))
    spread = centred.withColumn("__d", F.abs(x - F.col("__median"))).withColumn("__spread", middle("__d"))
    judged = spread.groupBy(*resource).agg(
        F.max(F.when(F.col("__back") == 1, x)).alias("__current"),
        (F.count(F.lit(1)) - 1).alias("__history"),
        F.max("__median").alias("__median"),
        F.avg("__spread").alias("__mad"),
    )

    score = ratio(F.lit(MAD_SCALE) * (current - F.col("__median")), F.col("__mad"))
    passed = (
        F.when(F.col("__history") < 3, F.lit(True))
        .when(F.col("__mad") == 0, F.col("__current") == F.col("__median"))
        .otherwise(F.abs(score) <= threshold)
    )
    text = F.when(F.col("__history") < 3, F.lit("too little history")).otherwise(
        F.concat(
            F.format_string("rows %d, median ", F.col("__current")),
            F.col("__median").cast("string"),
            F.lit(", deviation "),
            F.col("__mad").cast("string"),
        )
    )
    return judged.select(
        *resource,
        F.col("__current").alias("row_count"),
        F.when(F.col("__history") >= 3, F.col("__median")).alias("median_row_count"),
        F.when(F.col("__history") >= 3, F.col("__mad")).alias("mad_row_count"),
        F.when(F.col("__history") >= 3, score).alias("score"),
        F.inline(F.array(outcome("row_count_anomaly", "warning", passed, text))),
    )


def energy_error_pct(load: Column, energy: Column, hours: Column) -> Column:
    """Percent by which energy misses load times hours; null where that product is zero or unknown."""
    expected = load * hours
    return ratio(F.abs(energy - expected) * 100, F.abs(expected))


def energy_matches_power(load: Column, energy: Column, hours: Column, tolerance_pct: float = 1.0) -> Column:
    """An expected energy of zero needs an energy of zero."""
    close = energy_error_pct(load, energy, hours) <= tolerance_pct
    return F.when(load * hours == 0, energy == 0).otherwise(close)


def energy_power_consistency(
    df: DataFrame,
    resource: Sequence[str],
    load: str = "load_hourly_mw",
    energy: str = "energy_hourly_mwh",
    hours: Column | None = None,
    tolerance_pct: float = 1.0,
) -> DataFrame:
    """Rows whose energy differs from load times hours by more than the tolerance; unknown loads are skipped."""
    h = F.lit(1.0) if hours is None else hours
    fits = energy_matches_power(F.col(load), F.col(energy), h, tolerance_pct)
    counted = df.groupBy(*resource).agg(F.count_if(~fits).alias("__off"), F.count(fits).alias("__n"))
    text = F.format_string(f"%d of %d rows off by more than {tolerance_pct} %%", F.col("__off"), F.col("__n"))
    return counted.select(
        *resource,
        F.inline(
            F.array(outcome("energy_power_consistency", "warning", F.col("__off") == 0, text, F.col("__off")))
        ),
    )


def allowed_values(df: DataFrame, resource: Sequence[str], column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is outside its enumeration; null is ``unexpected_nulls``' business."""
    counted = df.groupBy(*resource).agg(F.count_if(~F.col(column).isin(list(allowed))).alias("__off"))
    text = F.format_string(f"%d rows with an unknown {column}", F.col("__off"))
    return counted.select(
        *resource, F.inline(F.array(outcome("allowed_values", "error", F.col("__off") == 0, text, F.col("__off"))))
    )
