"""Published resources: catalog rows, the preferred one, its period, and links found on pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.functions import parsing, urls

CATALOG_TYPE = (
    "struct<success:boolean,result:struct<id:string,name:string,resources:array<struct<"
    "id:string,name:string,format:string,url:string,created:string,last_modified:string,"
    "metadata_modified:string,hash:string,size:bigint,mimetype:string,state:string>>>>"
)
# Order in which formats are preferred.
FORMAT_PREFERENCE = ("parquet", "csv", "json", "xlsx", "gzip", "html")


def catalog_resources(payloads: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """One row per published resource of every catalog answer (a ``CATALOG_TYPE`` struct column).

    Answers without ``success`` yield no rows, see ``failed_payloads``. ``position`` is the listed order.
    """
    answer = F.col(payload)
    listed = payloads.where(answer["success"]).select(
        *keep, answer["result"]["id"].alias("package_id"), F.posexplode(answer["result"]["resources"])
    )
    r = F.col("col")
    return listed.select(
        *keep,
        r["id"].alias("id"),
        F.coalesce(parsing.empty_to_null(r["name"]), r["id"]).alias("name"),
        F.lower(F.coalesce(r["format"], F.lit(""))).alias("format"),
        r["url"].alias("url"),
        r["created"].alias("created"),
        r["last_modified"].alias("last_modified"),
        r["metadata_modified"].alias("metadata_modified"),
        parsing.empty_to_null(r["hash"]).alias("hash"),
        r["size"].alias("size"),
        r["mimetype"].alias("mimetype"),
        r["state"].alias("state"),
        "package_id",
        F.col("pos").alias("position"),
    )


def failed_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Catalog answers that report no success or could not be read."""
    return payloads.where(~F.coalesce(F.col(payload)["success"], F.lit(False)))


def recency(resource: Sequence[str] = ("metadata_modified", "last_modified", "created")) -> Column:
    """First of the three dates that is there, else empty; ISO text sorts by time."""
    return F.coalesce(*[parsing.empty_to_null(F.col(c)) for c in resource], F.lit(""))


def preferred_resources(
    resources: DataFrame,
    group: Sequence[str] = (),
    preference: Sequence[str] = FORMAT_PREFERENCE,
    name_contains: str | None = None,
) -> DataFrame:
    """Per group: best format, then most recent, then first listed. Needs ``position``."""
    wanted = resources
    if name_contains is not None:
        wanted = wanted.where(F.contains(F.lower("name"), F.lit(name_contains.lower())))
    listed = F.array(*[F.lit(f) for f in preference])
    rank = F.coalesce(F.nullif(F.array_position(listed, F.col("format")), F.lit(0)), F.lit(len(preference) + 1))
    best = F.struct((-rank).alias("rank"), recency().alias("recency"), (-F.col("position")).alias("position"))
    rest = [c for c in resources.columns if c not in group]
    picked = wanted.groupBy(*group).agg(F.max_by(F.struct(*rest), best).alias("__r"))
    return picked.where(F.col("__r").isNotNull()).select(*group, "__r.*").select(*resources.columns)


def newest_first(resources: DataFrame) -> DataFrame:
    """All resources, the most recent first."""
    return resources.orderBy(recency().desc(), "position")


def with_reference_period(resources: DataFrame, name: str = "name") -> DataFrame:
    return resources.withColumn("reference_period", parsing.reference_period(F.col(name)))


def in_period_window(
    resources: DataFrame, start: str | None = None, end: str | None = None, period: str = "reference_period"
) -> DataFrame:
    """Resources whose period lies in ``[start, end]``; an unknown period is kept."""
    known = F.col(period)
    outside = F.lit(False)
    if start:
        outside = outside | (known < start)
    if end:
        outside = outside | (known > end)
    return resources.where(~F.coalesce(outside, F.lit(False)))


def page_links(pages: DataFrame, extensions: Sequence[str], url: str = "url", html: str = "html") -> DataFrame:
    """``(…, link_position, link)``: absolute links of a page that end with one of ``extensions``."""
    others = [c for c in pages.columns if c != html]
    found = pages.select(*others, F.posexplode(urls.hrefs_ending_with(F.col(html), extensions)))
    return found.select(
        *others, F.col("pos").alias("link_position"), urls.absolute_url(F.col(url), F.col("col")).alias("link")
    )


def current_links(
    pages: DataFrame,
    extensions: Sequence[str],
    fallback: Column,
    prefix: str = "epe-",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Per page the first matching link, else ``fallback``, with the resource id derived from the URL."""
    others = [c for c in pages.columns if c != html]
    first = F.get(urls.hrefs_ending_with(F.col(html), extensions), F.lit(0))
    found = pages.select(*others, first.alias("__href"))
    resolved = F.when(F.col("__href").isNotNull(), urls.absolute_url(F.col(url), F.col("__href"))).otherwise(fallback)
    return found.select(
        *others, resolved.alias("download_url"), F.col("__href").isNull().alias("used_fallback")
    ).withColumn("resource_id", resource_id_of_url(F.col("download_url"), prefix))


def resource_id_of_url(url: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(url), 1, 16))
