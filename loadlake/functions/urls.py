"""Anchors of an HTML text and absolute URLs, as expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content an HTML parser would not see as anchors.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
# Whole tags first, then the attributes inside one. Repeated groups are possessive, which Java's matcher runs as a loop:
# a tag of any length neither overflows the stack nor is read twice.
_ANCHOR = r"""(?is)<a\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTE = r"""(?is)([^\s=>"'/]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def anchor_hrefs(html: Column) -> Column:
    """Array of the href values of ``<a>`` tags, in page order, quotes removed and ``&amp;`` decoded."""
    tags = F.regexp_extract_all(F.regexp_replace(html, _HIDDEN, ""), F.lit(_ANCHOR), F.lit(0))

    def href(tag: Column) -> Column:
        inside = F.substring(tag, F.lit(3), F.length(tag) - 3)
        names = F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(1))
        values = F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(2))
        own = F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda a: (F.lower(a["n"]) == "href") & (a["v"] != ""))
        return F.get(own, F.lit(0))["v"]

    found = F.filter(F.transform(tags, href), lambda h: h.isNotNull())
    return F.transform(found, lambda h: F.replace(F.regexp_replace(h, "^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&")))


def hrefs_ending_with(html: Column, extensions: Sequence[str]) -> Column:
    """The hrefs whose lower-cased text ends with one of ``extensions``, in page order."""

    def wanted(href: Column) -> Column:
        hit = F.lit(False)
        for extension in extensions:
            hit = hit | F.lower(href).endswith(extension)
        return hit

    return F.filter(anchor_hrefs(html), wanted)


def _without_dot_segments(path: Column) -> Column:
    """Path with ``.`` and ``..`` folded away; a trailing dot segment leaves a trailing slash."""
    parts = F.split(path, "/")
    nothing = F.expr("CAST(array() AS array<string>)")

    def step(kept: Column, part: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    folded = F.array_join(F.aggregate(parts, nothing, step), "/")
    folded = F.when(folded == "", F.lit("/")).otherwise(folded)
    ends_with_dots = path.rlike(r"(^|/)\.{1,2}$") & ~folded.endswith("/")
    return F.when(ends_with_dots, F.concat(folded, F.lit("/"))).otherwise(folded)


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` seen from the page ``base``: absolute, ``//host``, ``/path``, ``?query``, ``#part`` and relative forms."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    without_fragment = F.regexp_replace(base, "#.*$", "")
    without_query = F.regexp_replace(base, "[?#].*$", "")
    folder = F.regexp_extract(base_path, "^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)

    href_path = F.regexp_extract(href, "^([^?#]*)", 1)
    tail = F.regexp_extract(href, "^[^?#]*(.*)$", 1)
    rooted = F.when(href.startswith("/"), href_path).otherwise(F.concat(folder, href_path))
    return (
        F.when(href == "", base)
        .when(href.rlike(_ABSOLUTE), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(without_fragment, href))
        .when(href.startswith("?"), F.concat(without_query, href))
        .otherwise(F.concat(origin, _without_dot_segments(rooted), tail))
    )
