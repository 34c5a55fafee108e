import hashlib
import json
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from loadlake.functions import parsing, urls
from loadlake.operators import catalog
from loadlake.sources import landed


def resource(id, name, format, modified="2026-06-01T12:00:00", **more):
    return {"id": id, "name": name, "format": format, "url": f"https://example.org/{id}", "metadata_modified": modified, **more}


RESOURCES = [
    resource("1", "Curvas Consumidor-Tipo (CSV)", "CSV", hash="", size=12345),
    resource("2", "Curvas Consumidor-Tipo (Parquet)", "PARQUET", "2026-07-15T09:30:00", hash="abc"),
    resource("3", "Redes-Tipo (CSV)", "CSV"),
    resource("4", "", None, None, last_modified="2026-08-01"),
]


@pytest.fixture
def payloads(spark, tmp_path):
    good = {"success": True, "result": {"id": "pkg", "name": "n", "resources": RESOURCES}}
    (tmp_path / "good.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "bad.json").write_text(json.dumps({"success": False, "error": "x"}))
    return landed.read_catalog(spark, str(tmp_path))


def test_resources(payloads):
    found = {r.id: r for r in catalog.catalog_resources(payloads).collect()}
    assert set(found) == {"1", "2", "3", "4"} and found["1"].package_id == "pkg"
    assert (found["1"].format, found["1"].hash, found["1"].size) == ("csv", None, 12345)
    assert (found["4"].name, found["4"].format) == ("4", "")
    assert found["2"].hash == "abc" and [found[i].position for i in "1234"] == [0, 1, 2, 3]
    assert catalog.failed_payloads(payloads).first().file_path.endswith("bad.json")


def test_preferred(payloads):
    listed = catalog.catalog_resources(payloads)
    pick = lambda **kw: catalog.preferred_resources(listed, **kw).first()
    assert pick(preference=("parquet", "csv"), name_contains="consumidor").id == "2"
    assert pick(preference=("parquet", "csv"), name_contains="REDES").id == "3"
    assert pick(preference=("csv",)).id == "1"  # both csv equally recent: the first listed
    assert pick(preference=("nothing",)).id == "4"  # all unknown formats: the most recent
    assert pick(name_contains="absent") is None
    assert [r.id for r in catalog.newest_first(listed).collect()] == ["4", "2", "1", "3"]


@pytest.mark.parametrize(
    ("name", "period"),
    [
        ("consumo_horario_202607.csv.gz", "2026-07"),
        ("x 2026/07", "2026-07"),
        ("Consumo Horário - Julho de 2026", "2026-07"),
        ("consumo-marco-2026", "2026-03"),
        ("MARÇO2026", "2026-03"),
        ("março_de_2026", "2026-03"),
        ("202613 dezembro de 2026", "2026-12"),
        ("julho 1999", None),
        ("arquivo-sem-data", None),
    ],
)
def test_period(spark, name, period):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(parsing.reference_period(F.col("n"))).first()[0] == period


def test_period_window_keeps_the_unknown(spark):
    df = spark.createDataFrame([("2026-01",), ("2026-02",), ("2026-03",), (None,)], "reference_period string")
    kept = lambda *a: sorted(str(r[0]) for r in catalog.in_period_window(df, *a).collect())
    assert kept("2026-02", None) == ["2026-02", "2026-03", "None"]
    assert kept(None, "2026-01") == ["2026-01", "None"]
    assert len(kept()) == 4


PAGES = [
    "https://example.org", "https://example.org/", "http://example.org/a/b/page.html", "https://example.org/a/b/?q=1/2#f",
    "https://example.org/a?x=1",
]
HREFS = [
    "file.xlsx", "/file.xlsx", "../file.xlsx", "../../../file.xlsx", "./file.xlsx", "a/./b/../file.xlsx", "//cdn.org/f.xlsx",
    "https://other.org/f.xlsx", "?v=f.xlsx", "#f.xlsx", "f.xlsx?x=../y", "mailto:a@b.xlsx", "..", "a/..", ".",
]


def test_absolute_urls(spark):
    cases = [(p, h) for p in PAGES for h in HREFS]
    df = spark.createDataFrame(cases, "p string, h string")
    found = df.select("p", "h", urls.absolute_url(F.col("p"), F.col("h")).alias("u")).collect()
    assert {(r.p, r.h): r.u for r in found} == {(p, h): urljoin(p, h) for p, h in cases}


HTML = """<html><a href="/one.XLSX">1</a><A class='x' HREF='two.csv' target=_blank>2</A><a href=three.xlsx>3</a>
<abbr href="no.xlsx"></abbr><a name="x">no</a><!-- <a href="hidden.xlsx">no</a> --><script>"<a href='s.xlsx'>"</script>
<a title="a > b" href="four.xlsx?a=1&amp;b=5.xlsx">4</a><link href="style.csv"></html>"""


def test_page_links(spark):
    pages = spark.createDataFrame([("https://example.org/d/", HTML), ("https://example.org/e", "no links")], "url string, html string")
    found = catalog.page_links(pages, (".xlsx", ".csv")).orderBy("link_position").collect()
    assert [r.link for r in found] == [
        "https://example.org/one.XLSX",
        "https://example.org/d/two.csv",
        "https://example.org/d/three.xlsx",
        "https://example.org/d/four.xlsx?a=1&b=5.xlsx",
    ]


def test_current_link_and_fallback(spark):
    pages = spark.createDataFrame([("https://example.org/d/", HTML), ("https://example.org/e", "none")], "url string, html string")
    found = {r.url: r for r in catalog.current_links(pages, (".csv",), F.lit("https://known.org/k.csv")).collect()}
    hit, miss = found["https://example.org/d/"], found["https://example.org/e"]
    assert hit.download_url == "https://example.org/d/two.csv" and not hit.used_fallback
    assert miss.download_url == "https://known.org/k.csv" and miss.used_fallback
    assert miss.resource_id == "epe-" + hashlib.sha1(b"https://known.org/k.csv").hexdigest()[:16]


def test_links_behind_long_and_unclosed_markup(spark):
    from loadlake.functions.urls import anchor_hrefs

    junk = "x" * 1_000_000
    pages = [
        f"<a title='{junk}' data-href='no' href='/one'>1</a>",
        f"<a {'q ' * 300_000}HREF = /two>2</a>",
        f"<a href='/three'>3</a><a title=\"{junk}",
        f"<a href='/four'>4</a><!-- {junk}<a href='/hidden'>",
        "<a title=\"href='/no'\" href=\"/five?a=1&amp;b=2\">5</a><a>6</a><a href=''>7</a>",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, p string")
    found = {r.i: r.h for r in df.select("i", anchor_hrefs(F.col("p")).alias("h")).collect()}
    assert found[0] == ["/one"] and found[1] == ["/two"] and found[2] == ["/three"] and found[3][0] == "/four"
    assert found[4][0] == "/five?a=1&b=2"
