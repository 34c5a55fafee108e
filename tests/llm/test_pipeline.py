"""The pipeline's stages, the registered queries, and the package's place in the library."""

import pathlib
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from loadlake.llm import decontamination, line_dedup, order_minhash, quality_rules
from loadlake.llm.common import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no sample tables")


def test_every_stage_takes_effect(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    texts = {}
    for (name, stage), rule in zip(corpus_pipeline.STAGES, ("rows", "texts", "rows", "texts", None), strict=True):
        before = {r.doc_id: r.text for r in docs.collect()} if not texts else texts
        out = stage(spark, docs, FOLDER)
        if rule is None:
            assert {r.doc_id for r in out.select("doc_id").collect()} == set(before)
            break
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        texts = {r.doc_id: r.text for r in docs.collect()}
        assert set(texts) <= set(before) if rule == "rows" else set(texts) == set(before)
        assert all(r.n_chars == len(r.text) for r in docs.collect())
        if rule == "rows":
            assert all(texts[i] == before[i] for i in texts)
        if name == "quality_rules":
            assert quality_rules.judged(docs).where("base_failed").count() == 0
        if name == "line_dedup":
            assert line_dedup.repeated_lines(docs).count() == 0
        if name == "near_duplicates":
            assert order_minhash.near_duplicates(docs).where("NOT kept").count() == 0
        if name == "decontamination":
            assert decontamination.contamination(docs, table(spark, FOLDER, "benchmark")).where("size(spans) > 0").count() == 0


def test_columns_with_the_operators_own_names_pass_through(spark):
    names = ("kept", "measured", "deduplicated", "quality", "key", "_keys", "_gone", "row", "node", "block", "spans")
    text = " ".join(f"word{i % 37}x{i}" for i in range(60))
    rows = [(i, f"{text} {i}\nA closing line of its own here {i}", *[f"{n}{i}" for n in names]) for i in (1, 2, 3)]
    rows += [(None, text + " other", *names), (7, None, *names), (8, "", *names), (1, rows[0][1], *rows[0][2:])]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        for r in out.where("doc_id IS NOT NULL").collect():
            assert tuple(r)[2:] == tuple(f"{n}{r.doc_id}" for n in names)
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert {r.doc_id for r in docs.collect()} == {1, None}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= 2
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), FOLDER).count() == 0


def test_run_returns_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and rows.count() > 0


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if re.match(r"op\d+_", n)))
def test_query_runs_over_its_whole_table(spark, name):
    rows = entry.queries()[name](spark, FOLDER)
    wanted = table(spark, FOLDER, "pages" if name.startswith("op7") else "documents").count()
    key = "page_id" if name.startswith("op7") else "doc_id"
    assert rows.select(key).distinct().count() == wanted


def test_queries_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from tools.check_oracles import rows_of

    db = duckdb.connect()
    for file in pathlib.Path(FOLDER).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    for name, sql in entry.TEXT_ORACLES.items():
        df = entry.queries()[name](spark, FOLDER)
        cursor = db.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert rows_of(names, cursor.fetchall()) == rows_of(df.columns, [tuple(r) for r in df.collect()]), name


def test_nothing_else_needs_this_package():
    home = pathlib.Path(entry.__file__).parent
    for file in [*home.glob("loadlake/**/*.py"), home / "bench.py"]:
        if "llm" not in file.parts:
            assert "llm" not in file.read_text(), file
