"""Tables that grow by batches and months, delimited lines in a frame, and fingerprints of large files."""

import hashlib
import re
from datetime import datetime

from pyspark.sql import functions as F

from loadlake.operators import ledger
from loadlake.plans import jobs, workload
from loadlake.sources import delimited, landed, tables
from loadlake.streaming import keyed

ARRIVAL = "source string, resource_id string, hash_sha256 string, retrieved_at timestamp, local_path string"


def arrived(spark, hashes, day=1):
    return spark.createDataFrame([("ons", "a", h, datetime(2026, 6, day), f"raw/{h}") for h in hashes], ARRIVAL)


def test_batches_that_run_again_leave_the_rows_of_one_run(spark, tmp_path):
    path = str(tmp_path / "ledger")
    register = keyed.versions_into(path)
    register(arrived(spark, "xxy"), 0)
    keyed.batches_into(path)(ledger.as_ledger(arrived(spark, "w")), 1)  # left by a run that ended half-way
    for _ in range(2):
        register(arrived(spark, "yz", 2), 1)
    register(arrived(spark, "xxy"), 0)
    found = keyed.batches(spark, path, ledger.LEDGER_SCHEMA).select("hash_sha256", "batch").collect()
    assert sorted(map(tuple, found)) == [("x", 0), ("y", 0), ("z", 1)]


def test_newest_batch_of_a_key_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    store = keyed.batches_into(path)
    rows = [spark.createDataFrame(r, "k string, v int") for r in ([("a", 1), ("b", 2)], [("a", None)])]
    assert keyed.folded(keyed.batches(spark, path, rows[0].schema), ["k"]).count() == 0
    for batch, df in enumerate(rows):
        store(df, batch)
    found = keyed.folded(keyed.batches(spark, path, rows[0].schema), ["k"]).collect()
    assert sorted((r.k, r.v) for r in found) == [("a", None), ("b", 2)]


def test_untouched_months_keep_their_files(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    schema = "x int, date date, year int, month int"
    day = datetime(2026, 1, 1).date()
    every = spark.createDataFrame([(1, day, 2026, 1), (2, day, 2026, 2), (3, day, 2026, 2)], schema)

    def build(df):
        return df.groupBy("year", "month").agg(F.sum("x").alias("x"))

    tables.overwrite_partitions(build(every.where("x < 3")), path, whole=True)
    before = {f.name for f in (tmp_path / "p" / "year=2026" / "month=1").glob("*.parquet")}
    assert jobs.refresh_months(every, every.where("x = 3"), build, path) == [202602]
    assert rows(spark.read.parquet(path), "month", "x") == [(1, 1), (2, 5)]
    assert {f.name for f in (tmp_path / "p" / "year=2026" / "month=1").glob("*.parquet")} == before
    assert jobs.refresh_months(every, every.where("false"), build, path) == []


def lines(spark, **files):
    rows = [(name, i, line) for name, text in files.items() for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "file_path string, line_no long, value string").repartition(4)


def test_lines_of_any_dialect_in_one_plan(spark):
    found = delimited.parse(
        lines(
            spark, a='x;y\n1;"2;""3"""\n\n4', b="﻿y\tx\n2\t1\tmore\n;\t\"\"", c='y,x\n"one\ntwo, ""three""",5\n6,7', d="no header\n1", e="x" * 70000 + ";y\n1;2", f="",
        ),
        ["x", "y"],
    )
    told = sorted(((r.file_path, r.problem, r.x, r.y) for r in found.collect()), key=repr)
    expected = [("a", None, "1", '2;"3"'), ("a", None, "4", None), ("b", None, "1", "2"), ("b", None, "", ";"), ("c", None, "5", 'one\ntwo, "three"'),
                ("c", None, "7", "6"), ("d", delimited.NO_SEPARATOR, None, None), ("e", delimited.LONG_HEADER, None, None),
                ("f", delimited.NO_SEPARATOR, None, None)]
    assert told == sorted(expected, key=repr)
    assert delimited.parse(lines(spark, a="x;y").where("false"), ["x"]).count() == 0


def test_plan_does_not_grow_with_the_headers(spark):
    sizes = []
    for n in (2, 200):
        files = {f"f{i}": f"x;c{i};y\n1;2;3" for i in range(n)}
        df = delimited.parse(lines(spark, **files), ["x", "y"])
        assert df.count() == n
        sizes.append(df._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert sizes[0] == sizes[1]


def test_large_files_are_marked_by_their_lines(spark, tmp_path):
    for name, text in (("a", "1\n2\n3\n"), ("b", "3\n1\n2\n"), ("c", "3\n1\n1\n"), ("d 1+[x]", "4\n" * 5), ("small", "12")):
        (tmp_path / name).write_text(text)
    found = {r.file_path.rsplit("/", 1)[1]: (r.hash_sha256, r.file_size) for r in landed.fingerprints(spark, str(tmp_path), large=3).collect()}
    assert found["a"] == found["b"] != found["c"] and found["a"][0].startswith("lines-3-") and found["a"][1] == 6
    assert found["d 1+[x]"][0].startswith("lines-5-") and found["small"] == (hashlib.sha256(b"12").hexdigest(), 2)
    assert len(found) == 5


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    seen = tables.write_observed(spark.range(100), path, {"n": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)})
    assert seen == {"n": 100, "odd": 50} and spark.read.parquet(path).count() == 100


def test_ordered_table_opens_only_the_files_in_range(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select(F.when(F.col("id") < 400, 500).otherwise(F.col("id")).alias("x"), F.col("id").alias("y"))
    tables.write_ordered(df, path, "x")
    bounds = sorted((r.low, r.high) for r in spark.read.parquet(f"{path}_bounds").collect())
    assert len(bounds) > 1 and all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    some = tables.read_between(spark, path, "x", 900, 950)
    assert sorted(r.x for r in some.collect()) == list(range(900, 951)) and len(some.inputFiles()) < len(bounds)
    assert tables.read_between(spark, path, "x", 5000, 6000).count() == 0


def test_lines_are_placed_once_for_files_with_and_without_breaks(spark):
    """No condition on the line goes below the join, which would build each line again and keep the two kinds of files from
    sharing one exchange; blank lines, and quotes that end before the cell does."""
    texts = {"a": 'x;y\n1;"2;""3"""\n   \n"4"z;', "b": 'y,x\n"one\ntwo",5\n\n"",""\n"6",', "c": 'x;y\n"";"\n""""; "q"'}
    found = lines(spark, **texts).withColumn("value", F.concat("value", F.lit("")))
    parsed = delimited.parse(found, ["x", "y"])
    told = sorted(((r.file_path, r.x, r.y) for r in parsed.collect()), key=repr)
    expected = [("a", "1", '2;"3"'), ("a", "4", None), ("b", "5", "one\ntwo"), ("b", "", ""), ("b", None, "6"), ("c", "", '\n""; "q')]
    assert told == sorted(expected, key=repr)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert not re.findall(r"Filter [^\n]*trim\(concat\(", plan)


def test_files_are_written_whole_at_their_paths(spark, tmp_path):
    names = [f"raw/{i % 3}/é {i}-x.json" for i in range(40)]
    files = spark.createDataFrame([(n, f"{n}\n\u2028漢😀") for n in names], "path string, text string").repartition(3)
    for _ in range(2):
        assert tables.write_files(files, str(tmp_path / "a")) == 40
    there = {str(p.relative_to(tmp_path / "a")): p.read_bytes().decode() for p in (tmp_path / "a").rglob("*") if p.is_file()}
    assert there == {n: f"{n}\n\u2028漢😀" for n in names}
    assert tables.write_files(files.where("false"), f"file:{tmp_path}/b") == 0


def test_landed_versions_share_folders(spark, tmp_path, monkeypatch):
    """A file per version, but not a folder for each; newest versions only, no resource without a number."""
    monkeypatch.setattr(workload, "work_folder", lambda spark, name: str(tmp_path / name))
    events = spark.range(45_150).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit("view").alias("event_type"), (F.col("id") + 0.5).alias("value"))
    events = events.where("event_id % 150 < 2 OR event_id >= 45000").unionByName(events.limit(1).withColumn("event_id", F.lit(None).cast("long")))
    events.write.parquet(str(tmp_path / "t" / "events.parquet"))
    found = sorted((int(r.resource_id), r.area, r.load_mw) for r in workload.ledger_scan(spark, str(tmp_path / "t")).collect())
    expected = [(i, "view", i * 150 + 1.5) for i in range(300)] + [(300, "view", j + 0.5) for j in range(45_002, 45_150, 3)]
    assert found == sorted(expected)
    landed_files = [p for p in (tmp_path / "lake" / "raw").rglob("*-*") if p.is_file() and not p.name.startswith(".")]
    assert len(landed_files) == 603 and len({p.parent for p in landed_files}) <= workload.LANDED_FOLDERS
