import hashlib

import pytest

from loadlake.sources import landed, tables

HEADER = list(landed.CLASS_CURVE_FIELDS)
ROW = ["2026-01-01", "1", "LIGHT", "2026", "Ciclo", "B1", "Residencial", "Dia Útil", "00:00", "01:00", "10,5"]


def write(path, separator, rows, encoding="utf-8", header=HEADER):
    text = "\n".join(separator.join(r) for r in [header, *rows])
    path.write_bytes((text + "\n").encode(encoding))


def test_every_file_in_its_own_dialect(spark, tmp_path, rows):
    write(tmp_path / "a.csv", ";", [ROW])
    write(tmp_path / "b.csv", "\t", [ROW], "latin-1")
    write(tmp_path / "c.csv", ",", [[*ROW[:-1], '"20,5"']])
    write(tmp_path / "d.csv", ";", [ROW[::-1]], header=HEADER[::-1])
    write(tmp_path / "e.csv", ";", [[*ROW, "surplus", "more"], ROW[:8]])
    write(tmp_path / "f.csv", ";", [ROW], "utf-8-sig")
    (tmp_path / "g.csv").write_text("one column\nvalue\n")
    paths = [str(tmp_path / f"{n}.csv") for n in "abcdefg"]
    found = rows(landed.read_class_curves(spark, paths), "SigCcs", "DscTipoDia", "VlrDmd")
    assert found == sorted([("LIGHT", "Dia Útil", 10.5)] * 5 + [("LIGHT", "Dia Útil", 20.5), ("LIGHT", "Dia Útil", None)], key=repr)
    dialects = {r.file_path[-5]: (r.separator, r.is_utf8) for r in landed.dialects(spark, paths).collect()}
    assert dialects == {"a": (";", True), "b": ("\t", False), "c": (",", True), "d": (";", True), "e": (";", True),
                        "f": (";", True), "g": (None, True)}
    assert [r.file_path[-5] for r in landed.undetected_files(spark, paths).collect()] == ["g"]


def test_large_file_is_split_and_complete(spark, tmp_path):
    write(tmp_path / "big.csv", ";", [[*ROW[:-1], f"{i},25"] for i in range(20000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
        path = str(tmp_path / "big.csv")
        assert spark.read.text(path).rdd.getNumPartitions() > 2
        df = landed.read_class_curves(spark, path)
        assert sorted(r.VlrDmd for r in df.collect()) == [i + 0.25 for i in range(20000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_wanted_column_behind_many_others(spark, tmp_path):
    header = [f"x{i}" for i in range(45)] + ["SigCcs", "VlrDmd"]
    write(tmp_path / "wide.csv", ";", [["-"] * 45 + ["LIGHT", "1,5"]], header=header)
    row = landed.read_delimited(spark, [str(tmp_path / "wide.csv")], ["SigCcs", "VlrDmd"]).first()
    assert (row.SigCcs, row.VlrDmd) == ("LIGHT", "1,5")


def test_only_the_first_line_is_the_header(spark, tmp_path):
    write(tmp_path / "a.csv", ";", [ROW, HEADER, ROW])
    (tmp_path / "a.csv").write_text((tmp_path / "a.csv").read_text().replace("LIGHT", "LIGHT", 1) + "\n\n")
    found = [r.SigCcs for r in landed.read_delimited(spark, [str(tmp_path / "a.csv")], HEADER).collect()]
    assert sorted(found) == ["LIGHT", "LIGHT", "SigCcs"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path / "a.csv", ";", [[*ROW[:6], '"two\nlines ""quoted"""', *ROW[7:]], ROW])
    rows = landed.read_delimited(spark, [str(tmp_path / "a.csv")], ["DscDemandante", "VlrDmd"]).collect()
    assert sorted((r.DscDemandante, r.VlrDmd) for r in rows) == [("Residencial", "10,5"), ('two\nlines "quoted"', "10,5")]


def test_mixed_folder_by_pattern_and_odd_names(spark, tmp_path):
    write(tmp_path / "a b+c[1].csv", ";", [ROW])
    spark.createDataFrame([("LIGHT", 7.5, "00:00", "01:00", "B1", "x", "y")],
                          "SigCcs string, VlrDmd double, HorInicial string, HorFinal string, NomSubGrupoTarifario string,"
                          "DscDemandante string, DscTipoDia string").write.parquet(str(tmp_path / "b"))  # fmt: skip
    df = landed.read_class_curves(spark, [str(tmp_path / "*.csv"), str(tmp_path / "b" / "*.parquet")])
    assert sorted(r.VlrDmd for r in df.collect()) == [7.5, 10.5]
    named = landed.read_delimited(spark, [landed.literal_path(str(tmp_path / "a b+c[1].csv"))], ["SigCcs"]).first()
    assert named.file_path.endswith("/a b+c[1].csv")


def test_broken_json_beside_a_good_file(spark, tmp_path):
    good = '[{"cod_areacarga": "S", "din_referenciautc": "2026-06-02T03:00:00Z", "val_cargaglobal": 1}]'
    (tmp_path / "good.json").write_text(good)
    (tmp_path / "cut.json").write_text(good[:-20])
    (tmp_path / "page.json").write_text("<html>error</html>")
    (tmp_path / "other.json").write_text('{"message": "none"}')
    rows = landed.read_readings(spark, str(tmp_path)).collect()
    told = {r.file_path.rsplit("/", 1)[1]: (r.problem, r.val_cargaglobal) for r in rows}
    assert told == {"good.json": (None, "1"), "cut.json": ("not readable as JSON", None), "page.json": ("not readable as JSON", None),
                    "other.json": ("no reading fields", None)}


def test_parquet_and_text_together(spark, tmp_path):
    write(tmp_path / "a.csv", ";", [ROW])
    spark.createDataFrame([("LIGHT", 7.5, "00:00", "01:00", "B1", "x", "y")],
                          "SigCcs string, VlrDmd double, HorInicial string, HorFinal string, NomSubGrupoTarifario string,"
                          "DscDemandante string, DscTipoDia string").write.parquet(str(tmp_path / "b.parquet"))  # fmt: skip
    df = landed.read_class_curves(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.parquet")])
    assert sorted(r.VlrDmd for r in df.collect()) == [7.5, 10.5] and df.columns == HEADER


def test_monthly_energy(spark, tmp_path):
    write(tmp_path / "m.csv", ";", [["2026-01", "x", "RJ", "SE", "S", "Residencial", "Cativo", "1234,5", "10", "v1"]],
          header=list(landed.MONTHLY_ENERGY_FIELDS))
    row = landed.read_monthly_energy(spark, str(tmp_path / "m.csv")).first()
    assert (row.UF, row.Consumo, row.Consumidores) == ("RJ", 1234.5, 10.0)


def test_stored_profile(spark, tmp_path):
    (tmp_path / "p.csv").write_text("hour,avg_mw,normalized_load\n0,5226.3,0.96\n1,4984.7,0.92\n")
    found = landed.read_profile(spark, str(tmp_path / "p.csv")).orderBy("hour").collect()
    assert [(r.hour, r.avg_mw, r.normalized_load, r.p05_mw) for r in found] == [(0, 5226.3, 0.96, None), (1, 4984.7, 0.92, None)]


def test_fingerprints(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc" * 1000)
    row = landed.fingerprints(spark, str(tmp_path)).first()
    assert (row.hash_sha256, row.file_size) == (hashlib.sha256(b"abc" * 1000).hexdigest(), 3000)


def test_content_mark_ignores_row_order_only(spark):
    a = spark.createDataFrame([("r", 1, "x"), ("r", 2, None)], "r string, k int, v string")
    b = spark.createDataFrame([("r", 2, None), ("r", 1, "x")], "r string, k int, v string")
    c = spark.createDataFrame([("r", 2, "x"), ("r", 1, None)], "r string, k int, v string")
    marks = [landed.content_mark(df, ["r"]).first() for df in (a, b, c)]
    assert marks[0] == marks[1] != marks[2]


def test_tables(spark, tmp_path):
    path = tables.layer_path(str(tmp_path), "metadata", "t")
    df = spark.createDataFrame([(1, 2026, 1), (2, 2026, 2)], "x int, year int, month int")
    assert tables.read_or_empty(spark, path, df.schema).count() == 0
    tables.append(df, path)
    tables.append(df, path)
    assert tables.read_or_empty(spark, path, df.schema).count() == 4
    with pytest.raises(ValueError):
        tables.layer_path(str(tmp_path), "copper")


def test_only_touched_partitions_are_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    tables.overwrite_partitions(spark.createDataFrame([(1, 2026, 1), (2, 2026, 2)], "x int, year int, month int"), path)
    tables.overwrite_partitions(spark.createDataFrame([(9, 2026, 2)], "x int, year int, month int"), path)
    assert rows(spark.read.parquet(path), "x", "month") == [(1, 1), (9, 2)]


def test_whole_overwrite_drops_other_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    tables.overwrite_partitions(spark.createDataFrame([(1, 2026, 1), (2, 2026, 2)], "x int, year int, month int"), path)
    tables.overwrite_partitions(spark.createDataFrame([(9, 2026, 2)], "x int, year int, month int"), path, whole=True)
    assert rows(spark.read.parquet(path), "x", "month") == [(9, 2)]


def test_report(spark, tmp_path):
    path = str(tmp_path / "r")
    tables.write_report(spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string"), path, ["k"])
    files = sorted((tmp_path / "r").glob("*.csv"))
    assert "".join(f.read_text() for f in files) == "k,v\n1,a\n2,b\n"
