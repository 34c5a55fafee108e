import pytest
from pyspark.sql import functions as F

from loadlake.functions import parsing
from loadlake.operators import calibration, curves

SCHEMA = (
    "SigCcs string, NomSubGrupoTarifario string, DscDemandante string, DscTipoDia string, HorInicial string,"
    " HorFinal string, VlrDmd string"
)
DATA = [
    ("LIGHT", "B1", "Residencial", "Dia Útil", "00:00", "01:00", "10,5"),
    ("LIGHT", "B1", "Residencial", "Dia Útil", "01:00:00", "02:00", "9.8"),
    ("LIGHT", "B1", "Residencial", "Dia Útil", "02:00", "03:00", "9,2"),
    ("LIGHT", "A4", "Industrial", "Dia Útil", "00:00", "01:00", "20,0"),
    ("LIGHT", "A4", "Industrial", "Dia Útil", "00:00", "01:00", "22,0"),
    ("ENEL", "B1", "Residencial", "Sábado", "00:00", "01:00", "x"),
    (None, "B1", "Residencial", "Sábado", "00:00", "01:00", "8,1"),
]


@pytest.fixture
def typed(spark):
    return curves.type_class_curves(spark.createDataFrame(DATA, SCHEMA))


@pytest.mark.parametrize(
    ("text", "value"),
    [("10,5", 10.5), ("10.5", 10.5), ("-3", -3.0), ("1.234,5", None), ("1,2,3", None), ("", None), ("1d", None), ("2e3", 2000.0), (",5", 0.5)],
)
def test_decimal_comma(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parsing.decimal_comma(F.col("t"))).first()[0] == value


def test_category_values(typed, rows):
    found = rows(curves.category_values(typed), "category", "value")
    assert ("SigCcs", "ENEL") in found and ("DscTipoDia", "Sábado") in found and len(found) == 8
    assert all(value is not None for _, value in found)


def test_stats_and_normalisation(typed):
    normal = curves.normalize_class_curves(curves.class_curve_stats(typed))
    home = normal.where("SigCcs = 'LIGHT' AND DscDemandante = 'Residencial'").orderBy("hour").collect()
    assert [r.hour for r in home] == [0, 1, 2] and home[0].mean_mw == 10.5 and home[0].std_mw is None
    assert home[0].normalized_load == pytest.approx(10.5 / ((10.5 + 9.8 + 9.2) / 3))
    plant = normal.where("DscDemandante = 'Industrial'").first()
    assert (plant.mean_mw, plant.median_mw, plant.p05_mw, plant.p95_mw, plant.n_observations) == (21, 21, 20, 22, 2)
    assert plant.std_mw == pytest.approx(2**0.5)


def test_null_keys_and_unreadable_values_stay(typed):
    stats = curves.class_curve_stats(typed)
    assert stats.where("SigCcs IS NULL").first().median_mw == 8.1
    broken = stats.where("SigCcs = 'ENEL'").first()
    assert (broken.mean_mw, broken.median_mw, broken.n_observations) == (None, None, 0)


def test_class_report(typed):
    normal = curves.normalize_class_curves(curves.class_curve_stats(typed))
    found = {r.hour: r.avg_mw for r in curves.class_report(normal, "Residencial").collect()}
    assert found == {0: pytest.approx((10.5 + 8.1) / 2), 1: 9.8, 2: 9.2}


def test_labels(spark):
    df = spark.createDataFrame([("RJ", 1), (" rj ", 2), ("Rio de Janeiro", 3), ("SP", 4)], "UF string, n int")
    aliases = ("rj", "rio de janeiro")
    assert sorted(r.n for r in curves.rows_with_label(df, "UF", aliases).collect()) == [1, 2, 3]
    assert [r.n for r in curves.rows_with_label(df, "UF", aliases, first_only=True).collect()] == [2]
    assert curves.rows_with_label(df, "UF", ("mg",)).count() == 0


def shapes(spark, **by_type):
    data = [("RJ", t, h, float(v)) for t, values in by_type.items() for h, v in enumerate(values)]
    return spark.createDataFrame(data, "area string, day_type string, hour int, normalized_load double")


def test_calibration_carries_the_energy(spark):
    q = 19.2 / 21
    peaked = [q] * 17 + [1.6] * 3 + [q] * 4
    days = spark.createDataFrame([(2026, 6, "weekday", 22), (2026, 6, "saturday", 4), (2026, 6, "holiday", 4)],
                                 "year int, month int, day_type string, n_days int")
    energy = spark.createDataFrame([("RJ", 2026, 6, 1e6), ("RJ", 2026, 7, 5e5)], "area string, year int, month int, energy_mwh double")
    curve = calibration.calibrate(shapes(spark, weekday=peaked, saturday=[1.0] * 24, sunday=[1.0] * 24), days, energy)
    june = curve.where("month = 6")
    flat = june.where("day_type = 'saturday'").first()
    assert flat.estimated_load_mw == pytest.approx(1e6 / (26 * 24)) and flat.n_days_in_month == 4
    assert june.where("day_type = 'sunday'").first().n_days_in_month == 0
    total = {r.month: r for r in calibration.calibration_summary(curve).collect()}
    assert total[6].estimated_energy_mwh == pytest.approx(1e6) and abs(total[6].error_pct) < 1e-9
    assert curve.where("month = 7").first().estimated_load_mw is None


def test_average_monthly_power(spark):
    df = spark.sql("SELECT DATE '2026-02-01' AS month_start, 672000D AS energy_mwh")
    assert calibration.average_monthly_power(df).first().average_power_mw == 1000
