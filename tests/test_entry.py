import inspect

import __spark_entry__ as entry
from loadlake.plans import oracles, workload


def test_every_query_has_sql_and_the_other_way_round():
    assert set(oracles.ORACLES) == set(workload.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 120 and "normalized_load" in df.columns


def test_holiday_rules_agree_with_gauss(spark):
    from loadlake.operators.calendar import holidays_between

    found = {(r.date, r.holiday) for r in holidays_between(spark, 1990, 2100).collect()}
    assert found == set(oracles._holidays(range(1990, 2101)))


def test_no_python_functions_and_no_cross_joins():
    import loadlake.functions as f
    import loadlake.operators as o

    for package in (f, o):
        folder = package.__path__[0]
        import pathlib

        for file in pathlib.Path(folder).glob("*.py"):
            text = file.read_text()
            for word in ("udf(", "applyIn", "mapIn", "crossJoin", ".collect()", "toPandas", "localCheckpoint"):
                assert word not in text, (file.name, word)


def test_queries_take_session_and_folder():
    for query in workload.QUERIES.values():
        assert list(inspect.signature(query).parameters) == ["spark", "folder"]
