"""Every registered query of the library against its SQL on the smallest tables."""

import decimal

import duckdb
import pytest

from tracewell.jobs import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry_names_only_known_queries(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def test_trials_send_no_customers_through_the_driver(spark):
    from tracewell.jobs import stats_jobs

    found = stats_jobs.trials(spark, SF)
    assert found.count() > 0
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_cross_correlation_joins_the_trials_once(spark):
    plan = registry.queries()["t5_cross_correlation"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan and "o_custkey" not in plan


def test_ks_joins_the_trials_once(spark):
    plan = registry.queries()["t6_ks"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan and "o_custkey" not in plan
