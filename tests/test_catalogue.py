import pytest
from compare import SF, assert_same

from siftwright.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert_same(catalogue.QUERIES[name](spark, SF), catalogue.ORACLE_SQL[name])


def test_zipf_follows_rank(spark):
    found = {r[0]: r[1] for r in catalogue.zipf_sample(spark, "/root/testdata/sf0.01").groupBy("drawn").count().collect()}
    ranked = sorted(found, key=found.get, reverse=True)
    first = sorted(found)[0]
    total = sum(1 / r for r in range(1, 1501))
    assert abs(found[first] / 15000 - 1 / total) < 0.02
    assert ranked[0] == first and sum(found.values()) == 15000


def test_generated_rows_are_valid_or_broken_as_said(spark):
    rows = catalogue.generated_rows(spark, SF).collect()
    assert len(rows) == 1500
    for r in rows:
        want = {None: None, "short": "WRONG_COLUMN_COUNT", "long": "WRONG_COLUMN_COUNT", "empty": "NULL_VIOLATION", "type": "INVALID_DATE_FORMAT"}[r.broken]
        assert r.error_code == want
    assert 0.05 < sum(r.broken is not None for r in rows) / len(rows) < 0.15
    assert rows == catalogue.generated_rows(spark, SF).collect()


def test_zipf_refuses_an_empty_pool(spark):
    from siftwright.operators import generate

    with pytest.raises(ValueError):
        generate.zipf(spark.range(3), spark.createDataFrame([], "name string"), "id", 1, "drawn")


def test_report_plan_prunes_and_pushes(spark):
    plan = catalogue.report_region_month(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "o_orderpriority" not in plan and "Python" not in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())
