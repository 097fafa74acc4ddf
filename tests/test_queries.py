import pytest
from compare import DATA, assert_same

from brinewake.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_against_sql(spark, name):
    df = catalog.queries()[name](spark, DATA)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert_same(df, sql)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() == 479
    assert df.columns == ["kind", "inclusion_radius", "n_bins", "begin", "end"]


def test_cascade_is_one_exchange_deep(spark):
    """The cascade adds windows, not shuffles: one exchange by kind, one for the intervals' groups."""
    df = catalog.queries()["scenario_intervals"](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(kind") <= 2
    assert "CartesianProduct" not in plan


def test_result_does_not_depend_on_partitions(spark):
    name = "scenario_intervals"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    a = sorted(map(str, catalog.queries()[name](spark, DATA).collect()))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert a == sorted(map(str, catalog.queries()[name](spark, DATA).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
