import pytest
from conftest import SF
from helpers import same

from tintloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_statement(name, spark, duck):
    same(catalog.QUERIES[name], catalog.ORACLES[name], spark, duck, SF)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())


def test_plans_prune_columns_and_stay_native(spark):
    plan = catalog.QUERIES["swatch_measure"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
    scan = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "l_extendedprice" not in scan.split("ReadSchema")[1]


def test_page_failures_deals_parts_before_they_are_pages(spark):
    plan = catalog.QUERIES["page_failures"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.index("MapInArrow") < plan.index("Repartition")


def test_page_details_deals_parts_before_they_are_pages(spark):
    plan = catalog.QUERIES["page_details"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.index("MapInArrow") < plan.index("Repartition")
