"""Physical-plan guards: no cross products, filters and projections reach the scans."""

import pytest

from paydw.plans.registry import QUERIES
from paydw.plans import usage
from paydw.plans.warehouse import warehouse_for_sf

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_year_filter_reaches_partitions(spark):
    wh = warehouse_for_sf(spark, SF)
    plan = _plan(usage.usage_client_day_type(wh, ano=1998))
    assert "PartitionFilters: [isnotnull(mes_ref" in plan and "199801" in plan


def test_projection_pruned_at_scan(spark):
    wh = warehouse_for_sf(spark, SF)
    plan = _plan(usage.usage_gaps(wh))
    scans = [ln.split("FileScan parquet ")[1].split("]")[0] for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans == ["[id_cliente#" + scans[0].split("[id_cliente#")[1]]
    cols = [c.split("#")[0] for c in scans[0].strip("[").split(",")]
    assert cols == ["id_cliente", "data_movimentacao", "mes_ref"]


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "AggregateInPandas")

@pytest.mark.parametrize("name", sorted(QUERIES))
def test_jvm_only(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert not any(node in plan for node in PYTHON_NODES)
