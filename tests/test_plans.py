"""Physical-plan properties of the main reports (regression guard for the scale design)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
REPORTS = ["merged_capacity_cost", "capacity_data_v1", "qpv_data", "task_status_list", "task_status_for_parts"]


def _plan(spark, key):
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", REPORTS)
def test_no_python_no_cartesian(spark, key):
    plan = _plan(spark, key)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{key}: {bad}"


@pytest.mark.parametrize("key", REPORTS)
def test_every_top1_window_is_limited_before_its_shuffle(spark, key):
    plan = _plan(spark, key)
    finals = len(re.findall(r"WindowGroupLimit .*Final", plan))
    partials = len(re.findall(r"WindowGroupLimit .*Partial", plan))
    assert finals == partials and (finals or "task_status" in key)      # their only windows are on the stored parts side


def test_shared_inputs_are_read_once(spark, monkeypatch):
    """The PO-line join and the parts side are stored once per report, whatever reads them."""
    from capstan.plans import capacity, pricing
    written = []
    for module in (pricing, capacity):
        keep = module.stored_table
        monkeypatch.setattr(module, "stored_table", lambda df, name, keep=keep: written.append(name) or keep(df, name))
    qpv = _plan(spark, "qpv_data")
    assert written == ["price-lines"] and "PurchaseUnitID" in qpv
    assert "fixtures" not in "".join(re.findall(r"Location: .*erp_po_line", qpv))
    written.clear()
    _plan(spark, "capacity_data_v2")
    assert written == ["capacity-parts"]


def test_filters_reach_the_scans(spark):
    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import capacity
    from capstan.sources import Sources
    parts = capacity.purchased_parts(Sources.stored_fixtures(spark, SF), CFG)      # stored before the task join
    assert "PushedFilters: [IsNotNull(FabricatedFlag), EqualTo(FabricatedFlag,0)" in parts._jdf.queryExecution().executedPlan().toString()
    cap = _plan(spark, "capacity_data_v2")
    assert "EqualTo(TaskID,40)" in cap
    qpv = _plan(spark, "qpv_data")
    assert "GreaterThan(BOMExplosionDate,1998-06-08T12:00)" in qpv
    assert "In(Status, [C,R])" in qpv and "LessThan(StartDate,1998-06-15T00:00)" in qpv
