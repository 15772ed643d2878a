"""What grows with the input does not go through the driver: no plan broadcasts interval blocks or a row for each customer."""

import pytest

import __spark_entry__ as entry
from strataledger.queries.registry import Tables


def broadcast_parts(plan):
    """The lines below each broadcast of a plan's text."""
    lines = plan.split("== Initial Plan ==")[-1].splitlines()

    def depth(line):
        return min((line.find(x) for x in ("+- ", ":- ") if x in line), default=0)

    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            for below in lines[i + 1:]:
                if depth(below) <= depth(line):
                    break
                yield below


@pytest.mark.parametrize("name", [
    "person_history", "fact_person_keys", "daily_snapshot_fact", "daily_snapshot_runs", "termination_fact", "transaction_fact", "referral_fact", "referral_adjustments", "referral_fact_from_history",
])
def test_no_broadcast_grows_with_the_input(spark, sf, name, monkeypatch):
    monkeypatch.setattr(Tables, "stage", lambda self, df, name: df)  # plans of what is staged, too
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    grown = [x.strip()[:160] for x in broadcast_parts(plan) if "customer.parquet" in x or "Generate explode" in x and ("_give" in x or "_n#" in x)]
    assert not grown, grown


@pytest.mark.parametrize("name", [
    "referral_fact", "referral_adjustments", "referral_fact_from_history",
])
def test_referrals_are_derived_once(spark, sf, name):
    """The plan that compares the fact at the cut with the fact as it is reads what was derived, not the sources again."""
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "FileScan" in plan and "l_shipdate" not in plan and "o_orderdate" not in plan
