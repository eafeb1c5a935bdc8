"""The flagship query searches a headline once, not once per repeat."""

from hazardspark.checks.base import QUERIES


def test_repeats_leave_before_the_search(spark):
    plan = QUERIES["flagship_monthly_victims"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    search = next(i for i, line in enumerate(plan) if "falecid" in line and "Generate" in line)
    below = "\n".join(plan[search + 1 :])
    assert "Aggregate" in below and "falecid" not in below
