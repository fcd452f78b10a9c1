"""Physical plans: pushdown, no Python in the row path, bounded windows and joins."""

import re

import pytest
from pyspark.sql import functions as F

from respondry.operators import dashboard, risk, segments, simulation
from respondry.plans.catalogue import QUERIES
from respondry.sources import derived
from respondry.sources.tables import read_table, write_table
from tests.compare import assess

ROW_WISE = [
    "segment_customers", "segment_stats", "strategy_high", "strategy_high_medium",
    "strategy_random", "marketing_simulation", "churn_score", "credit_score", "churn_level",
    "credit_level", "composite_risk", "recommended_actions", "risk_rank", "risk_summary",
    "risk_counts", "risk_marginals", "top_at_risk", "top_at_risk_limit", "score_profile",
    "score_histogram", "risk_correlation", "typed_input", "validate_input", "validation_summary",
    "rule_churn", "rule_credit", "marketing_recommendation", "decide_customers",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_WISE)
def test_no_python_between_scan_and_result(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInArrow|CartesianProduct", plan)


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """A scored table on disk, as the reports would read it."""
    from respondry.operators.risk import add_outcome_index, outcome_labels
    from respondry.sources import derived

    path = str(tmp_path_factory.mktemp("stored") / "scored")
    table = derived.scored(spark, sf_dir)
    write_table(add_outcome_index(table, outcome_labels(table)), path)
    return path


def test_audience_filter_prunes_columns(spark, stored):
    table = segments.segment_customers(read_table(spark, stored))
    plan = plan_of(simulation.select_audience(table, "High Potential Only").select("contact_id"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["contact_id", "p_yes"]


def test_simulation_is_one_aggregate(spark, stored):
    table = segments.segment_customers(read_table(spark, stored))
    plan = plan_of(simulation.compare_strategies(table))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_rank_has_no_window_over_rows(spark, stored):
    assessed = assess(segments.segment_customers(read_table(spark, stored)))
    plan = plan_of(risk.rank_customers(assessed))
    window = plan.index("Window [")
    below = plan[window:]
    # the window reads the aggregate per distinct score, which is the broadcast side
    assert "BroadcastHashJoin" in plan[:window]
    assert "HashAggregate(keys=[composite_risk_score" in below


def test_top_list_sorts_only_leading_rows(spark, stored):
    assessed = assess(segments.segment_customers(read_table(spark, stored)))
    plan = plan_of(dashboard.top_at_risk(assessed))
    assert "top-at-risk" in plan and "SinglePartition" not in plan
    assert "TakeOrderedAndProject" in plan_of(dashboard.top_by_score(assessed))


def test_copies_are_limited_before_the_shuffle(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).select("id", F.array((F.col("id") % 3).cast("double")).alias("vec"))
    w = Window.partitionBy("vec").orderBy("id")
    plan = plan_of(df.withColumn("n", F.row_number().over(w)).filter("n <= 6"))
    final, partial = plan.index("Final"), plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2 and final < plan.index("Exchange") < partial


def test_one_pass_over_the_scan_for_statistics(spark, stored):
    from respondry.operators.cleaning import modes

    table = read_table(spark, stored)
    plan = plan_of(modes(table, ["job", "marital", "education"]))
    assert plan.count("FileScan") == 1


def test_correlation_is_one_compiled_pass(spark, stored, monkeypatch):
    """With nulls or without: one job, one scan, one aggregate."""
    table = read_table(spark, stored)
    seen, original = [], type(table).collect
    assessed = assess(segments.segment_customers(table))
    partly = assessed.withColumn("pdays", F.when(F.col("campaign") > 1, F.col("pdays")))
    monkeypatch.setattr(type(table), "collect", lambda self: seen.append(self) or original(self))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for frame in (assessed, partly):
            dashboard.risk_correlation(frame)
        plans = [plan_of(frame) for frame in seen]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(plans) == 2
    for plan in plans:
        lines = [line for line in plan.splitlines() if "HashAggregate" in line]
        assert len(lines) == 2 and all("*(" in line for line in lines) and plan.count("FileScan") == 1


def test_no_score_expression_in_a_join_condition(spark, sf_dir):
    """A null test on the composite must not be pushed into the join below the scores."""
    assessed = assess(segments.segment_customers(derived.scored(spark, sf_dir)))
    ranks = risk.score_ranks(assessed)
    plan = plan_of(assessed.join(ranks, "composite_risk_score"))
    conditions = [line for line in plan.splitlines() if "Join [o_custkey" in line]
    assert conditions and all("isnotnull(" not in line for line in conditions)
