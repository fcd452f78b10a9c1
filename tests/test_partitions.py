"""The same input in 1, 4 or 7 partitions gives the same output."""

import pytest
from pyspark.sql import functions as F

from respondry.operators import (
    cleaning, dashboard, evaluation, features, risk, segments, simulation, splitting,
)
from respondry.sources import derived
from tests.compare import assess, spark_result

KEY = "contact_id"


def assessed(df):
    return assess(segments.segment_customers(df))


def labelled(df):
    return df.withColumn("label", features.label_expression())


CASES = {
    "split": lambda df: splitting.assign_split(df).select(KEY, "split"),
    "fold": lambda df: df.select(KEY, splitting.fold_number(F.col(KEY)).alias("fold")),
    "sample": lambda df: df.filter(simulation.sampled(KEY)).select(KEY),
    "clean": lambda df: cleaning.CleaningModel.fit(df.drop("p_yes", "prediction")).transform(df)
    .drop("p_yes", *[c for c in df.columns if c.startswith("cons_price")]),
    "rank": lambda df: risk.rank_customers(assessed(df)).select(KEY, "risk_priority_rank"),
    "top": lambda df: dashboard.top_at_risk(assessed(df)),
    "summary": lambda df: risk.risk_marginals(assessed(df)),
    "simulation": lambda df: simulation.compare_strategies(segments.segment_customers(df)),
    "roc": lambda df: evaluation.roc_curve(evaluation.outcome_counts(labelled(df))),
    "index": lambda df: features.frequency_index(df, ["job", "month"])
    .select(KEY, "job_index", "month_index"),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_partitioning_does_not_matter(spark, sf_dir, name):
    df = derived.scored(spark, sf_dir)
    results = [spark_result(CASES[name](df.repartition(n))) for n in (1, 4, 7)]
    assert results[0] == results[1] == results[2]


def test_split_sample_and_fold_are_independent(spark, sf_dir):
    """One salt per purpose: a sample of any split is about as large as a sample of all rows."""
    df = splitting.assign_split(derived.scored(spark, sf_dir))
    shares = df.groupBy("split").agg(F.avg(simulation.sampled(KEY).cast("int")).alias("share"))
    assert all(0.2 < r["share"] < 0.4 for r in shares.collect())
