"""Known totals of the derived tables (independent of the SQL files)."""

import pytest
from pyspark.sql import functions as F

from respondry.operators import evaluation, features, risk, segments
from respondry.sources import derived
from tests.compare import assess

GOLDEN = {
    "/root/testdata/sf0.001": {
        "rows": (1500, 1484, 136, 2),
        "segments": {"High Potential": 154, "Low Potential": 720, "Medium Potential": 626},
        "overall": {"High Risk": 655, "Low Risk": 45, "Medium Risk": 800},
        "cells": {"HH": 212, "HL": 83, "HM": 678, "LH": 42, "LL": 5, "LM": 38, "MH": 182,
                  "ML": 26, "MM": 234},
    },
    "/root/testdata/sf0.01": {
        "rows": (15000, 14845, 1233, 40),
        "segments": {"High Potential": 1494, "Low Potential": 7027, "Medium Potential": 6479},
        "overall": {"High Risk": 6662, "Low Risk": 544, "Medium Risk": 7794},
        "cells": {"HH": 2052, "HL": 868, "HM": 6962, "LH": 425, "LL": 48, "LM": 414, "MH": 1704,
                  "ML": 222, "MM": 2305},
    },
}


def counts(df, *columns):
    return {tuple(r[c] for c in columns): r["count"] for r in df.groupBy(*columns).count().collect()}


@pytest.mark.parametrize("sf_dir", sorted(GOLDEN))
def test_totals(spark, sf_dir):
    want = GOLDEN[sf_dir]
    df = derived.scored(spark, sf_dir)
    row = df.agg(
        F.count("*"), F.count("cons_price_idx"), F.count_if(~F.col("age").between(18, 100)),
        F.count_if(F.col("p_yes").isin(0.5, 0.8)),
    ).first()
    assert tuple(row) == want["rows"]
    assessed = assess(segments.segment_customers(df)).cache()
    assert {k[0]: v for k, v in counts(assessed, "potential_segment").items()} == want["segments"]
    assert {k[0]: v for k, v in counts(assessed, "overall_risk_level").items()} == want["overall"]
    cells = counts(assessed, "churn_risk", "credit_risk")
    assert {a[0] + b[0]: n for (a, b), n in cells.items()} == want["cells"]
    assessed.unpersist()


def test_area_and_rank(spark):
    df = derived.scored(spark, "/root/testdata/sf0.01").withColumn(
        "label", features.label_expression()
    )
    area = evaluation.curve_areas(evaluation.outcome_counts(df)).first()["roc_auc"]
    assert abs(area - 0.6784088761477257) < 1e-12
    ranked = risk.rank_customers(assess(segments.segment_customers(df)))
    assert ranked.filter("risk_priority_rank <= 50").count() == 59
