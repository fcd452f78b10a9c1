"""Hand-written rows on both sides of every threshold."""

import math

import pytest
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.functions.scoring import half_up_ratio, level_of
from respondry.operators import dashboard, decisions, risk, segments, simulation


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("id").collect()]


def test_segment_edges(spark):
    values = [0.81, 0.8, 0.5, 0.49999, math.nan, None, 1.0, 0.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, p_yes double")
    names = [r[0].split()[0] for r in rows(segments.segment_customers(df), "potential_segment")]
    assert names == ["High", "Medium", "Medium", "Low", "Low", "Low", "High", "Low"]


CHURN = [
    # segment, pdays, campaign, previous, outcome index, points
    ("Low Potential", 91, 6, 1, 0.0, 100),
    ("Low Potential", 90, 5, 2, 0.0, 45),
    ("Low Potential", None, None, None, 0.0, 45),
    ("Medium Potential", 61, 4, 0, 0.0, 85),
    ("Medium Potential", 60, 3, 0, 1.0, 30),
    ("Medium Potential", None, None, None, None, 30),
    ("High Potential", 31, 9, 0, 0.0, 40),
    ("High Potential", 30, 1, 1, 0.0, 15),
    ("Something else", 999, 9, 0, 0.0, 10),
    (None, 999, 9, 0, 0.0, 10),
]


def test_churn_points(spark):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(CHURN)],
        "id int, potential_segment string, pdays int, campaign int, previous int, "
        "poutcome_index double, expected int",
    ).withColumn("points", risk.churn_points())
    assert all(a == b for a, b in rows(df, "points", "expected"))


CREDIT = [
    (-40.1, "yes", "yes", "yes", 130),
    (-40.0, "no", "no", "no", 30),
    (-20.1, None, None, None, 30),
    (-20.0, "yes", "no", "no", 60),
    (None, "no", "yes", "no", 25),
    (0.0, "unknown", "no", "yes", 25),
]


def test_credit_points(spark):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(CREDIT)],
        "id int, cons_conf_idx double, `default` string, loan string, housing string, expected int",
    ).withColumn("points", risk.credit_points())
    assert all(a == b for a, b in rows(df, "points", "expected"))


@pytest.mark.parametrize(
    "levels", [fv.CHURN_LEVELS, fv.CHURN_CONFIDENCE, fv.CREDIT_LEVELS, fv.CREDIT_CONFIDENCE,
               fv.OVERALL_LEVELS],
)
def test_levels_start_at_their_threshold(spark, levels):
    cuts = [cut for cut, _ in levels if cut is not None]
    values = [v for cut in cuts for v in (cut, cut - 1)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, s int")
    found = [r[0] for r in rows(df.withColumn("l", level_of(F.col("s"), levels)), "l")]
    names = [name for _, name in levels]
    expected = []
    for i in range(len(cuts)):
        expected += [names[i], names[i + 1]]
    assert found == expected


def test_actions(spark):
    pairs = [("High", "High", "urgent"), ("High", "Low", "high_priority"),
             ("High", "Medium", "high_priority"), ("Low", "High", "attention"),
             ("Medium", "High", "attention"), ("Medium", "Medium", "moderate"),
             ("Medium", "Low", "routine"), ("Low", "Medium", "routine"), ("Low", "Low", "routine")]
    df = spark.createDataFrame(
        [(i, f"{a} Churn Risk", f"{b} Credit Risk", c) for i, (a, b, c) in enumerate(pairs)],
        "id int, churn_risk string, credit_risk string, expected string",
    )
    done = rows(risk.add_actions(df), "action_code", "expected", "recommended_actions")
    assert all(code == expected and fv.ACTION_TEXTS[code] == text for code, expected, text in done)


def test_histogram_edges(spark):
    values = [0.0, 19.9, 20.0, 79.9, 80.0, 100.0, 100.1, 112.0]
    df = spark.createDataFrame([(v,) for v in values], "composite_risk_score double")
    plain = {r["bin"]: r["count"] for r in dashboard.score_histogram(df).collect()}
    assert plain == {"0-20": 2, "20-40": 1, "40-60": 0, "60-80": 1, "80-100": 2}
    more = {r["bin"]: r["count"] for r in dashboard.score_histogram(df, overflow=True).collect()}
    assert more[">100"] == 2


def test_correlation_of_a_constant_column_is_zero(spark):
    df = spark.createDataFrame(
        [(1, 7, 3.0), (2, 7, 1.0), (3, 7, None)], "pdays int, campaign int, cons_conf_idx double"
    )
    found = {
        (r["indicator_i"], r["indicator_j"]): r["value"]
        for r in dashboard.risk_correlation(df).collect()
    }
    assert len(found) == 9
    assert found[("pdays", "pdays")] == 1.0
    assert found[("pdays", "campaign")] == found[("campaign", "campaign")] == 0.0
    assert found[("pdays", "cons conf idx")] == -1.0


def test_empty_audience_still_shows(spark):
    df = spark.createDataFrame([], "contact_id long, potential_segment string, prediction double")
    found = simulation.compare_strategies(df).collect()
    assert [r["Strategy"] for r in found] == list(fv.STRATEGIES)
    assert {(r["Total Customers"], r["Expected Conversions"], r["Conversion Rate"])
            for r in found} == {(0, 0, 0.0)}


def test_rate_rounds_half_up(spark):
    df = spark.createDataFrame([(0, 1, 3), (1, 2, 3), (2, 1, 20000), (3, 0, 0)],
                               "id int, a long, b long")
    done = df.withColumn("r", half_up_ratio(F.col("a"), F.col("b"), 4))
    assert [r[0] for r in rows(done, "r")] == [0.3333, 0.6667, 0.0001, 0.0]


RULES = [
    # p, pdays, campaign, previous, conf, default, loan, housing, churn, credit
    (0.4, 91, 1, 1, -40.1, "no", "no", "no", "High", "High"),
    (0.4, 90, 6, 1, -40.0, "no", "yes", "no", "High", "Medium"),
    (0.4, 91, 6, 2, -20.1, "no", "no", "no", "Low", "Low"),
    (0.4, 90, 5, 0, -20.0, "no", "yes", "yes", "Low", "Low"),
    (0.5, 61, 1, 9, 0.0, "yes", "no", "no", "Medium", "High"),
    (0.8, 60, 4, 9, -30.0, "no", "no", "yes", "Medium", "Medium"),
    (0.8, 60, 3, 0, None, None, "yes", "yes", "Low", "Low"),
    (0.81, 31, 1, 0, -30.0, None, None, None, "Medium", "Low"),
    (0.81, 30, 9, 0, -30.0, "yes", "no", "no", "Low", "High"),
]


def test_decision_rules_and_text(spark):
    df = spark.createDataFrame(
        [(i, *r, 40, "student", "single", "illiterate", float(r[0] > 0.5))
         for i, r in enumerate(RULES)],
        "id int, p_yes double, pdays int, campaign int, previous int, cons_conf_idx double, "
        "`default` string, loan string, housing string, churn string, credit string, age int, "
        "job string, marital string, education string, prediction double",
    )
    done = decisions.decide(df, "id").join(df.select("id", "churn", "credit"), "id")
    for churn, credit, want_churn, want_credit, potential, text in rows(
        done, "churn_risk", "credit_risk", "churn", "credit", "potential",
        "marketing_recommendation",
    ):
        assert (churn, credit) == (f"{want_churn} Churn Risk", f"{want_credit} Credit Risk")
        assert text == (
            fv.RECOMMENDATION_BASE[potential] + fv.RECOMMENDATION_CHURN.get(churn, "")
            + fv.RECOMMENDATION_CREDIT.get(credit, "")
        )
    first = done.orderBy("id").first()
    assert (first["prediction"], first["probability"]) == ("否", "40.00%")
    assert first["customer_summary"]["job"] == "student"


def test_validation_flags_each_kind(spark):
    good = dict(
        age=40, job="student", marital="single", education="illiterate", default="no",
        housing="no", loan="no", contact="cellular", month="may", day_of_week="mon", campaign=1,
        pdays=-1, previous=0, poutcome="success", emp_var_rate=1.4, cons_price_idx=92.2,
        cons_conf_idx=-26.9, euribor3m=0.6, nr_employed=5228.0,
    )
    bad = dict(good, age=96, job="pilot", marital=None, education="", campaign=0, pdays=1000,
               previous=51, euribor3m=5.1, nr_employed=None)
    columns = list(good)
    kinds = ", ".join(
        f"`{c}` " + {int: "int", float: "double", str: "string"}[type(good[c])] for c in columns
    )
    df = spark.createDataFrame(
        [(i, *[r[c] for c in columns]) for i, r in enumerate((good, bad))], "id int, " + kinds
    )
    first, second = rows(decisions.validate_input(df), "errors", "warnings", "is_valid")
    assert first == ([], [], True)
    assert set(second[0]) == {
        "age:limit", "job:value", "marital:required", "education:required", "campaign:limit",
        "pdays:limit", "previous:limit", "nr_employed:required",
    }
    assert set(second[1]) == {
        "age:recommended", "campaign:recommended", "previous:recommended", "euribor3m:recommended",
    }
    counts = {r["rule"]: r["violations"] for r in decisions.validation_summary(df).collect()}
    assert counts["job:value"] == 1 and counts["loan:value"] == 0
