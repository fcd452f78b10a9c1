from pyspark.sql import Window
from pyspark.sql import functions as F

from respondry.operators import cumulative, evaluation, selection
from respondry.operators.selection import first_by_hash


def windowed(df, groups, descending):
    w = Window.partitionBy(*groups).orderBy(F.desc("v") if descending else F.asc("v"))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({
        "a_total": F.sum("a").over(upto), "b_total": F.sum("b").over(upto),
        "a_next": F.lead("a").over(w), "b_next": F.lead("b").over(w),
    })


def numbers(spark, rows):
    return spark.range(0, rows).select(
        ((F.col("id") * 7919) % rows).cast("double").alias("v"), (F.col("id") % 2).alias("g"),
        (F.col("id") % 13).alias("a"), (F.col("id") % 5).alias("b"),
    )


def same_rows(one, two):
    one, two = one.select(sorted(one.columns)), two.select(sorted(two.columns))
    return one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_ranges_match_a_single_window(spark):
    df = numbers(spark, 3000)
    for groups in ([], ["g"]):
        for descending in (False, True):
            expected = windowed(df, groups, descending)
            for ranges in (None, 1, 100):
                assert same_rows(
                    cumulative.running_totals(df, "v", ["a", "b"], groups, descending, True, ranges), expected
                )
            assert same_rows(
                cumulative.running_totals(df, "v", ["a", "b"], groups, descending, True, small=True), expected
            )


def test_ten_thousand_ranges(spark):
    """Neither the plan nor what the driver sees grows with the number of ranges."""
    df = numbers(spark, 20_000)
    few, many = (cumulative.running_totals(df, "v", ["a", "b"], [], True, True, n) for n in (10, 10_000))
    assert same_rows(many, windowed(df, [], True))
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (few, many)]
    assert abs(len(plans[0]) - len(plans[1])) < 300


def test_ranges_of_equal_and_no_values(spark):
    empty = numbers(spark, 10).limit(0)
    assert cumulative.running_totals(empty, "v", ["a"], with_next=True).isEmpty()
    one = numbers(spark, 10).where("v = 3")
    row = cumulative.running_totals(one, "v", ["a"], ["g"], with_next=True, ranges=4).first()
    assert row["a_total"] == row["a"] and row["a_next"] is None


def test_curves_do_not_depend_on_ranges(spark, monkeypatch):
    df = spark.range(0, 4000).select(
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 997).alias("p_yes"),
        (F.pmod(F.hash("id"), F.lit(3)) == 0).cast("double").alias("label"),
    )
    counts = evaluation.outcome_counts(df)
    results, ranged = [], cumulative.in_ranges
    for ranges in (1, 50):
        monkeypatch.setattr(cumulative, "in_ranges", lambda df, column, _, n=ranges: ranged(df, column, n))
        results.append([evaluation.roc_curve(counts).collect(), evaluation.pr_curve(counts).collect(),
                        evaluation.curve_areas(counts).collect()])
    whole, split = results
    assert whole[0] == split[0] and whole[1] == split[1]
    assert abs(whole[2][0]["roc_auc"] - split[2][0]["roc_auc"]) < 1e-12


def test_exact_auc_agrees_with_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(0, 2000).select(
        (F.pmod(F.xxhash64("id"), F.lit(500)) / 500).alias("p_yes"),
        (F.pmod(F.hash("id"), F.lit(4)) == 0).cast("double").alias("label"),
    )
    exact = evaluation.curve_areas(evaluation.outcome_counts(df)).first()["roc_auc"]
    other = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="p_yes").evaluate(df)
    assert abs(exact - other) < 1e-9


def test_exact_number_of_rows_by_hash(spark):
    df = spark.range(0, 5000).select("id", (F.col("id") % 3).alias("g"))
    wanted = {0: 1, 1: 777, 2: 0}
    for parts in (1, 5):
        chosen = df.repartition(parts).filter(first_by_hash(df, "g", "id", ":t:", wanted))
        found = {r["g"]: r["count"] for r in chosen.groupBy("g").count().collect()}
        assert found == {0: 1, 1: 777}


def test_first_by_hash_where_hashes_tie(spark, monkeypatch):
    """All keys share one hash: they are told apart by another, and the driver sees few rows."""
    real = selection.hash_unit
    flat = lambda key, salt: F.lit(5).cast("long") if salt == ":t:" else real(key, salt)
    monkeypatch.setattr(selection, "hash_unit", flat)
    df = spark.range(0, 300_000).select("id", (F.col("id") % 2).alias("g"))
    chosen = df.filter(first_by_hash(df, "g", "id", ":t:", {0: 12_345, 1: 1}))
    assert {r["g"]: r["count"] for r in chosen.groupBy("g").count().collect()} == {0: 12_345, 1: 1}


def test_first_by_hash_with_a_million_equal_keys(spark):
    df = spark.range(0, 1_000_000).select(F.lit(7).alias("id"), F.lit(0).alias("g")).union(spark.range(8, 20).selectExpr("id", "0 AS g"))
    chosen = df.filter(first_by_hash(df, "g", "id", ":t:", {0: 3})).select("id").distinct().collect()
    order = [r["id"] for r in df.select("id", selection.hash_unit(F.col("id"), ":t:").alias("h")).distinct().orderBy("h").collect()]
    assert [r["id"] for r in chosen] == [7] if order[:3].count(7) else sorted(r["id"] for r in chosen) == sorted(order[:3])
