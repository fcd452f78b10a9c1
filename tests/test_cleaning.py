import math

from pyspark.sql import functions as F

from respondry.operators import cleaning, features
from respondry.plans.preparation import prepare
from respondry.sources import derived
from respondry.spec import TableSpec


def test_mode_ties_nulls_and_empty_columns(spark):
    df = spark.createDataFrame(
        [("b", None, "x"), ("a", None, None), ("b", None, None), ("a", None, None)],
        "tie string, nothing string, mostly_null string",
    )
    assert cleaning.mode_values(df) == {"tie": "a", "mostly_null": "x"}
    model = cleaning.CleaningModel("unknown", modes=cleaning.mode_values(df))
    filled = model.fill(df).collect()
    assert {r["mostly_null"] for r in filled} == {"x"}
    assert {r["nothing"] for r in filled} == {None}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (math.nan,), (None,)], "v double")
    assert cleaning.mean_values(df) == {"v": 2.0}
    model = cleaning.CleaningModel("unknown", means={"v": 2.0})
    assert sorted(r["v"] for r in model.fill(df).collect()) == [1.0, 2.0, 2.0, 3.0]


def test_statistics_come_before_the_range_filter(spark):
    spec = TableSpec(key="id", categorical=("job",), numeric=("age", "rate"), label="y", dropped=())
    df = spark.createDataFrame(
        [(1, 17, "a", 10.0, "no"), (2, 17, "a", 20.0, "no"), (3, 30, "unknown", None, "yes"),
         (4, None, "b", 30.0, "no"), (5, 101, "b", 40.0, "no"), (6, 100, "a", 50.0, "no")],
        "id long, age int, job string, rate double, y string",
    )
    model = cleaning.CleaningModel.fit(df, spec)
    assert model.means == {"rate": 30.0}
    kept = {r["id"]: r for r in model.transform(df).collect()}
    assert set(kept) == {3, 6}
    assert (kept[3]["job"], kept[3]["rate"]) == ("a", 30.0)
    assert model.transform(df, filter_rows=False).count() == 6


def test_model_survives_saving(spark, tmp_path, sf_dir):
    model = cleaning.CleaningModel.fit(derived.contact_table(spark, sf_dir))
    path = model.save(spark, str(tmp_path / "cleaning"))
    assert cleaning.CleaningModel.load(spark, path) == model


def test_fit_on_train_ignores_other_splits(spark, sf_dir):
    raw = derived.contact_table(spark, sf_dir)
    everything, train_only = prepare(raw), prepare(raw, fit_on="train")
    assert everything.cleaning.means != train_only.cleaning.means
    assert everything.features.count() == train_only.features.count()


def test_a_dictionary_numbers_as_the_labels_do(spark):
    """Ties, nulls, a value that a third of all rows share, values not in the dictionary."""
    df = spark.range(0, 3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id") % 500)).alias("a"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("b"),
    )
    labels = features.frequency_labels(df, ["a", "b"])
    strange = df.union(spark.createDataFrame([(10**6, "\x00", "z")], "id long, a string, b string"))
    for hot in (1000, 1):
        features.HOT_VALUES = hot
        try:
            dictionary = features.category_dictionary(df, ["a", "b"])
            got = features.index_by_dictionary(strange, ["a", "b"], dictionary, "id")
            expected = features.frequency_index(strange, ["a", "b"], labels)
            assert got.columns == expected.columns
            assert got.exceptAll(expected).isEmpty() and got.count() == 3001
        finally:
            features.HOT_VALUES = 1000


def test_a_million_categories(spark):
    df = spark.range(0, 1_100_000).select("id", F.concat(F.lit("c"), F.col("id") % 1_000_000).alias("a"))
    dictionary = features.category_dictionary(df, ["a"])
    got = features.index_by_dictionary(df, ["a"], dictionary, "id")
    row = got.agg(F.count("*"), F.countDistinct("a_index"), F.max("a_index"), F.count("a_index")).first()
    assert tuple(row) == (1_100_000, 1_000_000, 999_999.0, 1_100_000)
    # the hundred thousand that occur twice come first
    assert got.where("id < 100000").agg(F.max("a_index")).first()[0] < 100_000
