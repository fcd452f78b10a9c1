"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.operators import (
    cleaning,
    dashboard,
    decisions,
    evaluation,
    features,
    influence,
    oversampling,
    risk,
    segments,
    simulation,
    splitting,
    training,
    trees,
)
from respondry.operators.neighbours import row_neighbours
from respondry.plans import preparation
from respondry.sources import derived, models, tables
from respondry.sources.workspace import new_path, written
from respondry.spec import CONTACTS
from respondry.streaming import decisions as arrivals

KEY = CONTACTS.key
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- inputs --------------------------------------------------------------------------------


def _contacts(spark, sf_dir):
    return derived.contact_table(spark, sf_dir)


def _cleaned(spark, sf_dir):
    raw = _contacts(spark, sf_dir)
    return cleaning.CleaningModel.fit(raw).transform(raw)


def _cleaned_once(spark, sf_dir):
    """Written, for those who fit and apply."""
    return written(_cleaned(spark, sf_dir), "cleaned")


def _segmented(spark, sf_dir):
    return segments.segment_customers(derived.scored(spark, sf_dir))


def _assessed(spark, sf_dir):
    return risk.assess_risk(_segmented(spark, sf_dir), risk.outcome_labels(_contacts(spark, sf_dir)))


def _labelled_scores(spark, sf_dir):
    return derived.scored(spark, sf_dir).select(
        KEY, "p_yes", "prediction", features.label_expression().alias("label"),
        splitting.split_name(KEY).alias("split"),
    )


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources and sinks ---------------------------------------------------------------------


@query
def scan_csv(spark, sf_dir):
    path = new_path(spark, "contacts-csv")
    tables.write_contacts_csv(tables.dotted_names(_contacts(spark, sf_dir)), path)
    return tables.read_contacts_csv(spark, path, key=KEY)


@query
def normalize_names(spark, sf_dir):
    return tables.normalize_names(tables.dotted_names(_contacts(spark, sf_dir)))


@query
def scan_parquet(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/customer.parquet")


@query
def roundtrip_parquet(spark, sf_dir):
    path = new_path(spark, "contacts")
    tables.write_table(_contacts(spark, sf_dir), path)
    return tables.read_table(spark, path)


@query
def row_key(spark, sf_dir):
    """A key for a table without one."""
    return tables.with_row_key(_contacts(spark, sf_dir).drop(KEY), "row_key").select("row_key", "age", "job")


@query
def scan_csv_header(spark, sf_dir):
    """Columns in another order than the schema's."""
    path = new_path(spark, "contacts-csv")
    contacts = tables.dotted_names(_contacts(spark, sf_dir))
    tables.write_contacts_csv(contacts.select(*[F.col(f"`{c}`") for c in reversed(contacts.columns)]), path)
    return tables.read_contacts_csv(spark, path, key=KEY)


@query
def scan_csv_folder(spark, sf_dir):
    """A folder of files not written by one program: three orders of columns, one file without rows."""
    path = new_path(spark, "contacts-csv")
    contacts = tables.dotted_names(_contacts(spark, sf_dir))
    names = [f"`{c}`" for c in contacts.columns]
    for i, order in enumerate((names, names[::-1], names[3:] + names[:3])):
        part = contacts.where(F.col(KEY) % 3 == i).select(*order)
        tables.write_contacts_csv(part, f"{path}/{i}")
    tables.write_contacts_csv(contacts.limit(0).coalesce(1), f"{path}/3")
    return tables.read_contacts_csv(spark, f"{path}/*", key=KEY)


@query
def metrics_unlabelled(spark, sf_dir):
    """Areas where some rows have no label and others no score."""
    scores = _labelled_scores(spark, sf_dir)
    age = F.col(KEY) % 10
    scores = scores.withColumns({
        "label": F.when(age != 3, F.col("label")),
        "p_yes": F.when(age == 5, F.lit(float("nan"))).when(age != 4, F.col("p_yes")),
    })
    areas = evaluation.curve_areas(evaluation.outcome_counts(scores))
    return areas.select(F.round("roc_auc", 9).alias("auc"))


@query
def feature_model_reload(spark, sf_dir):
    cleaned = _cleaned_once(spark, sf_dir)
    path = models.save_model(features.fit_features(cleaned), new_path(spark, "feature-model"))
    table = features.feature_table(cleaned, models.load_features_model(path))
    return _rounded(features.vector_entries(table, KEY), "value")


# --- cleaning ------------------------------------------------------------------------------


@query
def clean_sentinel(spark, sf_dir):
    return cleaning.mark_missing(_contacts(spark, sf_dir))


@query
def impute_mean(spark, sf_dir):
    df = _contacts(spark, sf_dir).select(KEY, *fv.MACRO_COLUMNS)
    model = cleaning.CleaningModel(fv.MISSING_MARKER, means=cleaning.mean_values(df))
    return _rounded(model.fill(df), *fv.MACRO_COLUMNS)


@query
def impute_mode(spark, sf_dir):
    df = cleaning.mark_missing(
        _contacts(spark, sf_dir).select(KEY, *fv.CATEGORICAL_COLUMNS, fv.LABEL_COLUMN)
    )
    model = cleaning.CleaningModel(fv.MISSING_MARKER, modes=cleaning.mode_values(df))
    return model.fill(df)


@query
def filter_range(spark, sf_dir):
    return cleaning.filter_range(_contacts(spark, sf_dir), "age", *fv.AGE_RANGE)


@query
def clean_full(spark, sf_dir):
    return _rounded(_cleaned(spark, sf_dir), *fv.MACRO_COLUMNS)


# --- features, splits, oversampling --------------------------------------------------------


@query
def index_categories(spark, sf_dir):
    cleaned = _cleaned_once(spark, sf_dir)
    table = Pipeline(stages=features.category_stages()[:1]).fit(cleaned).transform(cleaned)
    return table.select(KEY, *[f"{c}_index" for c in fv.CATEGORICAL_COLUMNS])


@query
def index_by_dictionary(spark, sf_dir):
    """Categories of any number, as tables: the customer and the priority of every order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders = orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderpriority").alias("priority"))
    columns = ["customer", "priority"]
    indexed = features.index_by_dictionary(orders, columns, features.category_dictionary(orders, columns), "o_orderkey")
    return indexed.select("o_orderkey", "customer_index", "priority_index")


@query
def one_hot(spark, sf_dir):
    cleaned = _cleaned_once(spark, sf_dir)
    model = Pipeline(stages=features.category_stages()).fit(cleaned)
    return features.one_hot_positions(model.transform(cleaned))


@query
def standard_scale(spark, sf_dir):
    cleaned = _cleaned_once(spark, sf_dir)
    table = Pipeline(stages=features.scaling_stages()).fit(cleaned).transform(cleaned)
    scaled = vector_to_array("scaled_features")
    return table.select(
        KEY, *[F.round(scaled[i], 6).alias(c) for i, c in enumerate(fv.NUMERIC_COLUMNS)]
    )


@query
def assemble_features(spark, sf_dir):
    cleaned = _cleaned_once(spark, sf_dir)
    table = features.fit_features(cleaned).transform(cleaned)
    return _rounded(features.vector_entries(table, KEY), "value")


@query
def label_index(spark, sf_dir):
    return _cleaned(spark, sf_dir).select(KEY, features.label_expression().alias("label"))


@query
def feature_table(spark, sf_dir):
    prepared = preparation.prepare(_contacts(spark, sf_dir))
    size = F.size(vector_to_array("features"))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return prepared.features.select(
        KEY, "split", size.alias("slots"), F.round(total, 3).alias("total"), "label"
    )


@query
def split_assign(spark, sf_dir):
    return splitting.assign_split(_contacts(spark, sf_dir)).select(KEY, "split")


@query
def split_sizes(spark, sf_dir):
    prepared = preparation.prepare(_contacts(spark, sf_dir))
    balanced = preparation.balanced_training_table(prepared)
    return splitting.split_sizes(preparation.split_report_rows(prepared, balanced))


@query
def smote_balance(spark, sf_dir):
    prepared = preparation.prepare(_contacts(spark, sf_dir))
    balanced = preparation.balanced_training_table(prepared)
    return balanced.groupBy("label", "is_synthetic").count()


def _between(point, one, other):
    """Whether rows of ``point`` lie between those of two matrices, up to rounding."""
    span, gone = other - one, point - one
    along = np.einsum("ij,ij->i", span, span)
    step = np.einsum("ij,ij->i", gone, span) / np.where(along == 0, 1, along)
    rest = gone - step[:, None] * span
    return (step >= -1e-9) & (step <= 1 + 1e-9) & (np.einsum("ij,ij->i", rest, rest) < 1e-12)


def _lies_between(batches):
    """``(label, between)`` of rows with a ``point``, its parent's vector ``own`` and the ``others`` near that."""
    for batch in batches:
        own = batch.column("own").is_valid().to_numpy(zero_copy_only=False).nonzero()[0]
        between = np.zeros(batch.num_rows, bool)
        if len(own):
            known = batch.take(pa.array(own))
            point, parent = (known.column(c).flatten().to_numpy().reshape(len(own), -1) for c in ("point", "own"))
            others = known.column("others")
            sizes = others.value_lengths().to_numpy()
            row, near = np.repeat(np.arange(len(own)), sizes), others.flatten()
            alone = (sizes == 0) & (point == parent).all(1)
            near = near.flatten().to_numpy().reshape(-1, point.shape[1])
            inside = _between(point[row], parent[row], near)
            between[own] = alone | (np.bincount(row[inside], minlength=len(own)) > 0)
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(between)], names=["label", "between"])


@query
def smote_real_space(spark, sf_dir):
    """Synthetic rows of the training table, on its own one-hot and scaled vectors.

    Per row: whether it lies between its parent and one of the parent's nearest rows of the class.
    """
    prepared = preparation.prepare(_contacts(spark, sf_dir))
    balanced = preparation.balanced_training_table(prepared)
    train = prepared.split("train").select(KEY, "features", "label")
    missing = oversampling.balance_plan(train, "label")[1]
    points = oversampling.minority_points(train, KEY, "label", "features", missing)
    near = row_neighbours(points, "label", KEY, fv.OVERSAMPLE_NEIGHBOURS)
    near = near.select(F.col(KEY).cast("string").alias("parent"), F.col("vec").alias("own"), F.col("others.vec").alias("others"))
    made = balanced.where("is_synthetic").select(
        F.substring_index("row_key", "#", 1).alias("parent"), "label", vector_to_array("features").alias("point")
    )
    checked = made.join(near, "parent", "left").select("label", "point", "own", "others")
    checked = checked.mapInArrow(_lies_between, "label double, between boolean")
    return checked.groupBy("label").agg(F.count("*").alias("count"), F.every("between").alias("between"))


@query
def smote_multiclass_balance(spark, sf_dir):
    vectors = written(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vectors")
    grown = oversampling.oversample(vectors, "vec_id", "label", "embedding")
    return grown.groupBy("label", "is_synthetic").count()


def _whole_number_points(spark, sf_dir):
    """Training rows with whole-number vectors, whose squared distances are exact everywhere."""
    cleaned = _cleaned(spark, sf_dir).filter(splitting.split_name(KEY) == "train")
    flags = [(F.col(c) == "yes").cast("int") * 20 for c in ("default", "housing", "loan")]
    parts = [
        F.col("age"), F.col("campaign") * 5, F.least("pdays", F.lit(150)), F.col("previous") * 10,
        *flags, (F.col("contact") == "cellular").cast("int") * 20,
    ]
    vec = F.array(*[p.cast("double") for p in parts])
    return written(
        cleaned.select(KEY, features.label_expression().alias("label"), vec.alias("vec")), "points"
    )


@query
def smote_neighbours(spark, sf_dir):
    points = _whole_number_points(spark, sf_dir).filter("label = 1.0")
    found = row_neighbours(points, "label", KEY, fv.OVERSAMPLE_NEIGHBOURS)
    return found.select(KEY, F.posexplode("others").alias("place", "other")).select(
        KEY, "place", F.col("other.key").alias("neighbour"), F.col("other.d2").alias("d2")
    )


@query
def smote_points(spark, sf_dir):
    train = _whole_number_points(spark, sf_dir)
    sizes, missing = oversampling.balance_plan(train, "label")
    points = oversampling.minority_points(train, KEY, "label", "vec", missing)
    created = oversampling.synthetic_points(points, "label", KEY, missing, sizes)
    return created.select(
        KEY, "copy", "neighbour", "label",
        *[F.round(F.col("vec")[i], 6).alias(f"v{i}") for i in range(8)],
    )


# --- training and evaluation ---------------------------------------------------------------


def _fitted(spark, sf_dir, num_trees=20, max_depth=5):
    prepared = preparation.prepare(_contacts(spark, sf_dir))
    balanced = preparation.balanced_training_table(prepared)
    return prepared, training.fit_forest(balanced, num_trees, max_depth)


def _test_scores(prepared, model):
    return training.score(prepared.split("test"), model)


@query
def forest_fit(spark, sf_dir):
    """Test rows per label, and whether every score is a probability and agrees with the class."""
    prepared, model = _fitted(spark, sf_dir)
    p, shares = F.col("p_yes"), vector_to_array("probability")
    valid = p.between(0.0, 1.0) & (F.abs(shares[0] + shares[1] - 1) < 1e-9)
    agrees = (F.col("prediction") == 1.0) == (shares[1] > shares[0])
    return _test_scores(prepared, model).groupBy("label").agg(
        F.count("*").alias("count"), F.every(valid & agrees).alias("scores_valid")
    )


@query
def grid_search(spark, sf_dir):
    """The full grid, three folds, against AUCs from the ranks of the held-out predictions.

    Per grid point: its folds, the rows held out in all of them, and whether its AUC is the mean of
    theirs and it was chosen (and fitted again) exactly if no other point has a larger one.
    """
    prepared = preparation.prepare(_contacts(spark, sf_dir))
    balanced = preparation.balanced_training_table(prepared)
    folder, point = new_path(spark, "search"), ["num_trees", "max_depth"]
    model, report = training.grid_search(balanced, folder=folder)
    counts = evaluation.outcome_counts(training.search_results(spark, folder), [*point, "fold"])
    areas = evaluation.curve_areas(counts, [*point, "fold"]).groupBy(*point).agg(
        F.avg("roc_auc").alias("auc"), F.count("*").cast("int").alias("folds")
    )
    rows = counts.groupBy(*point).agg(F.sum(F.col("pos") + F.col("neg")).alias("rows"))
    checked = report.join(areas, point).join(rows, point)
    largest = checked.agg(F.max("auc").alias("largest"))
    refitted = (F.col("num_trees") == model.getNumTrees) & (F.col("max_depth") == model.getOrDefault("maxDepth"))
    leads = F.abs(F.col("auc") - F.col("largest")) < 1e-9
    agrees = (F.abs(F.col("avg_auc") - F.col("auc")) < 1e-9) & (F.col("is_best") == leads) & (refitted == leads)
    return checked.join(F.broadcast(largest)).select(*point, "folds", "rows", agrees.alias("agrees"))


def _walked(spark, scored, model, *columns):
    """``columns`` of scored rows, ``p_yes``, and whether it is the score found by walking the stored trees.

    Features, forest and walk run once per row; what is written and joined has no vectors. Rows that share
    a key are added up, and do not agree.
    """
    nodes = trees.node_table(spark, model)
    columns = list(dict.fromkeys([KEY, *columns, "p_yes", "prediction"]))
    depth = model.getOrDefault("maxDepth")
    rows = written(trees.with_walked_scores(scored, nodes, model.getNumTrees, depth, columns), "walked")
    walked = rows.groupBy(KEY).agg(F.sum("walked").alias("walked"))
    same = (F.abs(F.col("walked") - F.col("p_yes")) < 1e-9) & (
        (F.col("prediction") == 1.0) == (F.col("p_yes") > 0.5)
    )
    return rows.drop("walked").join(walked, KEY, "left").withColumn("agrees", F.coalesce(same, F.lit(False)))


@query
def score_table(spark, sf_dir):
    """Scores of all prepared rows, against those of the stored trees walked node by node."""
    prepared, model = _fitted(spark, sf_dir)
    scored = training.score(prepared.features, model)
    return _walked(spark, scored, model, "split", "label").select(KEY, "split", "label", "agrees")


@query
def forest_reload(spark, sf_dir):
    """All prepared rows: the stored forest scores as the fitted one, and as its trees walked node by node."""
    prepared, model = _fitted(spark, sf_dir)
    stored = models.load_forest(models.save_model(model, new_path(spark, "forest")))
    before = training.score(prepared.features, model).select(KEY, F.col("p_yes").alias("p_before"))
    after = _walked(spark, training.score(prepared.features, stored), stored, "split", "label")
    same = F.col("agrees") & (F.col("p_yes") == F.col("p_before"))
    return after.join(before, KEY).select(KEY, "split", "label", same.alias("unchanged"))


@query
def model_report(spark, sf_dir):
    """Rows of the held-out splits, and whether the report agrees with Spark's own evaluators."""
    prepared, model = _fitted(spark, sf_dir)
    scored = training.score(prepared.split("val", "test"), model).select("split", "label", "prediction", "p_yes", "rawPrediction")
    scored = written(scored, "held-out")
    rows = []
    for row in evaluation.evaluation_report(scored).collect():  # two rows
        part = scored.filter(F.col("split") == row["split"])
        others = {"auc": BinaryClassificationEvaluator(numBins=0).evaluate(part)} | {
            name: MulticlassClassificationEvaluator(metricName=metric).evaluate(part)
            for name, metric in (
                ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                ("weighted_recall", "weightedRecall"), ("f1", "f1"),
            )
        }
        rows.append((row["split"], part.count(), all(abs(row[c] - v) < 1e-9 for c, v in others.items())))
    return spark.createDataFrame(rows, "split string, rows long, agrees boolean")


@query
def metric_auc(spark, sf_dir):
    counts = evaluation.outcome_counts(_labelled_scores(spark, sf_dir))
    return evaluation.curve_areas(counts).select(F.round("roc_auc", 9).alias("auc"))


@query
def metrics_multiclass(spark, sf_dir):
    report = evaluation.class_metrics(evaluation.confusion(_labelled_scores(spark, sf_dir)))
    return _rounded(report, *report.columns, digits=9)


@query
def roc_curve(spark, sf_dir):
    counts = evaluation.outcome_counts(_labelled_scores(spark, sf_dir))
    return _rounded(evaluation.roc_curve(counts), "fpr", "tpr", digits=9)


@query
def pr_curve(spark, sf_dir):
    counts = evaluation.outcome_counts(_labelled_scores(spark, sf_dir))
    return _rounded(evaluation.pr_curve(counts), "precision", "recall", digits=9)


@query
def roc_auc(spark, sf_dir):
    counts = evaluation.outcome_counts(_labelled_scores(spark, sf_dir), ["split"])
    return evaluation.curve_areas(counts, ["split"]).select(
        "split", F.round("roc_auc", 9).alias("roc_auc")
    )


@query
def pr_auc(spark, sf_dir):
    counts = evaluation.outcome_counts(_labelled_scores(spark, sf_dir), ["split"])
    return evaluation.curve_areas(counts, ["split"]).select(
        "split", F.round("pr_auc", 9).alias("pr_auc")
    )


@query
def eval_report(spark, sf_dir):
    held_out = _labelled_scores(spark, sf_dir).filter(F.col("split").isin("val", "test"))
    report = evaluation.evaluation_report(held_out)
    return _rounded(report, *report.columns[1:], digits=9)


# --- feature influence ---------------------------------------------------------------------


@query
def feature_names(spark, sf_dir):
    cleaned = _cleaned_once(spark, sf_dir)
    table = features.fit_features(cleaned).transform(cleaned)
    named = influence.names_from_metadata(table)
    return spark.createDataFrame(
        [(i, *name) for i, name in enumerate(named)],
        "position int, feature string, source string",
    )


@query
def category_domain(spark, sf_dir):
    return features.category_domain(_contacts(spark, sf_dir))


@query
def feature_importance(spark, sf_dir):
    """The leading features, against the gains in the stored trees."""
    prepared, model = _fitted(spark, sf_dir)
    named = influence.names_from_metadata(prepared.features)
    positions = spark.createDataFrame([(n[0], i) for i, n in enumerate(named)], "feature string, position int")
    gained = trees.gain_importance(trees.node_table(spark, model))
    top = influence.feature_importance(model, named).join(positions, "feature", "left")
    same = F.abs(F.col("importance") - F.coalesce("gained", F.lit(0.0))) < 1e-9
    return top.join(gained, "position", "left").select("rank", same.alias("agrees"))


@query
def importance_by_source(spark, sf_dir):
    """Importance per column, against the gains in the stored trees."""
    prepared, model = _fitted(spark, sf_dir)
    named = influence.names_from_metadata(prepared.features)
    positions = spark.createDataFrame([(n[1], i) for i, n in enumerate(named)], "source string, position int")
    gained = trees.gain_importance(trees.node_table(spark, model))
    gained = positions.join(gained, "position", "left").groupBy("source").agg(
        F.coalesce(F.sum("gained"), F.lit(0.0)).alias("gained")
    )
    same = F.coalesce(F.abs(F.col("importance") - F.col("gained")) < 1e-9, F.lit(False))
    return influence.importance_by_source(model, named).join(gained, "source", "left").select(
        "source", same.alias("agrees")
    )


# --- segments and campaigns ----------------------------------------------------------------


@query
def segment_customers(spark, sf_dir):
    return _segmented(spark, sf_dir).select(KEY, "p_yes", "potential_segment")


@query
def segment_stats(spark, sf_dir):
    return segments.segment_stats(_segmented(spark, sf_dir))


def _audience(spark, sf_dir, strategy):
    return simulation.select_audience(_segmented(spark, sf_dir), strategy).select(
        KEY, "potential_segment", "prediction"
    )


@query
def strategy_high(spark, sf_dir):
    return _audience(spark, sf_dir, fv.STRATEGY_HIGH)


@query
def strategy_high_medium(spark, sf_dir):
    return _audience(spark, sf_dir, fv.STRATEGY_HIGH_MEDIUM)


@query
def strategy_random(spark, sf_dir):
    return _audience(spark, sf_dir, fv.STRATEGY_RANDOM)


@query
def marketing_simulation(spark, sf_dir):
    return simulation.compare_strategies(_segmented(spark, sf_dir))


# --- risk ----------------------------------------------------------------------------------


@query
def churn_score(spark, sf_dir):
    return _assessed(spark, sf_dir).select(KEY, "churn_risk_score")


@query
def credit_score(spark, sf_dir):
    return _assessed(spark, sf_dir).select(KEY, "credit_risk_score")


@query
def churn_level(spark, sf_dir):
    return _assessed(spark, sf_dir).select(KEY, "churn_risk", "churn_confidence")


@query
def credit_level(spark, sf_dir):
    return _assessed(spark, sf_dir).select(KEY, "credit_risk", "credit_confidence")


@query
def composite_risk(spark, sf_dir):
    return _assessed(spark, sf_dir).select(KEY, "composite_risk_score", "overall_risk_level")


@query
def recommended_actions(spark, sf_dir):
    return _assessed(spark, sf_dir).select(KEY, "action_code", "recommended_actions")


@query
def risk_rank(spark, sf_dir):
    return risk.rank_customers(_assessed(spark, sf_dir)).select(
        KEY, "composite_risk_score", "risk_priority_rank"
    )


@query
def risk_summary(spark, sf_dir):
    return _rounded(
        risk.risk_summary(_assessed(spark, sf_dir)),
        "avg_churn_score", "avg_credit_score", "avg_composite_score",
    )


@query
def risk_counts(spark, sf_dir):
    return risk.risk_counts(_assessed(spark, sf_dir))


@query
def risk_marginals(spark, sf_dir):
    return risk.risk_marginals(_assessed(spark, sf_dir))


@query
def risk_table(spark, sf_dir):
    """The whole risk table as stored for the dashboard."""
    path = new_path(spark, "risk")
    tables.write_table(risk.rank_customers(_assessed(spark, sf_dir)), path)
    return tables.read_table(spark, path).drop("action_code", "poutcome_index")


# --- dashboard -----------------------------------------------------------------------------


@query
def top_at_risk(spark, sf_dir):
    return dashboard.top_at_risk(_assessed(spark, sf_dir))


@query
def top_at_risk_limit(spark, sf_dir):
    return dashboard.top_by_score(_assessed(spark, sf_dir))


@query
def score_profile(spark, sf_dir):
    return _rounded(dashboard.score_profile(_assessed(spark, sf_dir)), "mean", "stddev")


@query
def score_histogram(spark, sf_dir):
    return dashboard.score_histogram(_assessed(spark, sf_dir))


@query
def score_histogram_overflow(spark, sf_dir):
    return dashboard.score_histogram(_assessed(spark, sf_dir), overflow=True)


@query
def risk_correlation(spark, sf_dir):
    return dashboard.risk_correlation(_assessed(spark, sf_dir), digits=6)


@query
def risk_correlation_nulls(spark, sf_dir):
    """Some indicators unknown: a pair is taken over the rows that have both."""
    assessed = _assessed(spark, sf_dir)
    unknown = {"pdays": F.col(KEY) % 7 == 3, "cons_conf_idx": F.col(KEY) % 5 == 1}
    assessed = assessed.withColumns({c: F.when(~missing, F.col(c)) for c, missing in unknown.items()})
    return dashboard.risk_correlation(assessed, digits=6)


# --- customer decisions --------------------------------------------------------------------


def _text_contacts(spark, sf_dir):
    """Contacts as text, with values that do not convert in some rows."""
    df = _contacts(spark, sf_dir).drop("duration", "y")
    spoilt = F.when(F.col(KEY) % 101 == 0, "n/a").otherwise(F.col("age").cast("string"))
    empty = F.when(F.col(KEY) % 103 == 0, "").otherwise(F.col("euribor3m").cast("string"))
    numbers = {c: F.col(c).cast("string") for c in fv.NUMERIC_COLUMNS}
    return df.withColumns({**numbers, "age": spoilt, "euribor3m": empty})


@query
def typed_input(spark, sf_dir):
    return decisions.typed_input(_text_contacts(spark, sf_dir)).withColumn(
        "bad_columns", F.concat_ws(",", "bad_columns")
    )


@query
def validate_input(spark, sf_dir):
    return decisions.validate_input(_contacts(spark, sf_dir)).select(
        KEY, F.concat_ws(",", "errors").alias("errors"),
        F.concat_ws(",", "warnings").alias("warnings"), "is_valid",
    )


@query
def validation_summary(spark, sf_dir):
    return decisions.validation_summary(_contacts(spark, sf_dir))


@query
def rule_churn(spark, sf_dir):
    return decisions.apply_rules(derived.scored(spark, sf_dir)).select(KEY, "churn_risk")


@query
def rule_credit(spark, sf_dir):
    return decisions.apply_rules(derived.scored(spark, sf_dir)).select(KEY, "credit_risk")


@query
def marketing_recommendation(spark, sf_dir):
    return decisions.apply_rules(derived.scored(spark, sf_dir)).select(
        KEY, "marketing_recommendation"
    )


@query
def decide_customers(spark, sf_dir):
    return decisions.decide(derived.scored(spark, sf_dir)).select(
        KEY, "prediction", "probability", "potential", "churn_risk", "credit_risk",
        "marketing_recommendation", "customer_summary.*",
    )


@query
def decide_stream(spark, sf_dir):
    """Scored contacts that arrive as files; the stream ends after the first ones and is started again."""
    folder, out, checkpoint = (new_path(spark, name) for name in ("arriving", "decided", "decided-checkpoint"))
    scored = derived.scored(spark, sf_dir)
    for part in range(2):
        scored.where(F.pmod(F.xxhash64(KEY), F.lit(2)) == part).write.mode("append").parquet(folder)
        arriving = arrivals.incoming_contacts(spark, folder, scored.schema, files_per_batch=2)
        arrivals.start_decisions(decisions.decide(arriving), out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(
        KEY, "prediction", "probability", "potential", "churn_risk", "credit_risk",
        "marketing_recommendation", "customer_summary.*",
    )


def _decided(spark, raw, prepared, model):
    """Decisions next to what they say about the customer, and whether they follow from walked scores."""
    scored = preparation.score_contacts(raw, prepared.cleaning, prepared.features_model, model)
    asked = ["loan", "housing", "default", "pdays", "campaign", "previous", "cons_conf_idx", *fv.SUMMARY_COLUMNS]
    walked = written(_walked(spark, scored, model, *asked), "agreeing")
    checked = walked.select(KEY, "agrees", "p_yes")
    band = (
        F.when(F.col("p_yes") > 0.8, "High Potential")
        .when(F.col("p_yes") >= 0.5, "Medium Potential")
        .otherwise("Low Potential")
    )
    return decisions.decide(walked).join(checked, KEY).withColumn(
        "agrees", F.col("agrees") & (F.col("potential") == band)
    )


@query
def decide_with_model(spark, sf_dir):
    """Raw contacts through cleaning, features, forest and rules."""
    prepared, model = _fitted(spark, sf_dir)
    decided = _decided(spark, _contacts(spark, sf_dir), prepared, model)
    return decided.select(KEY, "customer_summary.*", "agrees")


@query
def decide_text_input(spark, sf_dir):
    """Contacts as text, some numbers unreadable: every contact still gets a decision."""
    prepared, model = _fitted(spark, sf_dir)
    typed = decisions.typed_input(_text_contacts(spark, sf_dir))
    decided = _decided(spark, typed, prepared, model)
    return typed.select(KEY, F.concat_ws(",", "bad_columns").alias("bad_columns")).join(decided, KEY, "left").select(
        KEY, "bad_columns", F.coalesce("agrees", F.lit(False)).alias("agrees")
    )
