"""Time each report against its one-job-per-number form, on the same stored table.

Prints one JSON line: seconds of both forms per report. The plain forms are what a direct
translation into separate actions would do; they exist only here.
"""

from __future__ import annotations

import json
import os
import time

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.operators import cleaning, dashboard, oversampling, risk, segments, simulation
from respondry.plans import catalogue, preparation
from respondry.plans.session import session
from respondry.sources import derived
from respondry.sources.workspace import written

SCORE = "composite_risk_score"


def plain_correlation(t):
    pairs = [(a, b) for a in fv.RISK_INDICATORS for b in fv.RISK_INDICATORS]
    return [t.stat.corr(a, b) for a, b in pairs]


def plain_histogram(t):
    return [t.filter((F.col(SCORE) >= a) & (F.col(SCORE) < b)).count() for a, b in fv.SCORE_BINS]


def plain_strategies(t):
    chosen = [simulation.select_audience(t, s) for s in fv.STRATEGIES]
    return [(c.count(), c.filter("prediction = 1.0").count()) for c in chosen]


def plain_marginals(t):
    return [t.groupBy(c).count().collect()
            for c in ("churn_risk", "credit_risk", "overall_risk_level")]


def plain_rank(t):
    sink(t.withColumn("r", F.rank().over(Window.orderBy(F.desc(SCORE)))))


def plain_segments(t):
    band = F.udf(lambda p: "High" if p > 0.8 else "Medium" if p >= 0.5 else "Low", "string")
    return t.withColumn("s", band("p_yes")).groupBy("s").count().collect()


def plain_fill(t):
    for name, kind in t.dtypes:
        if kind == "double":
            t.agg(F.avg(name)).first()
        elif kind == "string":
            t.groupBy(name).count().orderBy(F.desc("count")).first()


def plain_oversample(train):
    """Everything on the driver."""
    rows = train.filter("label = 1.0").select("features").collect()
    rest = train.filter("label = 0.0").select("features").collect()
    few = np.array([r[0].toArray() for r in rows])
    norms = (few * few).sum(1)
    near = np.empty((len(few), 5), int)
    for s in range(0, len(few), 512):
        d2 = norms[s:s + 512, None] + norms[None, :] - 2 * few[s:s + 512] @ few.T
        near[s:s + 512] = np.argsort(d2, axis=1)[:, 1:6]
    rng = np.random.default_rng(42)
    need = len(rest) - len(few)
    parent = rng.integers(0, len(few), need)
    mate = near[parent, rng.integers(0, 5, need)]
    made = few[parent] + rng.random((need, 1)) * (few[mate] - few[parent])
    spark = train.sparkSession
    everything = [r[0].toArray().tolist() for r in rest] + few.tolist() + made.tolist()
    written(spark.createDataFrame([(v,) for v in everything], "features array<double>"), "plain")


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("compare", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    contacts = written(derived.contact_table(spark, sf_dir), "contacts")
    t = written(catalogue._assessed(spark, sf_dir), "assessed")
    prepared = preparation.prepare(contacts)
    train = written(prepared.split("train").select("contact_id", "features", "label"), "split")
    pairs = {
        "risk_correlation": (lambda: dashboard.risk_correlation(t).collect(),
                             lambda: plain_correlation(t)),
        "score_histogram": (lambda: dashboard.score_histogram(t).collect(),
                            lambda: plain_histogram(t)),
        "marketing_simulation": (lambda: simulation.compare_strategies(t).collect(),
                                 lambda: plain_strategies(t)),
        "risk_marginals": (lambda: risk.risk_marginals(t).collect(), lambda: plain_marginals(t)),
        "risk_rank": (lambda: sink(risk.rank_customers(t)), lambda: plain_rank(t)),
        "segment_stats": (
            lambda: segments.segment_stats(segments.segment_customers(t)).collect(),
            lambda: plain_segments(t)),
        "fill_values": (lambda: cleaning.CleaningModel.fit(contacts),
                        lambda: plain_fill(cleaning.mark_missing(contacts))),
        "oversampling": (lambda: written(oversampling.oversample(train), "train"),
                         lambda: plain_oversample(train)),
    }
    result = {}
    for name, (ours, plain) in pairs.items():
        ours(), plain()
        result[name] = {"this": timed(ours), "separate_jobs": timed(plain)}
    spark.stop()
    print(json.dumps({"sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "seconds": result}))


if __name__ == "__main__":
    main()
