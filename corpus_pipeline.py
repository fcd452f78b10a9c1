"""A training corpus from ``documents``: five stages, each written and read again.

Language ID drops texts without a language, with an unsure one, or of words unlike those of any language
learnt, and names the language in ``lang``; the quality classifier drops bad texts; near-dedup keeps the
document with the smallest id of every group of texts whose SimHash fingerprints (three words, at most two
bits apart) are linked, directly or through others; personal data is replaced by the name of its kind; what is left is packed into sequences. Stages take the columns
of ``documents``, with others beside them, and all but the last return those. Null text has no language
and goes in the first stage. A null id is no reason to drop a row; in a group it comes after every other id.
Rows that repeat an id are documents of their own: near-dedup keeps one row of a group, of equal ids the
first as read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.llm import language, packing, personal, quality, queries, simhash
from respondry.llm.common import table
from respondry.sources.workspace import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Posterior below which a language counts as unsure.
SURE = 0.5
#: Share of a text's words, or of their longest n-grams, that its language must have been seen to use.
FAMILIAR = 0.65
#: Words of a shingle, and bits by which fingerprints of a group may differ.
LENGTH, RADIUS = 3, 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = language.predict(docs, queries.language_model(docs), familiar=True)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= SURE) & (F.col("familiar") >= FAMILIAR)
    found = found.where(known)
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = queries.quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where(F.col("score") >= 0.3).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    groups = docs.select("row", "doc_id").join(simhash.groups(docs, "row", RADIUS, LENGTH), "row")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    least = groups.groupBy("component_id").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1")
    others = groups.join(least, "component_id").where(F.col("row") != F.col("least.row")).select("row")
    return docs.join(others, "row", "left_anti").select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = personal.redact(docs.select(*COLUMNS))
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, queries.VOCABULARY, "doc_id")


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack),
]

#: The models and the tokenizer have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
