"""The dealt operators as registered queries, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.llm import alignment, bpe, conversations, exactdup, language, neardup, neighbours, packing, perplexity, personal, quality, simhash, warc
from respondry.llm.common import remainder, table
from respondry.sources.workspace import new_path, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Learnt from the labelled ``docs`` that are not held out."""
    return quality.train(docs, labels.where(~remainder("doc_id", 5, 0)), "doc_id", "quality")


def language_model(docs: DataFrame) -> language.Model:
    return language.train(docs.where(~remainder("doc_id", 4, 2)), F.col("doc_id"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality_model(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", remainder("doc_id", 5, 0).alias("held_out"), "score", predicted)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", remainder("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), VOCABULARY, "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    # the pages have no time of capture: one second apart in order of their ids
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)))
    folder = warc.write_archives(pages, "page_id", "url", "html", captured)
    index = warc.history(warc.read_archives(spark, folder))
    return index.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.found(table(spark, sf_dir, "documents"), "doc_id")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder("doc_id", 7, 2)
    return perplexity.train_and_score(docs, "doc_id", ~held).withColumn("held_out", held)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.col("vec_id") % 50 == 0
    return neighbours.search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", asks)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), "doc_id")
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY, "doc_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the larger ids first: what the index has by then is what stays."""
    docs = exactdup.digests(table(spark, sf_dir, "documents"), "doc_id")
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    later = F.coalesce(F.col("doc_id") >= F.lit(middle), F.lit(False))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "digest-index")
    index = exactdup.DigestIndex.opened(spark, path, f"digests_{path[-32:]}", buckets=buckets)
    parts = [
        written(exactdup.deduplicated(index, docs.where(part), "doc_id", name), name)
        for name, part in (("later", later), ("earlier", ~later))
    ]
    index.close()
    rows = parts[0].unionByName(parts[1])
    sizes = written(rows.groupBy("digest").agg(F.count("*").alias("group_size")), "sizes")
    rows = exactdup.with_groups(rows.drop("group_size"), sizes, ["group_size"])
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return rows.select("doc_id", "keep_id", "group_size", "kept", digest)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), "doc_id", VOCABULARY, PIECES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_language_id, op3_best_fit_packing, op4_warc, op5_embedding_near_dedup,
        op6_pii, op7_lm_scoring, op8_nearest_neighbours, op9_simhash_near_dedup, op10_bpe,
        op11_conversation_repair, op12_exact_dedup, op13_token_alignment,
    )
}

SQL = {
    "op4_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest,
                   CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
            FROM pages
        ), w AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first AND first IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM w
    """,
    "op5_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
        ), pairs AS (
            SELECT a.vec_id AS one, b.vec_id AS two FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.x, b.x) >= 0.98
        ), reach(one, two) AS (
            SELECT one, two FROM pairs UNION SELECT r.one, p.two FROM reach r JOIN pairs p ON r.two = p.one
        )
        SELECT e.vec_id, (SELECT count(*) FROM pairs p WHERE p.one = e.vec_id) AS n_links,
               least(e.vec_id, (SELECT min(two) FROM reach r WHERE r.one = e.vec_id)) AS component_id,
               e.vec_id = least(e.vec_id, (SELECT min(two) FROM reach r WHERE r.one = e.vec_id)) AS kept
        FROM embeddings e
    """,
    "op12_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY plain)
    """,
}
