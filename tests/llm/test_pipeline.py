"""The pipeline and the registered queries on the small tables."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
from respondry.llm import bpe, exactdup, language, neardup, neighbours, packing, perplexity, personal, quality, queries, simhash, warc
from respondry.llm.common import table
from tests.compare import difference, duck_result, spark_result


def test_every_stage_keeps_the_columns_and_only_drops_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs.withColumn("extra", F.lit(1)), sf_dir).cache()
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        assert 0 < docs.count() <= before
        before = docs.count()
    labels = table(spark, sf_dir, "labels")
    good = table(spark, sf_dir, "documents").join(labels.where("quality = 1"), "doc_id")
    scored = queries.op1_quality_classifier(spark, sf_dir).join(good, "doc_id")
    assert scored.where("predicted = 0").count() <= 0.02 * scored.count()


def test_the_pipeline_keeps_one_of_each_group(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    kept = packed.select("doc_id").distinct()
    groups = queries.op9_simhash_near_dedup(spark, sf_dir).join(kept, "doc_id")
    assert groups.groupBy("component_id").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf_dir, connection, name):
    assert not difference(duck_result(connection, queries.SQL[name]), spark_result(queries.QUERIES[name](spark, sf_dir)))


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(queries.SQL) <= set(__spark_entry__.oracle_sql())


def test_held_out_language(spark, sf_dir):
    found = queries.op2_language_id(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95


def texts_of(seed, count, words=200):
    random_ = random.Random(seed)
    return [" ".join("".join(random_.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(words)) for _ in range(count)]


def frame(spark, rows):
    """Documents with an extra column under a name that stages use themselves."""
    rows = [(i, x, "en", "s", len(x or ""), "clash") for i, x in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


def test_near_dedup_equals_brute_force(spark, sf_dir):
    random_, rows = random.Random(5), []
    for text in texts_of(1, 30):
        for _ in range(4):
            words = text.split(" ")
            for _ in range(random_.choice([0, 1, 1, 2, 5])):
                words[random_.randrange(len(words))] = "changed"
            rows.append((len(rows), " ".join(words)))
    rows += [(1000, ""), (1001, "  "), (1002, "one two"), (1003, "One two")]
    prints = [simhash.fingerprint(x.encode()) for _, x in rows]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j, y in enumerate(prints) if (x ^ y).bit_count() <= 2) for x in prints]
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), sf_dir).collect()}
    assert kept == {rows[i][0] for i in set(label)}


def test_near_dedup_keeps_one_row_of_repeated_ids(spark, sf_dir):
    one, two, three, four = texts_of(9, 4)
    rows = [(7, one), (7, one), (7, two), (3, two), (7, three), (None, four), (None, four), (None, one)]
    rows = [(i, x, "en", "s", len(x)) for i, x in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()]
    assert sorted(kept, key=str) == sorted([(7, one), (3, two), (7, three), (None, four)], key=str)


ODD = [
    (None, "no id at all, and the text is here"), (1, None), (2, ""), (3, " \t"), (4, "x"), (4, "x"), (5, "the " * 200_000),
    (6, "a" * 10**6), (7, "x" + " " * 10**6 + "y"), (8, "\n" * 10**6), (9, "mail me: a.b@c.de, token = 'abcdef0123456789'"),
]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_every_stage_takes_odd_and_empty_tables(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = frame(spark, ODD).withColumn("n_chars", F.lit(None).cast("long"))
    rows = stage(spark, docs, sf_dir).collect()
    ids = [r["doc_id"] for r in rows]
    if name == "simhash_near_dedup":
        assert sorted(ids, key=str) == sorted([None, 1, 4, 5, 6, 7, 9], key=str)
    if name == "pii":
        text = {r["doc_id"]: r["text"] for r in rows}
        assert len(rows) == len(ODD) and text[9] == "mail me: [EMAIL], token = '[SECRET]'" and text[1] is None and text[7] == ODD[8][1]
    if name == "best_fit_packing":
        tokenizer = Tokenizer.from_file(queries.VOCABULARY)
        expected = Counter()
        for i, x in ODD:
            found = [*tokenizer.encode(x or "", add_special_tokens=False).ids, 0]
            for piece, (start, length) in enumerate(packing.cut(len(found), 2048)):
                crc = zlib.crc32(np.array(found[start : start + length], "<u4").tobytes())
                expected[(i, piece, start, length, crc)] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    empty = stage(spark, docs.limit(0), sf_dir)
    assert empty.isEmpty()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert empty.columns == list(corpus_pipeline.COLUMNS)


def test_packed_pieces_have_the_ids_of_the_library(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    expected = Counter()
    for r in docs.collect():
        found = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for piece, (start, length) in enumerate(packing.cut(len(found), 2048)):
            expected[(r["doc_id"], piece, start, length, zlib.crc32(np.array(found[start : start + length], "<u4").tobytes()))] += 1
    rows = queries.op3_best_fit_packing(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected


def test_the_language_stage_drops_languages_not_learnt(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*corpus_pipeline.COLUMNS)
    strange = [
        (10**9, "Wczoraj wieczorem poszliśmy razem do kina i obejrzeliśmy nowy polski film o miłości."),
        (10**9 + 1, "这是一个中文句子，用来测试。"), (10**9 + 2, "Це речення українською мовою для перевірки."),
    ]
    every = docs.union(frame(spark, strange).select(*corpus_pipeline.COLUMNS))
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, every, sf_dir).select("doc_id").collect()}
    assert not kept & {i for i, _ in strange}
    good = table(spark, sf_dir, "labels").where("quality = 1").join(docs.where("lang IS NOT NULL"), "doc_id").select("doc_id").collect()
    assert good and all(r["doc_id"] in kept for r in good)


def clashing(df, names):
    """``df`` with extra columns under names that operators use themselves."""
    return df.withColumns({n: F.lit("x") for n in names.split() if n not in df.columns})


def test_extra_columns_clash_with_nothing(spark, sf_dir):
    pages = clashing(table(spark, sf_dir, "pages"), "first digest bytes share n run key captured url_key payload_bytes record_type refers_to value")
    folder = warc.write_archives(pages, "page_id", "url", "html", F.timestamp_seconds(F.coalesce("page_id", F.lit(0))))
    assert warc.history(warc.read_archives(spark, folder)).count() == pages.count()
    vectors = clashing(table(spark, sf_dir, "embeddings"), "id vector number list visited component_id kept n_links key dims asks group score rank i j")
    assert neardup.near_duplicates(vectors, "vec_id", "embedding", "label").count() == vectors.count()
    asks = F.col("vec_id") % 50 == 0
    found = neighbours.search(vectors, "vec_id", "embedding", asks)
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.count() == 5 * vectors.where(asks).count()
    names = "token n number ids fingerprint component_id piece start length share rank score lang_pred key lot pairs digest row held_out logs base spans"
    docs = clashing(table(spark, sf_dir, "documents"), names)
    n, labels = docs.count(), table(spark, sf_dir, "labels")
    assert quality.score(docs, quality.train(docs, labels, "doc_id", "quality")).count() == n
    assert language.predict(docs, language.train(docs, F.col("doc_id"))).count() == n
    assert personal.found(docs, "doc_id").count() == simhash.groups(docs, "doc_id").count() == n
    assert bpe.digests(docs, queries.VOCABULARY, "doc_id").count() == exactdup.digests(docs, "doc_id").count() == n
    model = perplexity.train(docs, perplexity.Settings(sweeps=2))
    assert perplexity.score(docs, "doc_id", model).count() == n
