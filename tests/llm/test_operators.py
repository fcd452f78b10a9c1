"""Every dealt operator: brute force on a small fixture, and nulls, empty texts, repeats, empty tables."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from respondry.llm import bpe, components, language, neardup, neighbours, packing, perplexity, personal, quality, simhash, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, score string, lang_pred string"
WORDS = "the of and in to was by red blue one two".split()


def text_of(n, seed):
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) + str(chosen.randint(0, 30)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, text_of(50, 4)), (5, text_of(50, 4)), (6, text_of(50, 4) + " more"),
        (None, "no id"), (7, "une Éa²b 中文 😀 <|endoftext|> x@y.zz"), (8, text_of(9000, 8)), (9, "x"), (9, "x"), (10, "!!! 12"),
    ]
    return spark.createDataFrame([(i, t, "en", None, "clash", None) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 9), (9, 8), (5, 5), (None, 4), (3, 2)] + [(100 + i, 101 + i) for i in range(40)]
    found = components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    got = dict(map(tuple, found))
    assert len(found) == len(got)
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8} | {100 + i: 100 for i in range(41)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").isEmpty()


def test_language_backs_off_and_handles_odd_rows(spark, docs, nothing):
    rows = [(i, f"the house and the {w}", "en") for i, w in enumerate(["river", "forest", "water"])]
    rows += [(10 + i, f"das haus und der {w}", "de") for i, w in enumerate(["fluss", "wald", "wasser"])]
    train = spark.createDataFrame(rows + [(20, None, "fr"), (21, "x", None)], "doc_id long, text string, lang string")
    model = language.train(train, F.col("doc_id"))
    assert model.languages == ("de", "en") and "the" in model.words and "river" not in model.words
    assert language.score(model, "wasserfluss", {})[0] == "de"
    assert language.score(model, "12 !!", {}) == language.score(model, None, {}) == ("und", 0.0)
    found = language.predict(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score"]
    assert found.count() == 12
    assert found.where("lang_pred = 'und'").count() == 4
    assert language.predict(nothing, model).isEmpty()
    assert language.predict(docs, language.train(nothing, F.col("doc_id"))).where("lang_pred <> 'und'").isEmpty()


def test_marginals_equal_enumeration():
    chosen = np.random.default_rng(1)
    sizes, moves = np.array([3, 1, 4]), chosen.normal(size=(2, 2))
    good = chosen.normal(size=8)
    p, pairs, total = quality.marginals(good, sizes, moves)
    expected, z_sum, start = [], 0.0, 0
    for n in sizes:
        weights = {}
        for code in range(1 << n):
            states = [(code >> i) & 1 for i in range(n)]
            value = sum(good[start + i] for i in range(n) if states[i]) + sum(moves[a, b] for a, b in zip(states, states[1:]))
            weights[tuple(states)] = np.exp(value)
        z = sum(weights.values())
        z_sum += np.log(z)
        expected += [sum(w for s, w in weights.items() if s[i]) / z for i in range(n)]
        start += n
    assert np.allclose(p, expected) and np.isclose(total, z_sum) and np.isclose(pairs.sum(), 5)


def test_quality_separates_and_scores_every_row(spark, docs, nothing):
    rows = [(i, text_of(40, i), 1) for i in range(40)] + [(100 + i, text_of(40, i).replace(" ", "### "), 0) for i in range(40)]
    train = spark.createDataFrame(rows + [(500, "a", None)], "doc_id long, text string, label int")
    model = quality.train(train.drop("label"), train.drop("text"), "doc_id", "label")
    good, bad = quality.score_texts(model, [text_of(40, 99), text_of(40, 98).replace(" ", "### ")])
    assert good > 0.8 and bad < 0.2
    scored = quality.score(docs, model)
    assert scored.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score"]
    assert scored.where("score between 0 and 1").count() == 12
    assert quality.score(nothing, model).isEmpty()
    empty = quality.train(nothing, nothing.select("doc_id", F.lit(None).alias("label")), "doc_id", "label")
    assert quality.score_texts(empty, [None]) == [0.5]


def test_fingerprints_and_groups_equal_brute_force(spark, docs, nothing):
    chosen = random.Random(5)
    texts = []
    for i in range(60):
        base = text_of(200, i % 12).split(" ")
        base[chosen.randrange(200)] = "changed" + str(i)
        texts.append(" ".join(base))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string")
    prints = []
    for text in [*texts, "", ""]:
        found = text.encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + 3]), 42) for i in range(max(len(found) - 2, 0))]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    label = list(range(62))
    for _ in range(62):
        label = [min(label[j] for j in range(62) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(62)]
    got = simhash.groups(frame, "doc_id").select("doc_id", simhash.hexadecimal().alias("f"), "component_id").collect()
    assert sorted(map(tuple, got)) == [(i, f"{prints[i]:016x}", label[i]) for i in range(62)]
    odd = simhash.groups(docs, "doc_id").collect()
    assert len(odd) == 12 and {r[2] for r in odd if r[0] in (1, 2, 3)} == {1} and [r[2] for r in odd if r[0] is None] == [None]
    assert simhash.groups(nothing, "doc_id").isEmpty()


def test_tiles_find_every_pair():
    chosen = np.random.default_rng(3)
    first, second = (chosen.integers(0, 1 << 62, 300, dtype=np.uint64) for _ in range(2))
    second[:50] = first[:50] ^ np.uint64(5)
    pairs = {(a, b) for x, y in simhash.linked(first, second, 2, False) for a, b in zip(x.tolist(), y.tolist())}
    assert pairs == {(a, b) for a in range(300) for b in range(300) if int(first[a] ^ second[b]).bit_count() <= 2}


def test_ids_equal_the_library(spark, docs, nothing):
    tokenizer, vocab = Tokenizer.from_file(PATH), bpe.vocabulary(PATH)
    chosen = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'", "<|endoftext|>", "é", "中", "23", "!", "\r", " the", "\x00", "　", "\x1c", "à", " "]
    for _ in range(3000):
        text = "".join(chosen.choices(parts, k=chosen.randint(0, 14)))
        ids = np.frombuffer(bpe.encode(vocab, text, {}), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert bpe.decode(vocab, np.array(ids, "<u4").tobytes()) == tokenizer.decode(ids, skip_special_tokens=False)
    back = bpe.decoded(bpe.encoded(docs, PATH, "doc_id"), PATH, "doc_id")
    assert sorted(str(r["text"]) for r in back.collect()) == sorted(r["text"] or "" for r in docs.collect())
    found = {r[0]: r[1] for r in bpe.digests(docs, PATH, "doc_id").collect()}
    assert found[1] == found[2] == 0 and found[8] == len(tokenizer.encode(text_of(9000, 8), add_special_tokens=False).ids)
    assert bpe.digests(nothing, PATH, "doc_id").isEmpty()


def test_packing_is_gapless_and_near_the_bound(spark, docs, nothing):
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(3, 4) == [(0, 3)]
    lengths = np.clip(np.random.default_rng(2).lognormal(6.5, 0.9, 2000).astype(int), 1, 2047)
    histogram = np.bincount(lengths, minlength=2049)
    plan = packing.rounded(histogram, packing.solve(histogram))
    assert Counter(x for c, n in plan for x in c for _ in range(n)) == Counter(lengths.tolist())
    assert all(sum(c) <= 2048 for c, _ in plan)
    best = packing.planned(histogram)
    assert Counter(x for c, n in best for x in c for _ in range(n)) == Counter(lengths.tolist())
    assert sum(n for _, n in best) <= sum(n for _, n in plan)
    assert sum(n for _, n in plan) <= 1.01 * max(lengths.sum() / 2048, (lengths > 1024).sum()) + 1
    pieces = packing.packed(docs, PATH, "doc_id").collect()
    at = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 2048
    tokenizer = Tokenizer.from_file(PATH)
    total = sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(r["length"] for r in pieces) == total
    assert packing.packed(nothing, PATH, "doc_id").isEmpty()


BASE = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def by_pattern(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            fine = [
                True, kind == 1 and all(int(x) <= 255 for x in match[0].split(".")),
                12 <= len(digits) <= 19 and personal.luhn(digits), 9 <= len(digits) <= 15,
            ][kind]
            if fine:
                out.append((match.start(), kind, match.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns(spark, docs, nothing):
    chosen = random.Random(3)
    parts = [*"01239 -.+@(ab_%é,", "4111 1111 1111 1111", "1.2.3.4", "x@y.z", "+49 170 1234567", "255.", "account ", "acct: 12345678"]
    for _ in range(20000):
        text = "".join(chosen.choices(parts, k=chosen.randint(0, 18)))
        assert [x for x in personal.spans(text) if x[1] < personal.BASE] == by_pattern(text), repr(text)
    text = "IBAN: DE89 3704 0044 0532 0130 00 and https://me:pw@host.org, account no. 12345678"
    assert [personal.KINDS[k] for _, k, _ in personal.spans(text) if k >= personal.BASE] == ["account", "login", "account"]
    assert personal.redacted("é a@b.cc x", personal.spans("é a@b.cc x")) == "é [EMAIL] x"
    assert personal.found(docs, "doc_id").count() == 12
    assert personal.redact(docs).where("text is null").count() == 1
    assert personal.found(nothing, "doc_id").isEmpty() and personal.redact(nothing).isEmpty()


def test_archives_round_trip(spark):
    long = "<p>" + "x" * 1200 + "</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n"
    rows = [(1, "http://b.org/x", long), (2, "http://a.b.org/?q#f", long), (3, None, None), (4, "", ""), (5, "http://b.org/x", "short\n"), (6, "u v\n", "short\n"), (7, "http://b.org/x", "é" * 600 + "\n"), (None, "http://z.org", long), (2, "http://a.b.org/?q#f", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = warc.write_archives(pages, "page_id", "url", "html", F.timestamp_seconds(F.coalesce("page_id", F.lit(0))))
    found = warc.history(warc.read_archives(spark, folder)).collect()
    got = sorted((r["key"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found)
    n = len(long)
    assert got == [(-1, "revisit", 2, n), (1, "revisit", 2, n), (2, "response", None, n), (2, "response", None, n), (3, "response", None, 0), (4, "response", None, 0), (5, "response", None, 6), (6, "response", None, 6), (7, "response", None, 1201)]
    assert [r["url_key"] for r in found] == sorted(r["url_key"] for r in found)
    empty = warc.write_archives(pages.limit(0), "page_id", "url", "html", F.timestamp_seconds(F.lit(0)))
    assert warc.history(warc.read_archives(spark, empty)).isEmpty()


def test_loser_tree_merges():
    chosen = random.Random(4)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted(chosen.randint(0, 20) for _ in range(chosen.randint(0, 9))) for _ in range(k)]
        merged = list(warc.merged_order(runs))
        assert [(runs[r][i], r, i) for r, i in merged] == sorted((x, r, i) for r, run in enumerate(runs) for i, x in enumerate(run))


@pytest.fixture(scope="module")
def vectors(spark):
    chosen = np.random.default_rng(6)
    base = chosen.normal(size=(150, 24))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(200 + i, (base[i % 5] + 0.03 * chosen.normal(size=24)).tolist(), (i % 5) % 3) for i in range(60)]
    rows += [(300 + i, base[7].tolist(), 1) for i in range(30)]
    rows += [(400, None, 1), (401, [0.0] * 24, 1), (402, [None] + [1.0] * 23, 1), (403, [float("nan")] * 24, 1)]
    rows += [(404, base[7].tolist(), None), (None, base[7].tolist(), 1), (405, base[7].tolist()[:8], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def usable(rows):
    out = {}
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 24:
            out[r["vec_id"]] = (np.array(v) / np.linalg.norm(v), r["label"])
    return out


def test_near_duplicates_equal_brute_force(spark, vectors):
    rows = usable(vectors.collect())
    ids = [i for i in sorted(rows) if rows[i][1] is not None]
    near = {i: [j for j in ids if j != i and rows[i][1] == rows[j][1] and rows[i][0] @ rows[j][0] >= 0.98] for i in ids}
    label = {i: i for i in ids}
    for _ in ids:
        label = {i: min([label[i], *(label[j] for j in near[i])]) for i in ids}
    for block in (1024, 16):
        got = neardup.near_duplicates(vectors, "vec_id", "embedding", "label", settings=neardup.Settings(block=block)).collect()
        assert len(got) == vectors.count()
        found = {r["vec_id"]: r for r in got}
        exact = sum(found[i]["n_links"] for i in ids)
        assert 0.99 * sum(map(len, near.values())) <= exact <= sum(map(len, near.values()))
        assert all(found[i]["component_id"] == label[i] for i in ids)
        assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (400, 401, 402, 403, 404, 405))
        assert found[None]["component_id"] is None and not found[None]["kept"]
    assert neardup.near_duplicates(vectors.limit(0), "vec_id", "embedding", "label").isEmpty()


def test_neighbours_recall_and_ties(spark, vectors):
    rows = usable(vectors.collect())
    small = neighbours.Settings(list_part=32, query_part=4)
    for settings in (neighbours.Settings(), small):
        got = neighbours.search(vectors, "vec_id", "embedding", F.col("vec_id") % 10 == 0, settings=settings).collect()
        found = {}
        for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
            found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        asked = [i for i in rows if i % 10 == 0]
        assert sorted(found) == sorted(asked)
        hits = 0
        for i in asked:
            best = sorted((-round(float(rows[i][0] @ rows[j][0]), 12), j) for j in rows if j != i)[:5]
            hits += len({j for _, j in best} & {j for j, _ in found[i]})
        assert hits >= 0.9 * 5 * len(asked)
        assert [j for j, _ in found[310]] == [7, 300, 301, 302, 303]
    assert neighbours.search(vectors.limit(0), "vec_id", "embedding", F.lit(True)).isEmpty()


def test_neighbours_of_extreme_vectors(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [1.0, 0.0]), (5, [5e-324, 0.0]), (6, [-1e308, 1e308])]
    frame = spark.createDataFrame([(i, v, 9, 9.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = neighbours.search(frame, "vec_id", "embedding", F.col("vec_id") == 1).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [2, 3, 4, 5, 6]
    assert np.allclose([r["score"] for r in got], [1, 1, 0.5**0.5, 0.5**0.5, 0])
    near = neardup.near_duplicates(frame.withColumn("label", F.lit(1)), "vec_id", "embedding", "label").collect()
    assert {r["vec_id"]: r["component_id"] for r in near} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}


def test_scan_keeps_every_nearest_pair_without_abandoning():
    chosen = np.random.default_rng(8)
    rows, asks = (neighbours.unit(chosen.normal(size=(n, 40))) for n in (1500, 30))
    blocks, parts = ([x[:, c : c + 16] for c in range(0, 40, 16)] for x in (rows, asks))
    query, row = neighbours.survivors(blocks, parts, lambda strip: np.ones((len(strip), 30), bool), 5, 1e9)
    for q in range(30):
        best = np.argsort(((rows - asks[q]) ** 2).sum(axis=1))[:5]
        assert set(best.tolist()) <= set(row[query == q].tolist())
    query, row = neighbours.survivors(blocks, parts, lambda strip: np.ones((len(strip), 30), bool), 5, 2.1)
    hits = sum(len(set(np.argsort(((rows - asks[q]) ** 2).sum(axis=1))[:5].tolist()) & set(row[query == q].tolist())) for q in range(30))
    assert hits >= 0.95 * 150


def test_secrets_are_found_where_they_are_assigned():
    def secrets(text):
        return [text[a:b] for a, k, b in personal.spans(text) if personal.KINDS[k] == "secret"]

    value = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"
    for text in (f'token = "{value}" From', f"TOKEN = '{value}'!!", f"api_key: {value}.", f'"client_secret":"{value}"', f"Authorization: Bearer {value}"):
        assert [x.rstrip(".") for x in secrets(text)] == [value], text
    assert secrets('password = "hunter!?" and pwd=a1b2c3d4') == ["hunter!?", "a1b2c3d4"]
    for text in ("the key: take it", "a token of thanks", "monkey = 12345678a", "keyboard", "password", "token =", "secret: something", ""):
        assert secrets(text) == [], text
    assert secrets("token = " * 10**5) == []


def test_language_equals_brute_force(spark, docs):
    """The contract of the method word by word, without the model's arrays."""
    random_ = random.Random(4)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "efgah"}
    texts = [(lang, " ".join("".join(random_.choices(x, k=random_.randint(1, 4))) for _ in range(30))) for lang, x in letters.items() for _ in range(6)]
    rows = [(i, text, lang) for i, (lang, text) in enumerate(texts)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id"))
    words, grams = {x: Counter() for x in letters}, {n: {x: Counter() for x in letters} for n in range(1, 5)}
    for lang, text in texts:
        for word in text.split():
            words[lang][word] += 1
            for n in range(1, 5):
                padded = f"<{word}>" if n > 1 else word
                grams[n][lang].update(padded[i : i + n] for i in range(len(padded) - n + 1))
    words = {lang: Counter({w: n for w, n in found.items() if n > 1}) for lang, found in words.items()}

    def logs(counts, unit):
        size = len(set().union(*counts.values()))
        return np.array([np.log((counts[x][unit] + 0.5) / (counts[x].total() + 0.5 * (size + 1))) for x in sorted(letters)])

    for text in ["abc cde ghgh", "zzz a", "aceg bdfh", "hhhh", "eeee dddd ggag", "q"] + [t for _, t in texts[::4]]:
        total = np.zeros(3)
        for word in text.split():
            if any(found[word] for found in words.values()):
                total += logs(words, word)
                continue
            for n in range(4, 0, -1):
                padded = f"<{word}>" if n > 1 else word
                seen = [padded[i : i + n] for i in range(len(padded) - n + 1)]
                seen = [g for g in seen if any(found[g] for found in grams[n].values())]
                if seen:
                    total += np.mean([logs(grams[n], g) for g in seen], axis=0)
                    break
        lang, score = language.score(model, text, {})
        assert lang == sorted(letters)[int(np.argmax(total))]
        assert np.isclose(score, 1 / np.exp(total - total.max()).sum())


def ascii_lower(text):
    return "".join(x.lower() if x.isascii() else x for x in text)


def tokens_by_hand(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text)), "\n"]


def test_language_model(spark, docs, nothing):
    rows = [(i, text_of(30, i)) for i in range(80)]
    model = perplexity.train(spark.createDataFrame(rows, "doc_id long, text string"), perplexity.Settings(dictionary=100))
    scored = {r["doc_id"]: r for r in perplexity.score(docs, "doc_id", model).collect()}
    counted = Counter(w for _, t in rows for w in [*t.split(), "\n"])
    total, distinct = sum(counted.values()), len(counted)
    found = [*text_of(50, 4).split(), "\n"]
    assert np.isclose(scored[4]["base_score"], sum(np.log10((counted[w] + 1) / (total + distinct + 1)) for w in found))
    assert scored[4]["n_known"] == sum(counted[w] > 0 for w in found) and scored[4]["train_tokens"] == total
    assert scored[1]["n_tokens"] == scored[2]["n_tokens"] == scored[3]["n_tokens"] == 1
    assert all(r["score"] < 0 for r in scored.values())
    assert perplexity.score(docs, "doc_id", model).count() == docs.count()
    empty = perplexity.train(nothing)
    assert perplexity.score(docs, "doc_id", empty).where("base_score <> 0 or score > 0").isEmpty()
    assert perplexity.score(nothing, "doc_id", model).isEmpty()


@pytest.mark.parametrize("dictionary", [0, 60, 10_000])
def test_scores_add_up_word_by_word(spark, docs, dictionary):
    """Every context of the training rows counts; scores are sums of mean predictive probabilities, which sum to one."""
    rows = [(i, text_of(30, i) + " hot red" * 10 + " hot" * (i % 3)) for i in range(60)]
    settings = perplexity.Settings(dictionary=dictionary, least_buckets=3, sweeps=3)
    model = perplexity.train(spark.createDataFrame(rows, "doc_id long, text string"), settings)
    inner = model.shared
    pairs = Counter()
    for _, text in rows:
        found = tokens_by_hand(text)
        pairs.update(zip(["\n", *found], found))
    names = sorted({w for pair in pairs for w in pair})
    code = dict(zip(names, inner.tokens.codes([w.encode() for w in names]).tolist()))
    # n, and tables of each kept sweep, of every pair; no pair lies in two buckets
    stored, seats, homes = {}, {}, Counter()
    for r in model.pairs.collect():
        bucket = perplexity.Bucket(r["data"], inner.cuts)
        ids = list(zip(bucket.pair_context.tolist(), bucket.token.tolist()))
        homes.update(set(bucket.contexts.tolist()))
        assert not stored.keys() & set(ids)
        stored |= dict(zip(ids, bucket.n.tolist()))
        turns = [bucket.seat(r["bucket"], t, inner.sweeps, inner.distinct, inner.discount, settings) for t in (1, 2)]
        seats |= dict(zip(ids, zip(*(t.tolist() for t in turns))))
    assert stored == {(code[v], code[w]): n for (v, w), n in pairs.items()}
    assert len(inner.cuts.hot) and max(homes.values()) > 1  # a hot context is cut
    assert all(1 <= t <= stored[p] for p, both in seats.items() for t in both)
    served = Counter()
    for (_, w), both in seats.items():
        served[w] += both[-1]
    root = {w: 10.0 ** float(inner.root.log10(np.array([served.get(c, 0)]))[0]) for w, c in code.items()}
    unseen = 10.0 ** float(inner.root.log10(np.array([0]))[0])
    assert np.isclose(sum(root.values()) + unseen, 1)
    customers, tables = Counter(), {}
    for (v, _), n in stored.items():
        customers[v] += n
    for (v, _), both in seats.items():
        tables[v] = tuple(map(sum, zip(tables.get(v, (0, 0)), both)))

    def probability(v, w):
        v, d, a, base = code.get(v), inner.discount, settings.strength, root.get(w, unseen)
        if v not in customers:
            return base
        own, both = stored.get((v, code.get(w)), 0), seats.get((v, code.get(w)), (0, 0))
        return np.mean([(own - d * t + (a + d * every) * base) / (customers[v] + a) for t, every in zip(both, tables[v])])

    for v in ["\n", "hot", "the1", names[5], "never"]:
        assert np.isclose(sum(probability(v, w) for w in names) + probability(v, "never seen"), 1)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.where("doc_id IS NOT NULL").collect()}
    texts |= dict(rows[50:])
    asked = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in perplexity.score(asked, "doc_id", model).collect():
        found = tokens_by_hand(texts[r["doc_id"]])
        by_hand = sum(np.log10(probability(v, w)) for v, w in zip(["\n", *found], found))
        assert np.isclose(r["score"], by_hand, rtol=1e-6), r


@pytest.mark.parametrize("bucket", [80, 5000])
def test_positions_beside_their_pairs_score_alike(spark, bucket):
    """One shuffle for learning and scoring, with and without positions that meet a bucket later; a pair is hot."""
    rows = [(i % 70, text_of(20, i) + " hot red" * 40, i % 7 != 2) for i in range(80)] + [(None, None, True), (3, "", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    settings = perplexity.Settings(dictionary=15, bucket=bucket, least_buckets=3, sweeps=2)
    order = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    ranked = lambda df: sorted(map(tuple, df.select(*order).collect()), key=repr)
    every = ranked(perplexity.train_and_score(docs, "doc_id", F.lit(True), settings))
    assert every == ranked(perplexity.score(docs, "doc_id", perplexity.train(docs, settings)))
    both = ranked(perplexity.train_and_score(docs, "doc_id", F.col("learn"), settings))
    apart = ranked(perplexity.score(docs, "doc_id", perplexity.train(docs.where("learn"), settings)))
    assert len(both) == len(rows) and [r[:4] for r in both] == [r[:4] for r in apart]
    assert np.allclose([r[4] for r in both], [r[4] for r in apart], rtol=0.1)
    assert perplexity.train_and_score(docs.limit(0), "doc_id", F.lit(True), settings).isEmpty()


def test_language_model_counts_do_not_depend_on_buckets(spark):
    rows = [(i, text_of(200, i)) for i in range(20)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for buckets, parts in ((1, 1), (64, 7)):
        settings = perplexity.Settings(least_buckets=buckets, rounds=4)
        model = perplexity.train(train.repartition(parts), settings)
        scores = {r["doc_id"]: r["score"] / r["n_tokens"] for r in perplexity.score(train, "doc_id", model).collect()}
        found.append([scores[i] for i, _ in rows])
    # random numbers differ, the probabilities hardly
    assert np.allclose(*found, rtol=0.03)


def test_seatings_follow_the_restaurant():
    """Tables of one dish whose menu probability is one are those of a plain Pitman-Yor restaurant."""
    random_ = np.random.default_rng(0)
    customers, d, a = np.array([60]), 0.5, 1.0
    tables = [perplexity.seated(customers, np.ones(1), d, a, 30, random_)[0] for _ in range(300)]
    expected = 1.0
    for n in range(1, 60):
        expected += (a + d * expected) / (n + a)
    assert abs(np.mean(tables) - expected) < 0.08 * expected
