"""Language identification: known words first, then shorter and shorter character n-grams.

A word is a run of letters, lower-cased. A word that training has seen often enough scores by its log
frequency in each language. Any other word is padded with its ends and scores by the mean log
frequency of its n-grams of the longest length of which at least one was seen, down to single
characters. The language with the largest sum wins, ties going to the smaller name.

The model is bounded: ``docs`` training documents (chosen by a hash of the key), and per language
the ``words`` commonest words seen at least twice and the ``grams`` commonest n-grams.

Null text and text without a letter is ``und`` with score 0. Without training rows everything is
``und``. A text of letters of which nothing was seen scores alike in all languages. Rows with equal
keys are treated one by one; other columns are passed on or ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respondry.llm.common import sampled, schema_with

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 4
UNKNOWN = "und"
#: Scores kept for words out of the vocabulary, per Python worker.
REMEMBERED = 200_000

COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("unit", pa.string()), ("n", pa.int64())])


@dataclass(frozen=True)
class Settings:
    docs: int = 20_000
    words: int = 30_000
    grams: int = 30_000


@dataclass(frozen=True)
class Model:
    """``words`` and ``grams`` (by length) map a unit to its row of ``logs`` (units x languages).

    ``seen`` has, alike, whether a language was seen to use the unit.
    """

    languages: tuple[str, ...]
    words: dict[str, int]
    grams: tuple[dict[str, int], ...]
    logs: np.ndarray
    seen: np.ndarray


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def has_letter(found: list[str]) -> bool:
    return any(any(map(str.isalpha, word)) for word in found)


def grams_of(word: str, length: int) -> list[str]:
    padded = f"<{word}>" if length > 1 else word
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


def _count_units(rows):
    """Words (kind 0) and n-grams (kind n) with their counts per language, one lot per batch."""
    for batch in rows:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            found.setdefault(lang, Counter()).update(words_of(text))
        for lang, known in found.items():
            units = [known] + [Counter() for _ in range(LONGEST)]
            for word, n in known.items():
                for length in range(1, LONGEST + 1):
                    for gram in grams_of(word, length):
                        units[length][gram] += n
            for kind, counted in enumerate(units):
                yield pa.record_batch(
                    [[lang] * len(counted), [kind] * len(counted), list(counted), list(counted.values())], schema=COUNTS
                )


def train(docs: DataFrame, key: Column, settings: Settings = Settings()) -> Model:
    """A model from rows with ``text`` and ``lang``; rows with a null in either are not used."""
    docs = sampled(docs.select(key.alias("key"), "text", "lang").dropna(subset=["text", "lang"]), settings.docs, F.col("key"))
    units = docs.select("text", "lang").mapInArrow(_count_units, "lang string, kind int, unit string, n long")
    units = units.groupBy("lang", "kind", "unit").agg(F.sum("n").alias("n"))
    units = units.where("kind > 0 or n > 1").withColumn("is_word", F.col("kind") == 0)
    order = Window.partitionBy("lang", "is_word").orderBy(F.desc("n"), "kind", "unit")
    units = units.withColumn("place", F.row_number().over(order))
    units = units.where(F.col("place") <= F.when(F.col("is_word"), settings.words).otherwise(settings.grams))
    counts = units.select("lang", "kind", "unit", "n").toPandas().sort_values(["kind", "unit", "lang"])
    languages = tuple(sorted(counts["lang"].unique()))
    place = {lang: i for i, lang in enumerate(languages)}
    tables, logs, seen = [], [], []
    for kind in range(LONGEST + 1):
        part = counts[counts["kind"] == kind]
        names = {unit: i for i, unit in enumerate(part["unit"].unique())}
        n = np.zeros((len(names), len(languages)))
        n[part["unit"].map(names).to_numpy(int), part["lang"].map(place).to_numpy(int)] = part["n"]
        seen.append(n > 0)
        logs.append(np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * (len(names) + 1))))
        tables.append({unit: i + sum(map(len, tables)) for unit, i in names.items()})
    if not languages:
        return Model((), {}, tuple({} for _ in range(LONGEST)), np.zeros((0, 0)), np.zeros((0, 0), bool))
    return Model(languages, tables[0], tuple(tables[1:]), np.concatenate(logs), np.concatenate(seen))


def unknown_word(model: Model, word: str) -> np.ndarray | None:
    for length in range(LONGEST, 0, -1):
        known = model.grams[length - 1]
        seen = [known[gram] for gram in grams_of(word, length) if gram in known]
        if seen:
            return model.logs[seen].mean(axis=0)
    return None


def score(model: Model, text: str | None, memory: dict) -> tuple[str, float]:
    found = words_of(text)
    if not model.languages or not has_letter(found):
        return UNKNOWN, 0.0
    total, seen = np.zeros(len(model.languages)), []
    for word in found:
        row = model.words.get(word)
        if row is not None:
            seen.append(row)
            continue
        logs = memory.get(word)
        if logs is None:
            logs = unknown_word(model, word)
            logs = np.zeros_like(total) if logs is None else logs
            if len(memory) < REMEMBERED:
                memory[word] = logs
        total = total + logs
    total = total + model.logs[seen].sum(axis=0)
    best = int(np.argmax(total))
    return model.languages[best], float(1 / np.exp(total - total[best]).sum())


def familiarity(model: Model, text: str | None, lang: str, memory: dict) -> float:
    """How much of a text ``lang`` was seen to use: the mean over its words, from 0 to 1.

    A word seen counts 1, any other the share of its longest n-grams that were. Unlike the posterior it
    does not grow more certain with the length of a text in a language that was never learnt.
    """
    found = words_of(text)
    if lang not in model.languages or not found:
        return 0.0
    at, total = model.languages.index(lang), 0.0
    for word in found:
        known = memory.get((word, at))
        if known is None:
            row = model.words.get(word)
            if row is not None and model.seen[row, at]:
                known = 1.0
            else:
                length = min(LONGEST, len(word) + 2)
                rows = [model.grams[length - 1].get(gram) for gram in grams_of(word, length)]
                known = sum(x is not None and bool(model.seen[x, at]) for x in rows) / len(rows)
            if len(memory) < REMEMBERED:
                memory[word, at] = known
        total += known
    return total / len(found)


def predict(docs: DataFrame, model: Model, familiar: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior under equal priors) of the column ``text``.

    With ``familiar`` also that column, see :func:`familiarity`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "familiar")]
    docs = docs.select(*kept)
    schema = schema_with(docs, "lang_pred string, score double" + ", familiar double" * familiar)

    def run(rows):
        memory: dict[str, np.ndarray] = {}
        shares: dict[tuple[str, int], float] = {}
        for batch in rows:
            texts = batch["text"].to_pylist()
            scored = [score(shared.value, text, memory) for text in texts]
            columns = [pa.array([s[0] for s in scored], pa.string()), pa.array([s[1] for s in scored], pa.float64())]
            if familiar:
                found = [familiarity(shared.value, text, s[0], shares) for text, s in zip(texts, scored)]
                columns.append(pa.array(found, pa.float64()))
            names = [*batch.schema.names, "lang_pred", "score", "familiar"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names[: len(batch.schema) + 2 + familiar])

    return docs.mapInArrow(run, schema)
