"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are its own shape and that of the line before and after it;
two transition weights per state tie neighbours together. Training gives each line of a labelled
document that document's label, and maximises the conditional likelihood of the label sequence. The
score of a document is the mean of its lines' forward-backward marginals for good, weighted by line
length.

The model is fitted on the driver on a bounded sample: at most about ``docs`` labelled documents, chosen
by a hash of the key, and no more of these than hold ``lines`` lines; texts are always taken whole.

Null text counts as empty, and an empty text is one empty line, so it gets a score as well. Labels
that are null are not learnt from. With no labelled rows, or rows of one label only, the score is the
share of good rows (0.5 without rows). Rows with equal keys are scored one by one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.llm.common import sampled, schema_with
from respondry.sources.workspace import written

SYMBOLS = "#$%&*|<>{}[]=_~^\\/@+"
DIGITS = "0123456789"
OWN = 17
#: Lines whose features are held at once while scoring.
BLOCK = 20_000


@dataclass(frozen=True)
class Settings:
    docs: int = 4_000
    lines: int = 150_000
    steps: int = 120
    rate: float = 0.1
    penalty: float = 1e-4


@dataclass(frozen=True)
class Model:
    """``weights`` of a line being good (bias last), ``moves`` between states (0 bad, 1 good)."""

    weights: np.ndarray
    moves: np.ndarray


def line_features(line: str, before: str | None, times: int) -> tuple[float, ...]:
    found = line.split()
    if not found:
        return (1.0,) + (0.0,) * (OWN - 1)
    n, size = len(found), len(line)
    lengths = list(map(len, found))
    return (
        0.0,
        min(np.log1p(size) / 8, 1.5),
        sum(map(str.isalpha, found)) / n,
        sum(map(str.isupper, found)) / n,
        sum(map(str.istitle, found)) / n,
        len(set(found)) / n,
        min(sum(lengths) / n / 12, 1.5),
        min(max(lengths) / 40, 2.0),
        sum(length <= 3 for length in lengths) / n,
        min(4 * sum(map(line.count, SYMBOLS)) / size, 2.0),
        min(4 * sum(map(line.count, DIGITS)) / size, 2.0),
        min(line.count("|") / n, 1.0),
        min(line.count("!") / n, 2.0),
        sum(map(eq, found, found[1:])) / n,
        float(times > 1),
        float(line == before),
        float(line.rstrip()[-1] in ".?!:;\"'"),
    )


def document_lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Own features of every line, and line lengths with the line end."""
    lines = (text or "").split("\n")
    times = Counter(lines)
    own = [line_features(x, lines[i - 1] if i else None, times[x]) for i, x in enumerate(lines)]
    return np.array(own, np.float32), np.array([len(x) + 1 for x in lines], float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Features of the line, of the one before, of the one after (zeros where there is none), bias."""
    out = np.zeros((len(own), 3 * OWN + 1), np.float32)
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[:, -1] = 1
    return out


def _columns(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents by falling size, and how many of them have an i-th line."""
    order = np.argsort(-sizes, kind="stable")
    alive = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes.max(initial=0)), "right")
    return order, alive


def marginals(good: np.ndarray, sizes: np.ndarray, moves: np.ndarray):
    """Forward-backward over all documents at once: P(good) per line, pair sums, log partition.

    ``good`` is the log potential of a line being good (bad has 0), documents one after the other.
    """
    order, alive = _columns(sizes)
    starts = (np.cumsum(sizes) - sizes)[order]
    unary = np.stack([np.zeros_like(good), good], axis=1)
    forward, backward = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    for i, n in enumerate(alive):
        at = starts[:n] + i
        forward[at] = unary[at]
        if i:
            last = forward[at - 1]
            forward[at] += np.logaddexp(last[:, :1] + moves[0], last[:, 1:] + moves[1])
    for i in range(len(alive) - 2, -1, -1):
        at = starts[: alive[i + 1]] + i
        after = backward[at + 1] + unary[at + 1]
        backward[at] = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
    ends = starts + sizes[order] - 1
    total = np.logaddexp(forward[ends, 0], forward[ends, 1])
    each = np.empty(len(sizes))
    each[order] = total
    log_z = np.repeat(each, sizes)
    p_good = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - log_z, 0.0))
    second = np.ones(len(good), bool)
    second[np.cumsum(sizes) - sizes] = False
    at = np.flatnonzero(second)
    pairs = np.exp(
        forward[at - 1][:, :, None] + moves + (unary[at] + backward[at])[:, None, :] - log_z[at][:, None, None]
    )
    return p_good, pairs.sum(axis=0), total.sum()


def fit(features: np.ndarray, sizes: np.ndarray, labels: np.ndarray, settings: Settings) -> Model:
    """Full-batch Adam on the penalised conditional likelihood, per line."""
    truth = np.repeat(labels, sizes).astype(float)
    n = len(truth)
    within = np.maximum(sizes - 1, 0)
    seen = np.array([[within[labels == 0].sum(), 0], [0, within[labels == 1].sum()]], float)
    theta = np.zeros(features.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, settings.steps + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        p_good, pairs, _ = marginals(features @ weights, sizes, moves)
        slope = np.concatenate([features.T @ (truth - p_good), (seen - pairs).ravel()]) / n - settings.penalty * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta + settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:-4], theta[-4:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, key: str, label: str, settings: Settings = Settings()) -> Model:
    """A model from the ``text`` of ``docs`` and the 0/1 ``label`` that ``labels`` has for a key.

    A key's labels count as one, the smallest. The sample is drawn from the keys, so only its own texts
    leave the scan; it has about ``docs`` rows, which bounds what is broadcast.
    """
    given = labels.select(F.col(key), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    given = sampled(given.groupBy(key).agg(F.min("label").alias("label")), settings.docs, F.col(key))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(key, text.alias("text")).join(F.broadcast(given), key)
    rows = rows.select(F.col(key).alias("key"), "text", "label", F.regexp_count("text", F.lit("\n")).alias("ends"))
    rows = written(rows, "labelled")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("ends") + 1), F.lit(0))).first()
    wanted = min(count, int(settings.lines * count / max(total, 1)))
    schema = pa.schema([("label", pa.int32()), ("features", pa.binary()), ("lines", pa.int64()), ("key", pa.int64())])

    def run(batches):
        for batch in batches:
            own = [document_lines(text)[0] for text in batch["text"].to_pylist()]
            yield pa.record_batch(
                [batch["label"], [x.tobytes() for x in own], [len(x) for x in own], batch["place"]], schema=schema
            )

    # another hash than that of the sample, which all these rows share
    part = sampled(rows, wanted, F.concat(F.lit("lines"), F.col("key").cast("string")), count)
    part = part.select("text", "label", F.xxhash64("key", "text").alias("place"))
    part = part.mapInArrow(run, "label int, features binary, lines long, key long").toPandas()
    part = part.sort_values(["key", "label", "lines"], kind="stable")
    labels = part["label"].to_numpy(int)
    if len(set(labels)) < 2:
        share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
        weights = np.zeros(3 * OWN + 1)
        weights[-1] = np.log(share / (1 - share))
        return Model(weights, np.zeros((2, 2)))
    own = [np.frombuffer(x, np.float32).reshape(-1, OWN) for x in part["features"]]
    return fit(np.concatenate([with_neighbours(x) for x in own]), part["lines"].to_numpy(int), labels, settings)


def score_texts(model: Model, texts: list[str | None]) -> list[float]:
    """Length-weighted marginals, over blocks of whole documents."""
    scores: list[float] = []
    good, lengths, sizes, held = [], [], [], 0

    def done():
        size = np.array(sizes)
        p_good, _, _ = marginals(np.concatenate(good), size, model.moves)
        weight = np.concatenate(lengths)
        starts = np.cumsum(size) - size
        mean = np.add.reduceat(p_good * weight, starts) / np.add.reduceat(weight, starts)
        scores.extend(np.clip(mean, 0.0, 1.0).tolist())
        for part in (good, lengths, sizes):
            part.clear()

    for text in texts:
        own, length = document_lines(text)
        good.append(with_neighbours(own) @ model.weights)
        lengths.append(length)
        sizes.append(len(own))
        held += len(own)
        if held >= BLOCK:
            done()
            held = 0
    if sizes:
        done()
    return scores


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a ``score`` from 0 to 1, higher for better, of the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*[c for c in docs.columns if c != "score"])

    def run(rows):
        for batch in rows:
            scores = score_texts(shared.value, batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"]
            )

    return docs.mapInArrow(run, schema_with(docs, "score double"))
