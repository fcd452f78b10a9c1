"""Log probabilities of texts under a hierarchical Pitman-Yor model.

Tokens are words (white space 20, 09-0D between them, only A-Z lower-cased) and one end, which also
precedes the first. A restaurant belongs to every token that training rows hold as a context; all of them
share the root as their parent, and the root's menu is uniform over the training tokens and one unseen.
Customers sit by the Chinese-restaurant process: a sweep seats them one lot after another and then moves
single customers by Gibbs steps; the tables are the root's customers, and its menu serves the next sweep.
Predictive probabilities are averaged over the sweeps after the first, under the last root.

Every context and every pair of tokens counts. Pairs are cut into buckets by a hash of the context, those of
a context with more than a quarter of a bucket by a hash of both tokens, so no bucket grows with a hot
context; what such a context has seated in all buckets is summed after every sweep. Buckets follow the
number of training tokens; a bucket is a row of a written table and is seated in a task. Positions of all
texts, scored or learnt, meet their bucket by the same hash, and a text's sums come back in blocks of
texts. Where a table is learnt and scored at once, one shuffle brings positions to their bucket, and the pairs are
counted there. Held whole are: the commonest tokens (all of one count or none, at most ``dictionary``) with the
root's customers of each, a short number for a common word and a place to look it up; hot contexts, at most four a bucket.
Tokens outside the dictionary are known by 62 bits of a hash; positions that hold them meet their counts by
that number afterwards. While seating, such a token's root count is that of its bucket, and how many of
them have each root count is taken in the first and the last sweep.

Null text is empty and consists of the end alone. With no training rows every probability comes from
empty restaurants. Rows that repeat a key are scored one by one; a null key is kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respondry.llm.common import batches, schema_with, task_numbers, text_bytes
from respondry.sources.workspace import written

#: The end of a text as a token; no word holds a line feed.
END = b"\n"
#: Bytes of texts that a task splits into words at once.
SLICE = 3 << 20
#: Longer tokens are never part of the dictionary.
LONGEST = 64
#: Positions that a task holds before it hands them on.
LOT = 500_000
#: Texts of a block; sums of logs travel as whole numbers of this unit, so their order does not matter.
BLOCK_BITS, UNIT = 12, 1e-9


@dataclass(frozen=True)
class Settings:
    dictionary: int = 200_000
    bucket: int = 600_000
    least_buckets: int = 32
    sweeps: int = 4
    rounds: int = 12
    strength: float = 1.0
    seed: int = 17


@dataclass(frozen=True)
class Tokens:
    """Numbers of tokens: the place in the dictionary, ``known`` (binary), beyond it a hash."""

    known: pa.Array

    def codes(self, tokens: pa.Array | list[bytes]) -> np.ndarray:
        found = pa.array(tokens, pa.binary()).dictionary_encode()
        codes = pc.fill_null(pc.index_in(found.dictionary, self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        others = found.dictionary.filter(pa.array(codes < 0)).to_pylist()
        codes[codes < 0] = np.array([xxhash.xxh64_intdigest(x) >> 2 for x in others], np.int64) + len(self.known)
        return codes[found.indices.to_numpy(zero_copy_only=False)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Cuts:
    """The bucket of a pair; ``hot`` contexts, in order and with their customers, are cut by both tokens."""

    buckets: int
    hot: np.ndarray
    customers: np.ndarray

    def place(self, contexts: np.ndarray) -> np.ndarray:
        """The place among the hot contexts, -1 for others."""
        if not len(self.hot):
            return np.full(len(contexts), -1)
        at = np.minimum(np.searchsorted(self.hot, contexts), len(self.hot) - 1)
        return np.where(self.hot[at] == contexts, at, -1)

    def of(self, contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        both = np.where(self.place(contexts) >= 0, _mixed(tokens), np.uint64(0))
        return (_mixed(contexts.astype(np.uint64) ^ both) % np.uint64(self.buckets)).astype(np.int64)


@dataclass(frozen=True)
class Root:
    """The root: ``seats[c]`` is the mean number of tables of a word with c customers."""

    seats: np.ndarray
    discount: float
    strength: float
    customers: int
    tables: float
    words: int

    def tables_of(self, count: np.ndarray) -> np.ndarray:
        """Beyond the simulated counts the tables grow with the logarithm of the count."""
        most = len(self.seats) - 1
        rate = (self.seats[most] - self.seats[most // 2]) / np.log(2) if most > 1 else 0.0
        inside = self.seats[np.minimum(count, most)]
        return inside + rate * np.log(np.maximum(count, most) / max(most, 1)) * (count > most)

    def log10(self, count: np.ndarray) -> np.ndarray:
        menu = (self.strength + self.discount * self.tables) / (self.words + 1)
        served = np.where(count > 0, count - self.discount * self.tables_of(count), 0.0)
        return np.log10((served + menu) / (self.customers + self.strength))


def _written(df: DataFrame, name: str) -> DataFrame:
    """A written table; its shuffles are removed as soon as it is written, not when the driver collects garbage."""
    conf, setting = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(setting, "false")
    conf.set(setting, "true")
    try:
        return written(df, name)
    finally:
        conf.set(setting, before)


def sliced(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with texts of about ``size`` bytes; a longer text is alone."""
    ends, start = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)), 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right"))
        yield batch.slice(start, max(stop - start, 1))
        start = max(stop, start + 1)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (binary), and how many each has."""
    # as strings, whose bytes are not looked at further: both functions are about ASCII alone
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    found = lists.flatten()
    full = pc.binary_length(found).to_numpy(zero_copy_only=False) > 0  # white space at an edge gives an empty word
    ahead = np.concatenate([[0], np.cumsum(full)])
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    return found.filter(pa.array(full)).view(pa.binary()), np.diff(ahead[ends])


def counted(docs: DataFrame) -> DataFrame:
    """``token`` (binary), how often rows to ``learn`` hold it, ``n``, and how often all do, ``every``."""
    schema = pa.schema([("token", pa.binary()), ("n", pa.int64()), ("every", pa.int64())])

    def run(rows):
        for batch in rows:
            for part in sliced(batch, 2 * SLICE):
                for factor, some in ((1, part.filter(part["learn"])), (0, part.filter(pc.invert(part["learn"])))):
                    if some.num_rows:
                        found = split(some["text"])[0].value_counts()
                        n = np.append(found.field("counts").to_numpy(), some.num_rows)
                        tokens = pa.concat_arrays([found.field("values"), pa.array([END], pa.binary())])
                        arrays = [tokens, pa.array(n * factor, pa.int64()), pa.array(n, pa.int64())]
                        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    parts = docs.select("text", "learn").mapInArrow(run, "token binary, n long, every long")
    return parts.groupBy("token").agg(F.sum("n").alias("n"), F.sum("every").alias("every"))


def packed(*columns: np.ndarray) -> bytes:
    """Whole numbers of equal count, byte by byte; a column has as many bytes as its largest number needs."""
    widths, planes = [], []
    for column in columns:
        column = np.ascontiguousarray(column, np.int64)
        low, high = (int(column.min()), int(column.max())) if len(column) else (0, 0)
        widths.append(8 if low < 0 else max(1, (high.bit_length() + 7) // 8))
        planes.append(column.view(np.uint8).reshape(-1, 8)[:, : widths[-1]].T.tobytes())
    return bytes(widths) + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    widths, out, at = list(data[:columns]), [], 0
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[columns:]), np.uint8)
    n = len(planes) // sum(widths)
    for width in widths:
        column = np.zeros((n, 8), np.uint8)
        column[:, :width] = planes[at : at + n * width].reshape(width, n).T
        out.append(column.view(np.int64).ravel())
        at += n * width
    return out


def _runs(sorted_: np.ndarray) -> Iterator[tuple[int, int]]:
    """Beginnings and ends of equal values."""
    edges = np.flatnonzero(np.diff(sorted_)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(sorted_)]) if len(sorted_) else iter(())


def _ranked(codes: np.ndarray) -> np.ndarray:
    """Numbers below 2 ** 31 in the same order, equal for equal codes."""
    beyond = codes >= 1 << 30
    ranks = codes.copy()
    ranks[beyond] = (1 << 30) + np.unique(codes[beyond], return_inverse=True)[1]
    return ranks


def _pair_order(contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return np.argsort((_ranked(contexts) << 32) | _ranked(tokens))


def _summed(contexts: np.ndarray, tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in order, each once, with their sums."""
    order = _pair_order(contexts, tokens)
    contexts, tokens, n = contexts[order], tokens[order], n[order]
    first = np.flatnonzero(_changes(contexts, tokens))
    return contexts[first], tokens[first], np.add.reduceat(n, first) if len(first) else n


def _changes(contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """True where a position holds another pair than the one before."""
    new = np.ones(len(contexts), bool)
    new[1:] = (np.diff(contexts) != 0) | (np.diff(tokens) != 0)
    return new


#: What a row of a text and a row of positions have besides the text's key.
LINE = pa.schema(
    [("number", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.int64()), ("bucket", pa.int64()), ("at", pa.binary())]
)
LINE_DDL = "number long, n_tokens long, n_known long, base long, bucket long, at binary"


def _row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


def _lines(docs: DataFrame, tokens: Tokens, counts: np.ndarray, cuts: Cuts) -> DataFrame:
    """From ``key``, ``text`` and ``learn``: a row per text, ``base`` and ``n_known`` of its dictionary tokens, and
    rows of positions, ``at`` (context, token, twice the text's number from ``number`` on and one more if learnt)."""
    shared = docs.sparkSession.sparkContext.broadcast((tokens, counts, cuts))

    def handed(contexts: np.ndarray, found: np.ndarray, numbers: np.ndarray, cuts: Cuts, schema: pa.Schema):
        bucket = cuts.of(contexts, found)
        order = np.argsort((bucket << 32) | np.minimum(contexts, 1 << 30))
        contexts, found, numbers, bucket = contexts[order], found[order], numbers[order], bucket[order]
        for a, b in _runs(bucket):
            least = int(numbers[a:b].min()) >> 1
            at = packed(contexts[a:b], found[a:b], numbers[a:b] - 2 * least)
            yield _row(schema, number=least, bucket=int(bucket[a]), at=at)

    def run(rows):
        (tokens, counts, cuts), numbers = shared.value, task_numbers()
        end, seen = tokens.codes([END])[0], np.append(_units(counts + 1.0), 0)
        for batch in rows:
            schema = pa.schema([pa.field("key", batch["key"].type), *LINE])
            for part in sliced(batch, SLICE):
                found, sizes = split(part["text"])
                sizes = sizes + 1
                last = np.cumsum(sizes) - 1
                codes, word = np.full(sizes.sum(), end, np.int64), np.ones(sizes.sum(), bool)
                word[last] = False
                codes[word] = tokens.codes(found)
                first, inside = last + 1 - sizes, np.minimum(codes, len(counts))
                known, base = np.add.reduceat((inside < len(counts)).astype(np.int64), first), np.add.reduceat(seen[inside], first)
                number = np.fromiter(numbers, np.int64, part.num_rows)
                arrays = [part["key"], *(pa.array(x, pa.int64()) for x in (number, sizes, known, base))]
                nothing = [pa.nulls(part.num_rows, f.type) for f in list(LINE)[4:]]
                yield pa.RecordBatch.from_arrays([*arrays, *nothing], schema=schema)
                # before a text's first word stands the end of the text before
                learn = part["learn"].to_numpy(zero_copy_only=False).astype(np.int64)
                yield from handed(np.append(end, codes[:-1]), codes, np.repeat(2 * number + learn, sizes), cuts, schema)

    return docs.select("key", "text", "learn").mapInArrow(run, schema_with(docs.select("key"), LINE_DDL))


def _placed(lines: DataFrame, buckets: int, hold: int) -> DataFrame:
    """Written: the texts' rows as they are, and a row per bucket: ``data`` are the learnt pairs and their counts,
    with how many pairs occur ``once`` and ``twice``, and ``at`` its positions in order of pairs. Positions beyond
    ``hold`` (many texts share a pair) follow in rows of their own, without ``data``."""

    def merged(bucket: int, held: list[tuple[np.ndarray, ...]], beyond: list[tuple[np.ndarray, ...]], schema: pa.Schema):
        contexts, tokens, numbers = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = _pair_order(contexts, tokens)
        contexts, tokens, numbers = contexts[order], tokens[order], numbers[order]
        first = np.flatnonzero(_changes(contexts, tokens))
        n = np.add.reduceat(numbers & 1, first) if len(first) else numbers
        found, counts = (contexts[first], tokens[first]), n
        if beyond:
            *found, counts = _summed(*(np.concatenate(x) for x in zip((*found, n), *beyond)))
        learnt = counts > 0
        counts = counts[learnt]
        least = int(numbers.min(initial=1 << 62)) >> 1
        at = packed(contexts, tokens, numbers - 2 * least) if hold else None
        data = packed(*(x[learnt] for x in found), counts)
        return _row(schema, bucket=bucket, number=least, at=at, data=data, once=int((counts == 1).sum()), twice=int((counts == 2).sum()))

    def merge(rows):
        nothing = (np.zeros(0, np.int64),) * 3
        now, held, size, beyond, schema = None, [nothing], 0, [], None
        for batch in rows:
            schema = pa.schema([*batch.schema, ("data", pa.binary()), ("once", pa.int64()), ("twice", pa.int64())])
            texts = batch.filter(pc.is_null(batch["at"]))
            if texts.num_rows:
                added = [pa.nulls(texts.num_rows, f.type) for f in list(schema)[-3:]]
                yield pa.RecordBatch.from_arrays([*texts.columns, *added], schema=schema)
            rest = batch.filter(pc.is_valid(batch["at"]))
            for bucket, least, at in zip(rest["bucket"].to_pylist(), rest["number"].to_pylist(), rest["at"]):
                if bucket != now and now is not None:
                    yield merged(now, held, beyond, schema)
                    held, size, beyond = [nothing], 0, []
                now = bucket
                contexts, tokens, numbers = unpacked(at.as_py(), 3)
                if size + len(contexts) <= (hold or LOT):
                    held.append((contexts, tokens, numbers + 2 * least))
                    size += len(contexts)
                    continue
                learnt = (numbers & 1).astype(bool)
                beyond.append(_summed(contexts[learnt], tokens[learnt], np.ones(int(learnt.sum()), np.int64)))
                if sum(len(x[0]) for x in beyond) > LOT:
                    beyond = [_summed(*(np.concatenate(x) for x in zip(*beyond)))]
                if hold:
                    yield _row(schema, bucket=bucket, number=least, at=at.as_py())
        if now is not None:
            yield merged(now, held, beyond, schema)

    # a text's row may go to any task
    task = F.coalesce("bucket", F.pmod(F.hash("number"), F.lit(buckets)).cast("long"))
    parts = lines.withColumn("task", task).repartition(buckets, "task").sortWithinPartitions("bucket").drop("task")
    return _written(parts.mapInArrow(merge, schema_with(lines, "data binary, once long, twice long")), "buckets")


def discount_of(once: int, twice: int) -> float:
    """From the numbers of dishes eaten once and twice, as in Kneser-Ney smoothing."""
    return float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95))


def seated(
    customers: np.ndarray, menu: np.ndarray, discount: float, strength: float, rounds: int, random,
    place: np.ndarray | None = None, elsewhere: np.ndarray | None = None,
) -> np.ndarray:
    """Tables of each dish; ``place`` is the dish's restaurant (one by default), ``menu`` the parent's
    probability of the dish, ``elsewhere`` the tables a restaurant has in other buckets.

    Customers first sit in growing lots, the chance of a new table held during a lot. Then, in each round,
    one customer of every dish leaves and sits again: at a table by its size less the discount, or at a new one.
    """
    place = np.zeros(len(customers), np.int64) if place is None else place
    total = np.zeros(place.max(initial=0) + 1) if elsewhere is None else elsewhere.astype(float)
    total += np.bincount(place, minlength=len(total))
    tables = np.ones(len(customers), np.int64)
    movers = np.flatnonzero(customers > 1)
    if not movers.size:
        return tables
    # dishes of one customer keep their table; only the others are worked on
    n, customers, menu, place = len(movers), customers[movers], menu[movers], place[movers]
    now, sitting = np.ones(n, np.int64), np.ones(n, np.int64)
    waiting = np.arange(n)
    while waiting.size:
        lot = np.minimum(customers[waiting] - sitting[waiting], np.maximum(sitting[waiting] // 10, 1))
        new = (strength + discount * total[place[waiting]]) * menu[waiting]
        chance = new / (new + sitting[waiting] - discount * now[waiting])
        # a lot of one is a single throw
        opened = random.random(len(lot)) < chance if lot.max() == 1 else random.binomial(lot, chance)
        now[waiting] += opened
        np.add.at(total, place[waiting], opened)
        sitting[waiting] += lot
        waiting = waiting[sitting[waiting] < customers[waiting]]
    if rounds:
        now = _moved(customers, now, menu, discount, strength, rounds, random, place, total)
    tables[movers] = now
    return tables


def _moved(customers, tables, menu, discount, strength, rounds, random, place, total) -> np.ndarray:
    """Tables after the Gibbs rounds; dishes here have at least two customers.

    A dish of two has one customer left whoever leaves. Of the others every table's size is kept, dish by dish.
    """
    n = len(customers)
    total = total - np.bincount(place, tables, len(total))  # without these dishes
    big = np.flatnonzero(customers > 2)
    many, count = customers[big], tables[big]
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    dish = np.repeat(np.arange(len(big)), count)
    weight = (number + 1.0) ** (-1 / discount)
    weight /= np.bincount(dish, weight, len(big))[dish]
    size = 1 + np.floor((many - count)[dish] * weight).astype(np.int64)
    size[number == 0] += many - np.bincount(dish, size, len(big)).astype(np.int64)
    for _ in range(rounds):
        now = np.ones(n, np.int64)
        last = np.cumsum(count) - 1
        first = last + 1 - count
        several = np.flatnonzero(count > 1)  # only these have a choice
        leave, join, at = first.copy(), first.copy(), first[several]
        ends = np.cumsum(size)
        leave[several] = np.searchsorted(ends, ends[at] - size[at] + np.floor(random.random(len(at)) * many[several]), "right")
        size[leave] -= 1
        empty = size[leave] == 0
        now[big] = count - empty
        new = (strength + discount * (total + np.bincount(place, now, len(total)))[place]) * menu
        others = customers - 1 - discount * now
        opens = random.random(n) * (new + others) < new
        tables = now + opens
        room = np.where(size > 0, size - discount, 0.0)
        ends = np.cumsum(room)
        join[several] = np.searchsorted(ends, ends[at] - room[at] + random.random(len(at)) * others[big[several]], "right")
        join = np.clip(join, first, last)
        # rounding may point at a table just left empty; its last customer then stays
        join = np.where(size[join] > 0, join, leave)
        opened = opens[big]
        size[join[~opened]] += 1
        size[leave[opened & empty]] = 1  # the table left empty is the new one
        more, gone = opened & ~empty, size[leave] == 0
        if more.any() or gone.any():
            full = np.flatnonzero(size > 0)
            size = np.insert(size[full], np.searchsorted(full, last[more] + 1), 1)
            count = count + more - gone
        tables[big] = count
    return tables


@dataclass(frozen=True)
class Sweep:
    """The root after a sweep, its customers of each dictionary token, and the tables of hot contexts."""

    root: Root
    served: np.ndarray
    hot: np.ndarray

    def menu(self, tokens: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The root's probabilities; tokens outside the dictionary have ``others`` customers."""
        inside = tokens < len(self.served)
        out = np.empty(len(tokens))
        out[inside] = self.known[tokens[inside]]
        out[~inside] = 10.0 ** self.root.log10(others[~inside])
        return out

    @cached_property
    def known(self) -> np.ndarray:
        """The root's probabilities of the dictionary's tokens."""
        return 10.0 ** self.root.log10(self.served)


class Bucket:
    """The restaurants of a bucket: pairs in order, the restaurant of each."""

    def __init__(self, data: bytes | None, cuts: Cuts):
        empty = [np.zeros(0, np.int64)] * 3
        self.pair_context, self.token, self.n = empty if data is None else unpacked(data, 3)
        new = np.diff(self.pair_context, prepend=-1) != 0  # in order
        self.contexts, self.place = self.pair_context[new], np.cumsum(new) - 1
        self.hot = cuts.place(self.contexts)
        self.customers = np.bincount(self.place, self.n, len(self.contexts))
        self.whole = np.where(self.hot >= 0, np.append(cuts.customers, 0)[self.hot], self.customers)
        order = np.sort((_ranked(self.token) << 32) | np.arange(len(self.token)))
        order, first = order & 0xFFFFFFFF, np.diff(order >> 32, prepend=-1) != 0
        self.words, self.word = self.token[order[first]], np.empty(len(order), np.int64)
        self.word[order] = np.cumsum(first) - 1
        self.seen = np.bincount(self.word, minlength=len(self.words))[self.word]

    def seat(self, number: int, turn: int, before: list[Sweep], distinct: int, discount: float, settings: Settings) -> np.ndarray:
        """Tables of every pair in sweep ``turn``, the same whenever it is asked for."""
        rest = 1 - self.customers / np.maximum(self.whole, 1)
        menu, asked = np.full(len(self.token), 1 / (distinct + 1)), self.n > 1  # one customer has one table
        if turn:
            menu[asked] = before[turn - 1].menu(self.token[asked], self.seen[asked])
            tables = np.append(before[turn - 1].hot, 0)[self.hot]
        else:
            tables = np.bincount(self.place, minlength=len(self.contexts)) / np.maximum(1 - rest, 1e-12)
        elsewhere = np.where(self.hot >= 0, tables * rest, 0.0)
        random = np.random.default_rng([settings.seed, turn, number])
        return seated(self.n, menu, discount, settings.strength, settings.rounds, random, self.place, elsewhere)

    def keep(self, number: int, sweeps: list[Sweep], distinct: int, discount: float, settings: Settings) -> None:
        """Means over the sweeps after the first: each pair's own share, each context's share of the menu."""
        turns = range(min(1, len(sweeps) - 1), len(sweeps))
        self.own, self.menu = np.zeros(len(self.token)), np.zeros(len(self.contexts))
        for turn in turns:
            tables = self.seat(number, turn, sweeps, distinct, discount, settings)
            total = np.bincount(self.place, tables, len(self.contexts))
            total = np.where(self.hot >= 0, np.append(sweeps[turn].hot, 0)[self.hot], total)
            self.own += (self.n - discount * tables) / (self.whole + settings.strength)[self.place] / len(turns)
            self.menu += (settings.strength + discount * total) / (self.whole + settings.strength) / len(turns)
        self.key = self.place * max(len(self.words), 1) + self.word

    def look(self, contexts: np.ndarray, tokens: np.ndarray, learnt: np.ndarray, model: Shared) -> tuple[np.ndarray, np.ndarray]:
        """Own share and share of the menu of every pair; a context never learnt takes its menu. Pairs in order
        that are known to be ``learnt`` are not searched for where they are all that the bucket has."""
        own, menu = np.zeros(len(contexts)), np.ones(len(contexts))
        hot = model.cuts.place(contexts)
        menu[hot >= 0] = model.hot_menu[hot[hot >= 0]]
        if len(self.key):
            row = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
            found = self.contexts[row] == contexts
            menu[found] = self.menu[row[found]]
            if learnt.sum() == len(self.own):
                own[learnt] = self.own
                return own, menu
            word = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
            key = row * len(self.words) + word
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            found &= (self.words[word] == tokens) & (self.key[at] == key)
            own[found] = self.own[at[found]]
        return own, menu


@dataclass(frozen=True)
class Shared:
    """What every task of the scoring needs."""

    tokens: Tokens
    counts: np.ndarray
    total: int
    distinct: int
    cuts: Cuts
    discount: float
    sweeps: list[Sweep]
    settings: Settings

    @property
    def hot_menu(self) -> np.ndarray:
        kept = self.sweeps[min(1, len(self.sweeps) - 1) :]
        tables = np.mean([s.hot for s in kept], axis=0)
        return (self.settings.strength + self.discount * tables) / (self.cuts.customers + self.settings.strength)

    @property
    def root(self) -> Root:
        return self.sweeps[-1].root

    @property
    def root_menu(self) -> np.ndarray:
        return self.sweeps[-1].known

    @property
    def parts(self) -> int:
        """Parts of the tokens outside the dictionary, of about as many tokens as a bucket has pairs."""
        return max(self.settings.least_buckets, self.distinct // self.settings.bucket)

    def bucket(self, number: int, data: bytes | None) -> Bucket:
        found = Bucket(data, self.cuts)
        found.keep(number, self.sweeps, self.distinct, self.discount, self.settings)
        return found


@dataclass(frozen=True)
class Model:
    """``pairs``: the learnt pairs by bucket; ``others``: tokens outside the dictionary, their ``code``, the root's
    customers ``n`` and how often they occur, ``times``."""

    shared: Shared
    pairs: DataFrame
    others: DataFrame


def root_of(histogram: dict[int, int], settings: Settings, most: int = 5_000, copies: int = 32) -> Root:
    """The root from how many of its words have each count; seatings of a count are averaged."""
    counts = np.array(sorted(histogram), np.int64)
    words_with = np.array([histogram[c] for c in counts.tolist()], np.int64)
    customers, number = int((counts * words_with).sum()), int(words_with.sum())
    once, twice = histogram.get(1, 0), histogram.get(2, 0)
    discount = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95))
    size = int(min(counts.max(initial=1), most))
    tail = Root(np.minimum(np.arange(size + 1), 1.0), discount, settings.strength, customers, float(number), number)
    for turn in range(3):
        random = np.random.default_rng([settings.seed, 1000 + turn])
        new = (settings.strength + discount * tail.tables) / (number + 1)
        tables, seats = np.ones(copies), [0.0, 1.0]
        for c in range(1, size):
            tables += random.random(copies) * (new + c - discount * tables) < new
            seats.append(float(tables.mean()))
        tail = Root(np.array(seats[: size + 1]), discount, settings.strength, customers, tail.tables, number)
        total = float((tail.tables_of(counts) * words_with).sum()) if number else 0.0
        tail = Root(tail.seats, discount, settings.strength, customers, total, number)
    return tail


def _swept(
    rows: DataFrame, distinct: int, cuts: Cuts, discount: float, size: int, before: list[Sweep], settings: Settings, spread: dict[int, int] | None
) -> tuple[Sweep, DataFrame, dict[int, int]]:
    """The next sweep over all buckets; the root's customers by number of token with the token's count (hot
    contexts: -1, -2, ...); and how many tokens outside the dictionary have each number of root customers,
    which are not counted where ``spread``, that of an earlier sweep, is given."""
    shared = rows.sparkSession.sparkContext.broadcast((cuts, before))
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64()), ("times", pa.int64())])
    turn, every = len(before), spread is None

    def run(rows):
        cuts, before = shared.value
        known, hot = np.zeros(size, np.int64), np.zeros(len(cuts.hot), np.int64)
        for batch in rows:
            for number, data in zip(batch["bucket"].to_pylist(), batch["data"]):
                bucket = Bucket(data.as_py(), cuts)
                tables = bucket.seat(number, turn, before, distinct, discount, settings)
                by_word, times = (np.bincount(bucket.word, x, len(bucket.words)).astype(np.int64) for x in (tables, bucket.n))
                by_context = np.bincount(bucket.place, tables, len(bucket.contexts)).astype(np.int64)
                inside = int(np.searchsorted(bucket.words, size))
                known[bucket.words[:inside]] += by_word[:inside]
                hot[bucket.hot[bucket.hot >= 0]] += by_context[bucket.hot >= 0]
                if every:
                    yield from batches({"code": bucket.words[inside:], "n": by_word[inside:], "times": times[inside:]}, schema)
        codes, n = np.concatenate([np.arange(size), -1 - np.arange(len(hot))]), np.concatenate([known, hot])
        yield from batches({"code": codes[n > 0], "n": n[n > 0], "times": np.zeros((n > 0).sum(), np.int64)}, schema)

    tables = rows.select("bucket", "data").mapInArrow(run, "code long, n long, times long")
    served = tables.groupBy("code").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))
    if every:
        served = _written(served, "served")
    inside = served.where(F.col("code") < size).select("code", "n").toPandas()  # the dictionary and hot contexts
    code, n = inside["code"].to_numpy(np.int64), inside["n"].to_numpy(np.int64)
    known, hot = np.zeros(size, np.int64), np.zeros(len(cuts.hot), np.int64)
    known[code[code >= 0]] = n[code >= 0]
    hot[-1 - code[code < 0]] = n[code < 0]
    others = served.where(F.col("code") >= size)
    if every:  # at most as many counts as fit into the corpus
        spread = {r["n"]: r["count"] for r in others.groupBy("n").count().collect()}
    whole = Counter(known[known > 0].tolist())
    whole.update(spread)
    return Sweep(root_of(whole, settings), known, hot), others, spread


def _learnt(docs: DataFrame, settings: Settings, hold: int) -> tuple[Model, DataFrame]:
    """The model of the rows of ``key``, ``text`` and ``learn`` that are to be learnt, and all rows as placed."""
    counts = _written(counted(docs), "tokens")
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "every")]
    total, every, distinct = counts.agg(*sums, F.count_if(F.col("n") > 0)).first()
    short = (F.octet_length("token") <= LONGEST) & (F.col("n") > 0)
    spread = counts.groupBy("n").agg(F.count_if(short).alias("short"))
    spread = spread.orderBy(F.desc("n")).toPandas()  # at most as many counts as fit into the corpus, about a root of it
    least = spread["n"][spread["short"].cumsum() <= settings.dictionary].min()
    # where not even the commonest count fits, the dictionary is empty
    least_count = (1 << 62) if least != least else int(least)
    commonest = counts.where(short & (F.col("n") >= least_count)).select("token", "n").toPandas()
    commonest["token"] = commonest["token"].map(bytes)
    commonest = commonest.sort_values(["n", "token"], ascending=[False, True])
    tokens = Tokens(pa.array(list(commonest["token"]), pa.binary()))
    numbers = commonest["n"].to_numpy(np.int64)
    del commonest
    buckets = max(settings.least_buckets, every // settings.bucket)
    hot = counts.where(F.col("every") * 4 * buckets > every).collect()  # fewer than four a bucket
    codes = tokens.codes([bytes(r["token"]) for r in hot])
    order = np.argsort(codes)
    cuts = Cuts(int(buckets), codes[order], np.array([r["n"] for r in hot], np.int64)[order])
    placed = _placed(_lines(docs, tokens, numbers, cuts), cuts.buckets, hold)
    rows = placed.where("once IS NOT NULL").select("bucket", "data", "once", "twice")
    discount = discount_of(*rows.agg(F.coalesce(F.sum("once"), F.lit(0)), F.coalesce(F.sum("twice"), F.lit(0))).first())
    sweeps: list[Sweep] = []
    spread = None
    for turn in range(settings.sweeps):
        spread = None if turn + 1 == settings.sweeps else spread
        sweep, others, spread = _swept(rows, int(distinct), cuts, discount, len(numbers), sweeps, settings, spread)
        sweeps.append(sweep)
    shared = Shared(tokens, numbers, int(total), int(distinct), cuts, discount, sweeps, settings)
    return Model(shared, rows.select("bucket", "data"), others), placed


def _keyed(docs: DataFrame, key: Column, learn: Column) -> DataFrame:
    return docs.select(key.alias("key"), text_bytes("text"), learn.alias("learn"))


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """The model of all rows."""
    return _learnt(_keyed(docs, F.lit(None).cast("long"), F.lit(True)), settings, 0)[0]


def _blocks(texts: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Sums per text, packed by blocks of texts."""
    order = np.argsort(texts, kind="stable")
    texts = texts[order]
    first = np.flatnonzero(np.diff(texts, prepend=-1))
    text, sums = texts[first], [np.add.reduceat(x[order], first) for x in values]
    block = text >> BLOCK_BITS
    for a, b in _runs(block):
        yield int(block[a]), packed(text[a:b] - (block[a] << BLOCK_BITS), *(x[a:b] for x in sums))


def _units(p: np.ndarray) -> np.ndarray:
    return np.rint(np.log10(p) / UNIT).astype(np.int64)


def _met(rows: DataFrame, model: Model, shared) -> DataFrame:
    """Written: sums of dictionary tokens by ``block``, and by ``part`` the positions of the others with their
    context's shares (``data``, both). A bucket's pairs come with its positions or before them."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("least", pa.int64()), ("data", pa.binary())])

    def others(held: list[tuple[np.ndarray, ...]], parts: int):
        texts, tokens, own, menu = (np.concatenate(x) for x in zip(*held))
        part = tokens % parts
        order = np.lexsort((tokens, part))
        part, least = part[order], int(texts.min())
        # shares as single precision: bits as whole numbers
        bits = [np.ascontiguousarray(x[order], np.float32).view(np.int32).astype(np.int64) for x in (own, menu)]
        for a, b in _runs(part):
            at = order[a:b]
            data = packed(texts[at] - least, tokens[at], bits[0][a:b], bits[1][a:b])
            yield _row(schema, part=int(part[a]), least=least, data=data)

    def summed(held: list[tuple[np.ndarray, ...]]):
        texts, units = (np.concatenate(x) for x in zip(*held))
        nothing = np.zeros(len(texts), np.int64)
        for block, data in _blocks(texts, units, nothing, nothing):
            yield _row(schema, block=block, data=data)

    def run(rows):
        model = shared.value
        size, bucket, now = len(model.counts), None, None
        sums, waiting = [], []
        for batch in rows:
            for number, data, least, at in zip(batch["bucket"].to_pylist(), batch["data"], batch["number"].to_pylist(), batch["at"]):
                if data.is_valid or number != now:
                    bucket, now = model.bucket(number, data.as_py()), number
                if not at.is_valid:
                    continue
                contexts, tokens, texts = unpacked(at.as_py(), 3)
                new = _changes(contexts, tokens)
                learnt = np.maximum.reduceat(texts & 1, np.flatnonzero(new)) > 0
                of, contexts, tokens, texts = np.cumsum(new) - 1, contexts[new], tokens[new], (texts >> 1) + least
                own, menu = bucket.look(contexts, tokens, learnt, model)
                known = tokens < size
                units = np.zeros(len(tokens), np.int64)
                units[known] = _units(own[known] + menu[known] * model.root_menu[tokens[known]])
                inside = known[of]
                sums.append((texts[inside], units[of[inside]]))
                if not known.all():
                    other = of[~inside]
                    waiting.append((texts[~inside], tokens[other], own[other], menu[other]))
                if sum(len(x[0]) for x in sums) >= LOT:
                    yield from summed(sums)
                    sums = []
                if sum(len(x[0]) for x in waiting) >= LOT:
                    yield from others(waiting, model.parts)
                    waiting = []
        if sums:
            yield from summed(sums)
        if waiting:
            yield from others(waiting, model.parts)

    met = rows.select("bucket", "data", "number", "at").mapInArrow(run, "block long, part long, least long, data binary")
    return _written(met, "met")


def _beside(pairs: DataFrame, positions: DataFrame, buckets: int) -> DataFrame:
    """Rows of positions after the pairs of their bucket."""
    pairs = pairs.select("bucket", "data", F.lit(None).cast("long").alias("number"), F.lit(None).cast("binary").alias("at"))
    positions = positions.select("bucket", F.lit(None).cast("binary").alias("data"), "number", "at")
    both = pairs.unionByName(positions).repartition(buckets, "bucket")
    return both.sortWithinPartitions("bucket", F.col("data").isNull())


def _sums(met: DataFrame, model: Model, shared) -> DataFrame:
    """``number`` and sums over a text's tokens: ``units``; and over those outside the dictionary: ``more_base``, in
    units too, and ``more_known``."""
    parts = model.shared.parts
    nothing = F.lit(0).cast("long")
    table = model.others.select((F.col("code") % parts).alias("part"), F.lit(0).alias("kind"), nothing.alias("least"), "code", "n", "times", F.lit(None).cast("binary").alias("data"))
    asked = met.where("part IS NOT NULL").select("part", F.lit(1).alias("kind"), "least", nothing.alias("code"), nothing.alias("n"), nothing.alias("times"), "data")
    both = table.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "kind")
    schema = pa.schema([("block", pa.int64()), ("data", pa.binary())])

    def look_up(rows):
        root, now, held, found = shared.value.root, None, [], None
        for batch in rows:
            part, kind = (batch[c].to_numpy() for c in ("part", "kind"))
            for a, b in _runs(part * 2 + kind):
                if part[a] != now:
                    now, held, found = part[a], [], None
                if kind[a] == 0:
                    held.append(np.stack([batch[c].to_numpy()[a:b] for c in ("code", "n", "times")]))
                    continue
                if found is None:
                    found = np.concatenate([*held, [[-1], [0], [0]]], axis=1, dtype=np.int64)
                    found = found[:, np.argsort(found[0])]
                for least, data in zip(batch["least"].slice(a, b - a).to_pylist(), batch["data"].slice(a, b - a)):
                    texts, tokens, own, menu = unpacked(data.as_py(), 4)
                    at = np.minimum(np.searchsorted(found[0], tokens), found.shape[1] - 1)
                    n, times = np.where(found[0][at] == tokens, found[1:, at], 0)
                    own, menu = (x.astype(np.int32).view(np.float32).astype(float) for x in (own, menu))
                    units = _units(own + menu * 10.0 ** root.log10(n))
                    for block, sums in _blocks(texts + least, units, _units(times + 1.0), (times > 0).astype(np.int64)):
                        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sums], pa.binary())], schema=schema)

    def add(rows):
        now, sums, seen = None, np.zeros((3, 1 << BLOCK_BITS), np.int64), np.zeros(1 << BLOCK_BITS, bool)

        def finished():
            at = np.flatnonzero(seen)
            return pa.RecordBatch.from_pydict({"number": at + (now << BLOCK_BITS)} | dict(zip(("units", "more_base", "more_known"), sums[:, at])))

        for batch in rows:
            for block, data in zip(batch["block"].to_pylist(), batch["data"]):
                if block != now:
                    if now is not None:
                        yield finished()
                    now, sums[:], seen[:] = block, 0, False
                text, *values = unpacked(data.as_py(), 4)
                sums[:, text] += values  # a row holds a text once
                seen[text] = True
        if now is not None:
            yield finished()

    rows = met.where("block IS NOT NULL").select("block", "data").unionByName(both.mapInArrow(look_up, "block long, data binary"))
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(add, "number long, units long, more_base long, more_known long")


def _scored(lines: DataFrame, met: DataFrame, key: str, model: Model, shared) -> DataFrame:
    texts = lines.where("n_tokens IS NOT NULL").select(F.col("key").alias(key), "number", "n_tokens", "n_known", "base")
    every = float(np.log10(model.shared.total + model.shared.distinct + 1.0))
    base = (F.col("base") + F.col("more_base")) * F.lit(UNIT) - F.col("n_tokens") * F.lit(every)
    return texts.join(_sums(met, model, shared), "number").select(
        key, "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"),
        F.lit(model.shared.total).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("units") * F.lit(UNIT)).alias("score"),
    )


def score(docs: DataFrame, key: str, model: Model) -> DataFrame:
    """Per row: ``key``, ``n_tokens``, ``n_known``, ``base_score`` (add-one unigrams) and ``score``, both log10."""
    inner = model.shared
    shared = docs.sparkSession.sparkContext.broadcast(inner)
    lines = _written(_lines(_keyed(docs, F.col(key), F.lit(False)), inner.tokens, inner.counts, inner.cuts), "positions")
    met = _met(_beside(model.pairs, lines.where("bucket IS NOT NULL"), inner.cuts.buckets), model, shared)
    return _scored(lines, met, key, model, shared)


def train_and_score(docs: DataFrame, key: str, learn: Column, settings: Settings = Settings()) -> DataFrame:
    """As :func:`score` of all rows by the model of those with ``learn``. Positions are shuffled once, for both: they
    lie beside the pairs of their bucket, but for those of hot pairs beyond four buckets' worth, which meet it later."""
    model, placed = _learnt(_keyed(docs, F.col(key), F.coalesce(learn, F.lit(False))), settings, 4 * settings.bucket)
    shared = docs.sparkSession.sparkContext.broadcast(model.shared)
    rows = placed.where("once IS NOT NULL").select("bucket", "data", "number", "at")
    beyond = placed.where("bucket IS NOT NULL AND once IS NULL").select("bucket", "number", "at")
    hot = beyond.select("bucket").distinct()
    if not hot.isEmpty():
        rows = rows.unionByName(_beside(model.pairs.join(hot, "bucket", "left_semi"), beyond, model.shared.cuts.buckets))
    return _scored(placed, _met(rows, model, shared), key, model, shared)
