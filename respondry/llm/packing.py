"""Packing tokenised documents into sequences by a configuration linear program.

A document is its ids and one end id. Longer ones than ``capacity`` are cut into full pieces, after a
first piece that may be shorter. Full pieces are sequences of their own; all others are packed by the
histogram of their lengths, which has at most ``capacity`` entries however many documents there are.

A configuration says how many pieces of which lengths share a sequence. The program asks for the fewest
configurations that cover the histogram. It is solved in rounds of multiplicative weights: every length
has a weight that falls as its cover runs ahead; an unbounded-knapsack table prices the configurations;
each length that lags takes the best configuration that holds it. The fractional solution is rounded to
whole numbers in several ways (up, down, to the nearest; all configurations or the full ones alone),
those with the longest piece first, never beyond what is left of the histogram; what remains is packed
by largest fitting length first, and the rounding with the fewest sequences is the plan. Pieces then take the places of the plan by their number within their
length, which is found in shares so that no task holds all pieces of one length.

Null text counts as empty, so it is the end id alone; a null key is kept. Texts are encoded whole, whatever
they hold. Repeated rows are packed one by one; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from respondry.llm import encoding
from respondry.llm.common import schema_with, task_numbers, text_bytes
from respondry.sources.workspace import written

#: Rounds of multiplicative weights, and how fast a weight falls as its length runs ahead.
ROUNDS = 40
HASTE = 1.0
#: Share of its pieces by which a length may run ahead, and prices asked for in a round.
SLACK = 0.1
PASSES = 4


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``length`` ids."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def pieces(docs: DataFrame, path: str, key: str, capacity: int, end: int = 0) -> DataFrame:
    """Per piece: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` and a ``number`` unique to it."""
    added = "piece int, start long, length long, ids_crc32 long, number long"

    def run(rows):
        numbers = task_numbers()
        for batch in rows:
            place, piece, starts, lengths, crcs = [], [], [], [], []
            for row, text in enumerate(batch["text"].to_pylist()):
                ids = np.append(encoding.ids(path, text.decode("utf-8", "replace")), end).astype("<u4")
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    place.append(row)
                    piece.append(i)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(ids[start : start + length].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch[key].take(pa.array(place, pa.int64())), pa.array(piece, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array([next(numbers) for _ in piece], pa.int64()),
                ],
                names=[key, "piece", "start", "length", "ids_crc32", "number"],
            )

    return docs.select(key, text_bytes("text")).mapInArrow(run, schema_with(docs.select(key), added))


def priced(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: best value of every capacity, and the length it takes last (0 for none).

    ``values[l]`` is the value of length l; lengths that may not be used have a negative one.
    """
    size = len(values)
    best, last = np.zeros(size), np.zeros(size, np.int64)
    for room in range(1, size):
        gain = values[1 : room + 1] + best[room - 1 :: -1]
        at = int(np.argmax(gain))
        if gain[at] > best[room - 1]:
            best[room], last[room] = gain[at], at + 1
        else:
            best[room], last[room] = best[room - 1], 0
    return best, last


def configuration(first: int, last: np.ndarray) -> tuple[int, ...]:
    """The best configuration that holds ``first``, from a priced table; lengths falling."""
    room, lengths = len(last) - 1 - first, [first]
    while room > 0:
        if last[room]:
            lengths.append(int(last[room]))
            room -= last[room]
        else:
            room -= 1
    return tuple(sorted(lengths, reverse=True))


def solve(histogram: np.ndarray, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Configurations with how often each is used, fractional; no length is covered more than it occurs.

    ``histogram[l]`` pieces have length l. In round r every length is due for r shares of its pieces
    and may run ahead by :data:`SLACK`; lengths that have no room left are not priced. What stays
    uncovered because no round found room for it is left to the rounding.
    """
    capacity = len(histogram) - 1
    present = np.flatnonzero(histogram)
    pieces = histogram.astype(float)
    share = np.arange(capacity + 1) / capacity
    cover = np.zeros(capacity + 1)
    used: dict[tuple[int, ...], float] = {}
    for turn in range(1, rounds + PASSES):
        due = min(turn / rounds, 1.0)
        for _ in range(PASSES):
            room = min(due + SLACK, 1.0) * pieces - cover
            lag = due * pieces - cover
            late = present[lag[present] > 1e-6][::-1]
            if not late.size:
                break
            open_ = present[room[present] > 1e-6]
            values = np.full(capacity + 1, -1.0)
            values[open_] = share[open_] * np.exp(-HASTE * (cover[open_] / pieces[open_] - due))
            _, last = priced(values)
            moved = False
            for length in late.tolist():
                lengths = configuration(length, last)
                need = Counter(lengths)
                times = min((due * pieces[length] - cover[length]) / need[length], *(room[x] / n for x, n in need.items()))
                if times > 1e-6:
                    moved = True
                    used[lengths] = used.get(lengths, 0.0) + times
                    for x, n in need.items():
                        cover[x] += n * times
                        room[x] -= n * times
            if not moved:
                break
    return used


def rounded(
    histogram: np.ndarray, used: dict[tuple[int, ...], float], whole=np.ceil, least: int = 0
) -> list[tuple[tuple[int, ...], int]]:
    """Configurations with whole numbers of sequences that take every piece exactly once.

    ``whole`` rounds how often a configuration is used; those filled below ``least`` are left out.
    """
    left, capacity = histogram.astype(np.int64).copy(), len(histogram) - 1
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(lengths, most):
        need = Counter(lengths)
        times = min(most, *(left[x] // n for x, n in need.items()))
        if times > 0:
            plan.append((lengths, int(times)))
            for x, n in need.items():
                left[x] -= n * times

    for lengths, times in sorted(used.items(), key=lambda x: (-x[0][0], -sum(x[0]), -x[1], x[0])):
        if sum(lengths) >= least:
            take(lengths, int(whole(times)))
    while (present := np.flatnonzero(left)).size:
        room, lengths, free = capacity, [], left.copy()
        while (fits := present[: np.searchsorted(present, room, "right")]).size:
            fits = fits[free[fits] > 0]
            if not fits.size:
                break
            length = int(fits[-1])
            n = int(min(room // length, free[length]))
            lengths += [length] * n
            free[length] -= n
            room -= n * length
        take(tuple(lengths), int(left.max()))
    return plan


def planned(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """The program's rounding with the fewest sequences; the first of equals."""
    used, capacity = solve(histogram), len(histogram) - 1
    plans = [rounded(histogram, used, whole, least) for least in (0, capacity) for whole in (np.ceil, np.rint, np.floor)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


class Places:
    """Where the r-th piece of a length goes: arrays sorted by length and first rank, for a search."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]]):
        rows, taken, sequence = [], {}, 0
        for lengths, times in plan:
            offset = 0
            for length in dict.fromkeys(lengths):
                n = lengths.count(length)
                first = taken.get(length, 0)
                rows.append((length << 40 | first, n, sequence, offset))
                taken[length] = first + n * times
                offset += n * length
            sequence += times
        self.sequences = sequence
        self.first, self.each, self.sequence, self.offset = np.array(sorted(rows) or [(0, 1, 0, 0)], np.int64).T

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code = (length << 40) | rank
        at = np.searchsorted(self.first, code, "right") - 1
        number = code - self.first[at]
        return self.sequence[at] + number // self.each[at], self.offset[at] + number % self.each[at] * length


def packed(docs: DataFrame, path: str, key: str, capacity: int = 2048) -> DataFrame:
    """Per piece: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    cutted = written(pieces(docs, path, key, capacity), "pieces")
    short = cutted.where(F.col("length") < capacity).withColumn("share", F.shiftright("number", 40))
    sizes = written(short.groupBy("length", "share").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most capacity rows
        histogram[row["length"]] = row["n"]
    places = Places(planned(histogram))
    shared = docs.sparkSession.sparkContext.broadcast(places)
    earlier = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "share").orderBy("number")
    ranked = short.withColumn("place", F.row_number().over(inside)).join(sizes, ["length", "share"])
    columns = [key, "piece", "start", "length", "ids_crc32"]
    ranked = ranked.select(*columns, (F.col("before") + F.col("place") - 1).alias("rank"))

    def run(rows):
        for batch in rows:
            sequence, offset = shared.value(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"]
            )

    placed = ranked.mapInArrow(run, schema_with(cutted.select(*columns), "sequence_id long, offset long"))
    whole = cutted.where(F.col("length") == capacity).select(
        *columns, (F.lit(places.sequences) + F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return placed.union(whole)
