"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

A fingerprint has 64 bits; bit i is set where more than half of the XXH64 values (seed 42) of a
text's shingles have it. Fingerprints that differ in at most ``radius`` bits are linked, and documents
joined through links form a group.

Equal fingerprints are reduced to one before any comparison. The rest is cut into tiles by the
population counts of the four 16-bit quarters. A differing bit changes one count by one, so two tiles
whose counts differ by more than the radius in sum hold no link and are never compared; all others
are, by exclusive-or and bit counts over whole tiles. Large tiles are cut further by a hash so that no
task holds more than a bounded number of fingerprints. Nothing is left out.

Null text counts as empty; a text without words has fingerprint zero and is linked like any other.
Repeated rows and equal keys stay as they are; a null key takes part in no link and is its own
component (null).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respondry.llm.common import schema_with, text_bytes, words
from respondry.llm.components import components
from respondry.sources.workspace import written

#: Fingerprints in a tile, about.
TILE = 4096
#: Shingles hashed at a time.
BLOCK = 1 << 16


def shingle_hashes(text: bytes, length: int = 3) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of ``length`` words, repeats included; of all words where fewer."""
    found = words(text)
    if not found:
        return
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends + 1).tolist()]
    ends = ends[min(length, len(found)) - 1 :].tolist()
    for first in range(0, len(ends), BLOCK):
        part = ends[first : first + BLOCK]
        hashed = [xxhash.xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts[first:], part)]
        yield np.array(hashed, np.uint64)


def fingerprint(text: bytes, length: int = 3) -> int:
    total, count = np.zeros(64, np.int64), 0
    for hashed in shingle_hashes(text, length):
        bits = np.unpackbits(hashed.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
        count += len(hashed)
    return sum(1 << i for i in np.flatnonzero(2 * total > count).tolist())


def fingerprints(docs: DataFrame, key: str, length: int = 3) -> DataFrame:
    """``key`` and the ``fingerprint`` of the column ``text`` as a signed long."""

    def run(rows):
        for batch in rows:
            found = np.array([fingerprint(x, length) for x in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(found.view(np.int64))], names=[key, "fingerprint"])

    schema = schema_with(docs.select(key), "fingerprint long")
    return docs.select(key, text_bytes("text")).mapInArrow(run, schema)


def quarters(fingerprint: Column) -> list[Column]:
    return [
        F.bit_count(F.shiftrightunsigned(fingerprint, 16 * i).bitwiseAND(0xFFFF)).alias(f"q{i}") for i in range(4)
    ]


def near_counts(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts that allow at most ``radius`` differing bits, each pair once."""
    steps = itertools.product(range(-radius, radius + 1), repeat=4)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]


def linked(first: np.ndarray, second: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs within the radius, a strip of rows at a time."""
    strip = max(1, (1 << 20) // max(len(second), 1))
    for start in range(0, len(first), strip):
        rows = first[start : start + strip]
        bits = np.bitwise_count(rows[:, None] ^ second[None, :])
        a, b = np.nonzero(bits <= radius)
        if same:
            a, b = a[a + start < b], b[a + start < b]
        if len(a):
            yield a + start, b


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """All pairs ``(first, second)`` of different fingerprints of the written table ``prints`` within the radius."""
    unique = prints.select("fingerprint").distinct()
    counted = [f"q{i}" for i in range(4)]
    unique = unique.select("fingerprint", *quarters(F.col("fingerprint")))
    sizes = unique.groupBy(*counted).agg(F.ceil(F.count("*") / TILE).alias("parts"))
    cut = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).alias("part")
    # at most 17 ** 4 rows
    tiles = unique.join(F.broadcast(sizes), counted).select("fingerprint", *counted, cut)
    tiles = tiles.groupBy(*counted, "part").agg(F.sort_array(F.collect_list("fingerprint")).alias("prints"))
    tiles = written(tiles.withColumn("tile", F.concat_ws("-", *counted, "part")), "tiles")
    steps = F.array(*[F.array(*map(F.lit, step)) for step in near_counts(radius)])
    ends = tiles.select(F.col("tile").alias("one"), *counted, F.explode(steps).alias("step"))
    ends = ends.select("one", *[(F.col(f"q{i}") + F.col("step")[i]).alias(f"q{i}") for i in range(4)])
    pairs = ends.join(tiles.select(F.col("tile").alias("two"), *counted), counted).select("one", "two")
    own = F.substring_index("one", "-", 4) == F.substring_index("two", "-", 4)
    pairs = pairs.where(~own | (F.col("one") <= F.col("two")))
    pairs = pairs.join(tiles.select(F.col("tile").alias("one"), F.col("prints").alias("first")), "one")
    pairs = pairs.join(tiles.select(F.col("tile").alias("two"), F.col("prints").alias("second")), "two")
    schema = pa.schema([("first", pa.int64()), ("second", pa.int64())])

    def run(rows):
        for batch in rows:
            for i in range(batch.num_rows):
                first, second = (
                    batch[c][i].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in ("first", "second")
                )
                same = batch["one"][i].as_py() == batch["two"][i].as_py()
                for a, b in linked(first, second, radius, same):
                    yield pa.record_batch([first[a].view(np.int64), second[b].view(np.int64)], schema=schema)

    return pairs.select("one", "two", "first", "second").mapInArrow(run, "first long, second long")


def groups(docs: DataFrame, key: str, radius: int = 2, length: int = 3) -> DataFrame:
    """Per row of ``docs``: ``key``, ``fingerprint`` (signed long) and ``component_id``, the group's smallest key."""
    prints = written(fingerprints(docs, key, length), "fingerprints")
    smallest = prints.groupBy("fingerprint").agg(F.min(key).alias("smallest"))
    found = links(prints, radius)
    for side in ("first", "second"):
        named = smallest.select(F.col("fingerprint").alias(side), F.col("smallest").alias(f"{side}_key"))
        found = found.join(named, side)
    joined = components(found, "first_key", "second_key")
    smallest = smallest.join(joined, smallest["smallest"] == joined["node"], "left")
    smallest = smallest.select("fingerprint", F.coalesce("component", "smallest").alias("component_id"))
    # a fingerprint may be that of a third of all rows: spread it over shares
    shares = 32
    smallest = smallest.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    spread = prints.withColumn("share", F.pmod(F.xxhash64(key), F.lit(shares)).cast("int"))
    grouped = spread.join(smallest, ["fingerprint", "share"])
    component = F.when(F.col(key).isNotNull(), F.col("component_id"))
    return grouped.select(key, "fingerprint", component.alias("component_id"))


def hexadecimal(fingerprint: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fingerprint)), 16, "0"))
