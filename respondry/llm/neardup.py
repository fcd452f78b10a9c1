"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Vectors are turned by rotations learnt so that signs of the turned components lose as little as
possible (Gong and Lazebnik's iterative quantisation), every bit balanced at its median. The bits are
cut into short keys, one hash table each; two vectors of a label that agree in any whole key are
compared by the cosine of the original vectors in double precision. With the default tables a pair at
0.98 shares no key in fewer than one case in a thousand; the tests measure it.

Equal vectors of a label are reduced to one with a count first. A bucket larger than ``block`` rows is
cut by a hash and every two parts meet in a group of their own, so a task holds two parts at most. Each
pair is counted in the first table that finds it, so links are exact counts of the pairs found without
ever being listed; only a forest of them is kept for the components.

The rotations are fitted on a bounded sample; every vector is indexed. Vectors that are null, zero or
hold a null or non-finite component, and vectors without a label, link with nothing. Vectors of different
length never link. A null key is kept with no links and a null component. Rows that repeat a key are
vectors of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.llm.common import schema_with
from respondry.llm.components import components
from respondry.llm.vectors import matrix, sample, unit, usable
from respondry.sources.workspace import written

SHARES = 32


@dataclass(frozen=True)
class Settings:
    sample: int = 10_000
    rotations: int = 2
    tables: int = 10
    bits: int = 12
    steps: int = 40
    block: int = 1024


def rotation(centred: np.ndarray, seed: int, steps: int) -> np.ndarray:
    """Alternate the nearest codes of the turned data and the rotation that best fits them."""
    turned, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(centred.shape[1],) * 2))
    for _ in range(steps):
        codes = np.where(centred @ turned >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(centred.T @ codes)
        turned = left @ right
    return turned


@dataclass(frozen=True)
class Codes:
    """``planes`` (width x bits) and ``cuts``: bit i is set where the i-th product exceeds its cut."""

    planes: np.ndarray
    cuts: np.ndarray
    tables: int
    bits: int

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """Rows x tables of whole numbers of ``bits`` bits."""
        on = (rows @ self.planes > self.cuts).reshape(len(rows), self.tables, self.bits)
        return on @ (1 << np.arange(self.bits))


def learnt(rows: np.ndarray, width: int, settings: Settings) -> Codes:
    wanted = settings.tables * settings.bits
    if not len(rows):
        rows = np.eye(width)
    centred = rows - rows.mean(axis=0)
    count = max(settings.rotations, -(-wanted // width))
    planes = np.concatenate([rotation(centred, seed, settings.steps) for seed in range(count)], axis=1)[:, :wanted]
    return Codes(planes, np.median(rows @ planes, axis=0), settings.tables, settings.bits)


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a symmetric table of links: each linked row and the first row of its component (its own left out)."""
    open_ = near.any(axis=1)
    members, roots = [], []
    for root in np.flatnonzero(open_):
        if not open_[root]:
            continue
        edge = reached = np.zeros(len(near), bool)
        edge[root] = True
        while edge.any():
            reached = reached | edge
            edge = near[edge].any(axis=0) & ~reached
        open_ &= ~reached
        reached[root] = False
        found = np.flatnonzero(reached)
        members.append(found)
        roots.append(np.full(len(found), root))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *members]), np.concatenate([empty, *roots])


def compared(ids, copies, rows, keys, part, table: int, cosine: float):
    """Links in one group: linked ids with the number of vectors they link to here, and a forest as id pairs.

    ``part`` is 1 or 2 where two parts meet and only pairs across count; 0 within a part.
    """
    near = rows @ rows.T >= cosine
    np.fill_diagonal(near, False)
    if part[0]:
        near &= part[:, None] != part[None, :]
    a, b = np.nonzero(near)
    first = np.ones(len(a), bool)
    for earlier in range(table):
        first &= keys[a, earlier] != keys[b, earlier]
    linked = np.bincount(a[first], copies[b[first]], len(ids)).astype(np.int64)
    members, roots = forest(near)
    some = np.flatnonzero(linked)
    return ids[some], linked[some], ids[members], ids[roots]


FOUND = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


def links(vectors: DataFrame, codes: Codes, cosine: float, block: int) -> DataFrame:
    """``(id, other, links)``: links of an id (other null) or an edge of the forest (links 0).

    ``vectors`` is a written table of ``id``, ``label``, ``vector`` and ``copies`` with distinct vectors.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(codes)
    width = len(codes.planes)

    def key_rows(rows):
        for batch in rows:
            found = shared.value.keys(unit(matrix(batch["vector"], width)))
            starts = pa.array(np.arange(len(found) + 1, dtype=np.int32) * codes.tables)
            keys = pa.ListArray.from_arrays(starts, pa.array(found.astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "keys"])

    keyed = vectors.select("id", "label", "vector", "copies")
    keyed = written(keyed.mapInArrow(key_rows, schema_with(keyed, "keys array<int>")), "keyed")
    bucket = ["label", "dims", "table", "key"]
    entries = keyed.select("id", "label", F.size("vector").alias("dims"), F.posexplode("keys").alias("table", "key"))
    counts = entries.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    counts = written(counts.select(*bucket, F.ceil(F.col("n") / block).cast("int").alias("parts")), "buckets")
    one = entries.join(counts.where("parts = 1").drop("parts"), bucket)
    one = one.select("id", *bucket, *[F.lit(0).alias(c) for c in ("i", "j", "side")])
    large = counts.where("parts > 1").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    cut = entries.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(SHARES)).cast("int")).join(large, [*bucket, "share"])
    cut = cut.withColumn("own", F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int"))
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(F.col("own") == F.col("with"), 0).when(F.col("own") < F.col("with"), 1).otherwise(2)
    cut = cut.select("id", *bucket, F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), side.alias("side"))
    group = [*bucket, "i", "j"]
    grouped = one.union(cut).join(keyed.drop("label"), "id")
    grouped = grouped.repartition(*group).sortWithinPartitions(*group)
    grouped = grouped.select("id", "vector", "copies", "keys", "table", "side", F.xxhash64(*group).alias("group"))

    def run(rows):
        held = None
        for batch in rows:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            numbers = table["group"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist()]
            yield from compare_groups(table, edges)
            held = table.slice(edges[-1])
        if held is not None:
            yield from compare_groups(held, [0, len(held)])

    def compare_groups(table, edges):
        if len(edges) < 2:
            return
        table = table.slice(0, edges[-1]).combine_chunks()
        columns = {c: table[c].chunk(0) for c in table.column_names}
        ids, copies = columns["id"].to_numpy(), columns["copies"].to_numpy()
        number, side = columns["table"].to_numpy(), columns["side"].to_numpy()
        units = unit(matrix(columns["vector"], width))
        keys = matrix(columns["keys"], codes.tables).astype(np.int64)
        out: list[list] = [[], [], []]
        for a, b in zip(edges, edges[1:]):
            if b - a < 2:
                continue
            some, n, members, roots = compared(ids[a:b], copies[a:b], units[a:b], keys[a:b], side[a:b], int(number[a]), cosine)
            out[0] += [*some.tolist(), *members.tolist()]
            out[1] += [*[None] * len(some), *roots.tolist()]
            out[2] += [*n.tolist(), *[0] * len(members)]
        if out[0]:
            yield pa.record_batch(out, schema=FOUND)

    return grouped.mapInArrow(run, "id long, other long, links long")


def near_duplicates(vectors: DataFrame, key: str, vector: str, label: str, cosine: float = 0.98, settings: Settings = Settings()) -> DataFrame:
    """Per row: ``key``, ``n_links``, ``component_id`` (smallest key reachable) and ``kept``."""
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    can = F.col("label").isNotNull() & F.col("key").isNotNull() & usable("vector")
    rows = written(rows.withColumn("vector", F.when(can, F.col("vector"))), "rows")
    able = rows.where("vector is not null")
    classes = able.groupBy("label", "vector").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    codes = learnt(sample(classes, "id", "vector", settings.sample, width), width, settings)
    found = written(links(classes, codes, cosine, settings.block), "links")
    counts = found.where("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null"), "id", "other").withColumnRenamed("node", "id")
    classes = classes.join(counts, "id", "left").join(joined, "id", "left")
    classes = classes.withColumn("component", F.coalesce("component", "id"))
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(smallest, "component").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", "copies", F.col("least").alias("key")
    )
    # a class of several rows has a copy in every share, by which hot ones are spread; others where their row is
    own = F.pmod(F.xxhash64("key"), F.lit(SHARES)).cast("int")
    copies = F.when(F.col("copies") > 1, F.sequence(F.lit(0), F.lit(SHARES - 1))).otherwise(F.array(own))
    classes = classes.withColumn("share", F.explode(copies)).drop("copies", "key")
    ready = able.withColumn("share", own).join(classes, ["label", "vector", "share"]).select("key", "n_links", "component_id")
    rest = rows.where("vector is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    out = ready.union(rest)
    kept = F.coalesce(F.col("key") == F.col("component_id"), F.lit(False))
    return out.select(F.col("key").alias(key), "n_links", "component_id", kept.alias("kept"))
