"""WARC archives with revisit records, and their capture index by external merge.

Records are written by Spark's text writer: a record is text, its payload being UTF-8, and the two line
ends that close a record are the writer's line separator. Archives are read back line by line; a
payload ends where ``Content-Length`` says, so it may hold anything, record heads as well.

Of captures with equal payloads of at least ``least`` bytes, the one with the largest key is a response
and the others revisit it without a payload of their own; all smaller ones are responses.

The index is merged outside memory: every archive task writes a run sorted by URL key, time and record
key; the runs are dealt to ranges of that order, and in each range a loser tree merges the runs' parts,
so that the whole is in global order, the captures of one URL one after the other.

Null html is an empty payload; a null or empty URL has the empty URL key and no target line. Rows that
repeat the largest key of their payload are responses as well. Where all keys of a payload are null its
rows are responses; other rows with a null key revisit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.llm.common import task_numbers
from respondry.sources.workspace import new_path, written

END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 5_000
#: Shares over which the captures of one payload are spread.
SHARES = 32

INDEX = "url_key string, captured string, key long, record_type string, refers_to long, payload_bytes long, payload_digest string, run long"


def _line(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def classified(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """``pages`` with ``payload`` not null, its ``bytes`` and ``digest``, and ``first``: the key to refer to, if any."""
    pages = pages.withColumn(payload, F.coalesce(payload, F.lit("")))
    pages = pages.withColumn("bytes", F.octet_length(payload).cast("long"))
    pages = pages.withColumn("digest", F.sha1(F.col(payload).cast("binary")))
    share = F.pmod(F.xxhash64(key), F.lit(SHARES)).cast("int")
    groups = pages.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max(key).alias("first"), F.count("*").alias("n"))
    groups = groups.where("n > 1").drop("n")
    groups = groups.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    joined = pages.withColumn("share", share).join(groups, ["digest", "bytes", "share"], "left")
    revisits = F.col("first").isNotNull() & ~F.col(key).eqNullSafe(F.col("first"))
    return joined.withColumn("first", F.when(revisits, F.col("first")))


def write_archives(pages: DataFrame, key: str, url: str, payload: str, captured: Column, least: int = 1000) -> str:
    """Write a record per row of ``pages``; the folder of the gzipped archives."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload"), captured.alias("captured"))
    rows = classified(rows, "key", "payload", least)
    clean = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    name = F.concat(F.lit("<urn:capture:"), F.coalesce(F.col("key").cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("first").isNotNull()
    head = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", name),
        _line("WARC-Target-URI", F.when(clean != "", clean)),
        _line("WARC-Date", F.date_format(F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:capture:"), F.col("first").cast("string"), F.lit(">")))),
        _line("X-Payload-Length", F.when(revisit, F.col("bytes").cast("string"))),
        F.lit(f"Content-Type: text/html{END}Content-Length: "),
        F.when(revisit, "0").otherwise(F.col("bytes").cast("string")),
        F.lit(END + END),
    )
    record = F.concat(head, F.when(revisit, "").otherwise(F.col("payload")))
    folder = new_path(pages.sparkSession, "archives")
    writer = rows.select(record.alias("value")).write.option("lineSep", END + END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)
    return folder


def records(lines: Iterator[bytes]) -> Iterator[tuple[dict[str, str], int, str]]:
    """Headers, payload length and payload SHA-1 of each record; ``lines`` without their line feeds."""
    for line in lines:
        if line != b"WARC/1.1\r":
            continue
        headers = {}
        for line in lines:
            if line == b"\r":
                break
            name, _, value = line.decode().rstrip("\r").partition(": ")
            headers[name] = value
        length = left = int(headers["Content-Length"])
        digest = hashlib.sha1()
        while left > 0:
            line = next(lines) + b"\n"
            digest.update(line[:left])
            left -= len(line)
        yield headers, length, digest.hexdigest()


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the path; without scheme, user, ``www.`` and fragment."""
    rest = url.partition("://")[2] or url
    rest = rest.partition("#")[0].lower()
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2], rest[cut:]
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + (path or "/") if rest else ""


def _number(name: str | None) -> int | None:
    value = (name or "null").rpartition(":")[2].rstrip(">")
    return None if value == "null" else int(value)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives, with the digest of the payload as read; see :data:`INDEX`."""
    lines = spark.read.option("lineSep", "\n").text(folder).select(F.col("value").cast("binary").alias("value"))
    schema = pa.schema([
        ("url_key", pa.string()), ("captured", pa.string()), ("key", pa.int64()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("run", pa.int64()),
    ])

    def run(rows):
        number = next(task_numbers()) >> 40
        held: list[tuple] = []
        for headers, length, digest in records(line for batch in rows for line in batch["value"].to_pylist()):
            stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if headers["WARC-Type"] == "revisit":
                length, digest = int(headers["X-Payload-Length"]), stated
            elif digest != stated:
                raise ValueError(f"payload of {headers['WARC-Record-ID']} doesn't match its digest")
            held.append((
                url_key(headers.get("WARC-Target-URI", "")), headers.get("WARC-Date"), _number(headers["WARC-Record-ID"]),
                headers["WARC-Type"], _number(headers.get("WARC-Refers-To")), length, digest, number,
            ))
            if len(held) == 10_000:
                yield pa.record_batch([list(c) for c in zip(*held)], schema=schema)
                held = []
        if held:
            yield pa.record_batch([list(c) for c in zip(*held)], schema=schema)

    return lines.mapInArrow(run, INDEX)


def merged_order(runs: list[list]) -> Iterator[tuple[int, int]]:
    """(run, place in it) of sorted runs in merged order, ties by run, by a tree of losers.

    Inner node i holds the run that lost the match of its two halves; the winner is kept outside. After
    the winner's run has moved on, only the matches on its way to the root are played again.
    """
    k = len(runs)
    at = [0] * k

    def beats(a, b):
        if a == -1 or b == -1:
            return a != -1
        if at[a] >= len(runs[a]) or at[b] >= len(runs[b]):
            return at[b] >= len(runs[b]) and (at[a] < len(runs[a]) or a < b)
        x, y = runs[a][at[a]], runs[b][at[b]]
        return x < y or (x == y and a < b)

    losers = [-1] * max(k, 1)
    winners = [-1] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while k and at[best] < len(runs[best]):
        yield best, at[best]
        at[best] += 1
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                best, losers[node] = losers[node], best
            node //= 2


def history(index: DataFrame) -> DataFrame:
    """The index in global order of URL key, time and key: partition after partition, row after row."""
    order = ["url_key", "captured", "key"]
    runs = written(index.sortWithinPartitions(*order), "runs")
    ranges = runs.repartitionByRange(*order).sortWithinPartitions("run", *order)

    def run(rows):
        batches = list(rows)
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        keys = list(zip(*([((x is not None), x) for x in table[c].to_pylist()] for c in order)))
        numbers = table["run"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        parts = [keys[a:b] for a, b in zip(edges, edges[1:])]
        places = [edges[r] + i for r, i in merged_order(parts)]
        yield from table.take(pa.array(places, pa.int64())).to_batches()

    return ranges.mapInArrow(run, INDEX)
