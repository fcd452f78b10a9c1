"""Alignment of the tokens of two tokenizers by merging their byte ends in lockstep.

A text with a space in front is encoded by a byte-level BPE (A); the bare text by a sentencepiece model
(B), which adds that space. Where the joined bytes of both are the text's, an A and a B token are linked
if their byte ranges overlap, and bytes at which both end cut the tokens into groups.

Many documents are merged at once. A NumPy vector holds the current A and B token of every one of them;
a step links these, moves on in A, in B or in both, whichever ends first, and notes a cut where both end.
Finished documents leave the vector. So that one long text does not keep a vector of one alive, it enters
as several lanes, which begin where a token of A and one of B end together.

The links of an id pair are counted over the corpus by Spark. Documents are merged in lots of bounded
text; a lot lists its distinct pairs with their counts, which are added up by pair, and asks for the
totals of its own pairs again, so that neither a table of all pairs nor the links of all texts meet in a
task. The largest count of a B id is one of at most as many rows as B has pieces.

Null and empty texts, and those whose bytes do not come back, have no tokens: zeros and an empty digest.
Strings of special tokens inside a text are plain text. Texts are taken whole. Repeated rows are rows of
their own, and count; a null key is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.llm import bpe, encoding
from respondry.llm.common import schema_with, task_numbers, text_bytes
from respondry.sources.workspace import written

#: Text bytes merged at once, about, and the most documents.
LOT = 1 << 20
MOST = 10_000
#: Tokens of A after which a lane of a long text may end.
LANE = 256
#: Bits of a B id in the code of a pair.
PAIR_BITS = 20
SPACE_MARK = "▁"


@dataclass(frozen=True)
class Side:
    """``encode`` gives the ids of a text; ``token`` and ``size`` the bytes of an id and how many."""

    encode: object
    token: list[bytes]
    size: np.ndarray


@cache
def byte_level(path: str) -> Side:
    tokens = bpe.vocabulary(path).tokens
    token = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    return Side(lambda text: encoding.ids(path, " " + text, special=False), token, np.array([len(x) for x in token]))


@cache
def pieces(path: str) -> Side:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token = [
        bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE_MARK, " ").encode()
        for i in range(model.vocab_size())
    ]
    return Side(lambda text: np.array(model.encode(text), np.uint32), token, np.array([len(x) for x in token]))


@cache
def numerals(size: int) -> list[str]:
    """Every number below ``size`` before a comma, then before a bar, then before a semicolon."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(size)]


@dataclass(frozen=True)
class Merged:
    """Links in order as token numbers ``a`` and ``b`` of the lot, and whether a group ends with each."""

    a: np.ndarray
    b: np.ndarray
    cut: np.ndarray


def lanes(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, long: int = LANE) -> np.ndarray:
    """Rows ``(first a, first b, a to end at)`` of the lanes of every document.

    ``a_first`` and ``b_first`` are the documents' first token numbers, with the total behind them; ends are
    byte offsets that rise over the whole lot.
    """
    start, stop = a_first[:-1], a_first[1:]
    extra = np.maximum(stop - start - 1, 0) // long
    document = np.repeat(np.arange(len(start)), extra)
    number = np.arange(len(document)) - np.repeat(np.cumsum(extra) - extra, extra)
    a = start[document] + (number + 1) * long
    at = np.searchsorted(b_ends, a_ends[a - 1])
    common = b_ends[at] == a_ends[a - 1] if len(a) else np.zeros(0, bool)
    firsts = np.concatenate([start, a[common]])
    seconds = np.concatenate([b_first[:-1], at[common] + 1])
    order = np.argsort(firsts, kind="stable")
    firsts, seconds = firsts[order], seconds[order]
    return np.stack([firsts, seconds, np.append(firsts, a_first[-1])[1:]], axis=1)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, lane: np.ndarray) -> Merged:
    """Merge all lanes at once. Link number a + b is the place of a link, since one of both rises with each step."""
    room = len(a_ends) + len(b_ends)
    linked, cut = np.full(room, -1, np.int64), np.zeros(room, bool)
    a, b, stop = lane.T.copy()
    while len(a):
        ends_a, ends_b = a_ends[a], b_ends[b]
        place = a + b
        linked[place] = a
        cut[place] = ends_a == ends_b
        a = a + (ends_a <= ends_b)
        b = b + (ends_b <= ends_a)
        open_ = a < stop
        if not open_.all():
            a, b, stop = a[open_], b[open_], stop[open_]
    place = np.flatnonzero(linked >= 0)
    a = linked[place]
    return Merged(a, place - a, cut[place])


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, merged: Merged, documents: np.ndarray) -> list[str]:
    """Per document (first link of each, and the total) its groups as ``a1,a2|b1;a3|b2,b3``."""
    group = np.cumsum(merged.cut) - merged.cut
    a_group, b_group = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_group[merged.a], b_group[merged.b] = group, group
    ids = np.concatenate([a_ids, b_ids])
    key = np.concatenate([2 * a_group, 2 * b_group + 1])
    order = np.argsort(key, kind="stable")
    key, ids = key[order], ids[order]
    last = np.append(key[1:] != key[:-1], True)
    size = int(ids.max(initial=0)) + 1
    after = np.where(last, 1 + key % 2, 0)
    text = list(map(numerals(1 << size.bit_length()).__getitem__, (ids + (after << size.bit_length())).tolist()))
    tokens = np.searchsorted(key, 2 * np.append(group[documents[:-1]], group[-1] + 1 if len(group) else 0))
    return ["".join(text[i:j])[:-1] for i, j in zip(tokens, tokens[1:])]


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes: all low bytes, then all second ones, and so on."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def aligned_lot(texts: list[bytes], first: Side, second: Side) -> dict:
    """Results of a lot's documents, its distinct pairs, their counts, and each link's pair as a number."""
    a, b = [], []
    for text in texts:
        one, two = (side.encode(text.decode("utf-8", "replace")) for side in (first, second))
        sides = ((first, one), (second, two))
        same = text and all(b"".join([side.token[x] for x in found.tolist()]) == b" " + text for side, found in sides)
        a.append(one if same else one[:0])
        b.append(two if same else two[:0])
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    a_ids, b_ids = (np.concatenate([*side, np.zeros(0, np.uint32)]).astype(np.int64) for side in (a, b))
    a_ends, b_ends = np.cumsum(first.size[a_ids]), np.cumsum(second.size[b_ids])
    known = np.flatnonzero(n_a)
    a_first, b_first = (np.append(0, np.cumsum(n[known])) for n in (n_a, n_b))
    merged = lockstep(a_ends, b_ends, lanes(a_ends, b_ends, a_first, b_first))
    starts = np.searchsorted(merged.a + merged.b, a_first + b_first)
    n_links, n_groups = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    n_links[known] = np.diff(starts)
    n_groups[known] = np.diff(np.append(0, np.cumsum(merged.cut))[starts])
    digests = [""] * len(texts)
    for i, text in zip(known.tolist(), group_texts(a_ids, b_ids, merged, starts)):
        digests[i] = hashlib.sha256(text.encode()).hexdigest()
    pairs = a_ids[merged.a] << PAIR_BITS | b_ids[merged.b]
    pairs, link, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    # frequent pairs get small numbers, which pack well
    order = np.argsort(-counts, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    pairs, counts, link = pairs[order], counts[order], rank[link]
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digests,
        "pairs": pairs, "counts": counts, "links": packed(link),
    }


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def lots(docs: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """A row per lot of documents: their results as arrays, the lot's pairs, counts and links."""

    def run(rows):
        one, two, numbers = byte_level(first), pieces(second), task_numbers()

        def out(keys, texts):
            found = aligned_lot(texts, one, two)
            whole = pa.int64()
            cells = [pa.array([next(numbers)], whole), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)]
            cells += [pa.array([found[c]], pa.list_(whole)) for c in COUNTS]
            cells += [pa.array([found["groups_sha256"]], pa.list_(pa.string())), pa.array([found["pairs"]], pa.list_(whole))]
            cells += [pa.array([found["counts"]], pa.list_(whole)), pa.array([found["links"]], pa.binary())]
            return pa.RecordBatch.from_arrays(cells, names=["lot", "keys", *COUNTS, "groups_sha256", "pairs", "counts", "links"])

        for batch in rows:
            at, room, texts = 0, 0, []
            for i, text in enumerate(batch["text"].to_pylist()):
                texts.append(text)
                room += len(text)
                if room >= LOT or len(texts) >= MOST:
                    yield out(batch[key].slice(at, len(texts)), texts)
                    at, room, texts = i + 1, 0, []
            if texts:
                yield out(batch[key].slice(at, len(texts)), texts)

    kind = dict(docs.dtypes)[key]
    schema = f"lot long, keys array<{kind}>, " + ", ".join(f"{c} array<long>" for c in COUNTS)
    return docs.select(key, text_bytes("text")).mapInArrow(
        run, schema + ", groups_sha256 array<string>, pairs array<long>, counts array<long>, links binary"
    )


def pair_totals(lot: DataFrame) -> DataFrame:
    """``pair``, its links in the corpus ``n``, and whether no pair of its B id has more (``best``)."""
    each = lot.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("x.pairs", "x.counts")
    totals = written(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")), "pairs")
    piece = F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1)
    most = totals.groupBy(piece.alias("piece")).agg(F.max("n").alias("most"))
    # at most a row per piece of B's vocabulary
    return totals.join(F.broadcast(most), piece == F.col("piece")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Per row: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    lot = written(lots(docs, key, first, second), "lots")
    asked = lot.select("lot", F.posexplode("pairs").alias("place", "pair"))
    known = asked.join(pair_totals(lot), "pair").groupBy("lot")
    known = known.agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("known"))
    known = known.select("lot", F.col("known.n").alias("totals"), F.col("known.best").alias("best"))
    rows = lot.drop("pairs", "counts").join(known, "lot", "left")
    names = [key, *COUNTS, "n_best", "count_sum", "groups_sha256"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                n_links = batch["n_links"][i].values.to_numpy()
                link = unpacked(batch["links"][i].as_py())
                if len(link):
                    totals = batch["totals"][i].values.to_numpy()
                    best = batch["best"][i].values.to_numpy(zero_copy_only=False)
                else:
                    totals, best = np.zeros(0, np.int64), np.zeros(0, bool)
                ends = np.append(0, np.cumsum(n_links))
                sums, bests = (np.diff(np.append(0, np.cumsum(x[link], dtype=np.int64))[ends]) for x in (totals, best))
                cells = [batch["keys"][i].values, *(batch[c][i].values for c in COUNTS)]
                yield pa.RecordBatch.from_arrays([*cells, pa.array(bests), pa.array(sums), batch["groups_sha256"][i].values], names=names)

    schema = schema_with(docs.select(key), ", ".join(f"{c} long" for c in names[1:-1]) + ", groups_sha256 string")
    return rows.mapInArrow(run, schema)
