"""Byte-pair encoding and decoding with forced boundaries.

A pair of bytes that occurs inside no token of the vocabulary can never be merged over, so the place
between the two is a certain cut. Texts are first cut before every space that begins a word, where the
pre-tokeniser's pattern always cuts too; inside these, every word of the pattern is cut at all pairs
that no token holds. The fragments are encoded independently, those seen before from memory, and the
ids concatenated. Cuts inside a word can't change what the pattern does, since it ran before.

Texts are encoded whole. The special token's string becomes its id, as the tokenizers library does.
Null text counts as empty and has no ids; a null key is kept, repeated rows are rows of their own, other
columns are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from respondry.llm.common import schema_with, text_bytes

#: The pattern of byte-level pre-tokenisers.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Before a space that begins a word the pattern cuts, whatever stands around it.
CUT = re.compile(r"(?= \S)")
#: Ids fit in so many bits.
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
NO_MERGE = 1 << 62
#: Fragments remembered by a Python worker, and the longest that is.
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64
#: Longer fragments are merged with a heap.
SHORT = 24


def byte_letters() -> dict[str, int]:
    """The letters by which such vocabularies write bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """``merges`` maps two ids (the first shifted) to the rank (shifted) and the id of the merged token.

    ``never`` has the byte pairs that stand inside no token.
    """

    tokens: dict[int, bytes]
    bytes_to_id: list[int]
    merges: dict[int, int]
    special: dict[str, int]
    never: frozenset[bytes]


@cache
def vocabulary(path: str) -> Vocabulary:
    """Read once by each process; the file belongs to the installation, so executors have it too."""
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in read["added_tokens"]}
    ids = {text: i for text, i in read["model"]["vocab"].items() if text not in special}
    tokens = {i: bytes(letters[x] for x in text) for text, i in ids.items()}
    merges = {}
    for rank, pair in enumerate(read["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.setdefault(ids[left] << ID_BITS | ids[right], rank << ID_BITS | ids[left + right])
    inside = {token[i : i + 2] for token in tokens.values() for i in range(len(token) - 1)}
    never = frozenset(bytes((a, b)) for a in range(256) for b in range(256)) - inside
    single = {token[0]: i for i, token in tokens.items() if len(token) == 1}
    tokens |= {i: text.encode() for text, i in special.items()}
    return Vocabulary(tokens, [single[b] for b in range(256)], merges, special, never)


def certain_pieces(word: bytes, never: frozenset[bytes]) -> list[bytes]:
    """``word`` cut between every two bytes that no token holds side by side."""
    cuts = [i + 1 for i in range(len(word) - 1) if word[i : i + 2] in never]
    if not cuts:
        return [word]
    edges = [0, *cuts, len(word)]
    return [word[a:b] for a, b in zip(edges, edges[1:])]


def _merged_short(ids: list[int], merges: dict[int, int]) -> list[int]:
    """The pair of lowest rank, the leftmost of equals, is merged until none is left."""
    get = merges.get
    pairs = [get(a << ID_BITS | b, NO_MERGE) for a, b in zip(ids, ids[1:])]
    while pairs and (best := min(pairs)) < NO_MERGE:
        i = pairs.index(best)
        ids[i] = best & ID_MASK
        del ids[i + 1], pairs[i]
        if i:
            pairs[i - 1] = get(ids[i - 1] << ID_BITS | ids[i], NO_MERGE)
        if i < len(pairs):
            pairs[i] = get(ids[i] << ID_BITS | ids[i + 1], NO_MERGE)
    return ids


def _merged_long(ids: list[int], merges: dict[int, int]) -> list[int]:
    """Same result by a heap of candidate pairs over a linked list."""
    n = len(ids)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = []

    def offer(i):
        if i >= 0 and after[i] >= 0 and (found := merges.get(ids[i] << ID_BITS | ids[after[i]])) is not None:
            heapq.heappush(heap, (found >> ID_BITS, i, found & ID_MASK, ids[i], ids[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, new, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j < 0 or ids[j] != right:
            continue
        ids[i], ids[j] = new, -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [x for x in ids if x >= 0]


def fragment_ids(vocab: Vocabulary, fragment: str) -> list[int]:
    out: list[int] = []
    single = vocab.bytes_to_id
    for word in PATTERN.findall(fragment):
        for piece in certain_pieces(word.encode(), vocab.never):
            ids = [single[b] for b in piece]
            out += (_merged_short if len(ids) <= SHORT else _merged_long)(ids, vocab.merges)
    return out


def encode(vocab: Vocabulary, text: str, memory: dict[str, bytes]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    segments = [(text, None)]
    for special, number in vocab.special.items():
        cut: list[tuple[str, int | None]] = []
        for part, after in segments:
            found = part.split(special)
            cut += [(x, number) for x in found[:-1]] + [(found[-1], after)]
        segments = cut
    out = []
    for part, after in segments:
        cut = CUT.split(part)
        ids = list(map(memory.get, cut))
        if None in ids:
            for i, (fragment, known) in enumerate(zip(cut, ids)):
                if known is None:
                    known = ids[i] = array("I", fragment_ids(vocab, fragment)).tobytes()
                    if len(memory) < REMEMBERED and len(fragment) <= LONGEST_REMEMBERED:
                        memory[fragment] = known
        out += ids
        if after is not None:
            out.append(after.to_bytes(4, "little"))
    return b"".join(out)


def decode(vocab: Vocabulary, ids: bytes) -> str:
    tokens = vocab.tokens
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@cache
def memory_of(path: str) -> dict[str, bytes]:
    """Ids of fragments seen by this Python worker, in any of its tasks."""
    return {}


def encoded(docs: DataFrame, path: str, key: str) -> DataFrame:
    """``key`` and ``ids`` (binary, little-endian unsigned 32-bit) of the column ``text``."""

    def run(rows):
        vocab, memory = vocabulary(path), memory_of(path)
        for batch in rows:
            ids = [encode(vocab, text or "", memory) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(ids, pa.binary())], names=[key, "ids"])

    return docs.select(key, "text").mapInArrow(run, schema_with(docs.select(key), "ids binary"))


def decoded(encoded_docs: DataFrame, path: str, key: str) -> DataFrame:
    """``key`` and the ``text`` of the column ``ids``; null ids give empty text."""

    def run(rows):
        vocab = vocabulary(path)
        for batch in rows:
            texts = [decode(vocab, ids or b"") for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(texts, pa.string())], names=[key, "text"])

    return encoded_docs.select(key, "ids").mapInArrow(run, schema_with(encoded_docs.select(key), "text string"))


def digests(docs: DataFrame, path: str, key: str) -> DataFrame:
    """Round trip per row: ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, without keeping the ids."""

    def run(rows):
        vocab, memory = vocabulary(path), memory_of(path)
        for batch in rows:
            n, ids_sha, text_sha = [], [], []
            for text in batch["text"].to_pylist():
                ids = encode(vocab, text.decode("utf-8", "replace"), memory)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decode(vocab, ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch[key], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = schema_with(docs.select(key), "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select(key, text_bytes("text")).mapInArrow(run, schema)
