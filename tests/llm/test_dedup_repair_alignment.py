"""Exact dedup, conversation repair and token alignment against brute force, and odd input."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from respondry.llm import alignment, conversations, exactdup, queries
from respondry.llm.common import table
from respondry.sources.workspace import new_path

DOCS = "doc_id long, text string, lang string, digest string, pairs string, part string"


def plain(text):
    return "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None), (2, ""), (3, " \t"), (4, "Hot TEXT"), (5, "hot text"), (5, "hot text"), (6, "hot  text"), (7, "ÉCOLE Ünï"),
        (8, "école Ünï"), (None, "hot text"), (None, "alone"), (None, "alone"), (9, "<s> </s> <|endoftext|> <0x41> x"), (10, "▁a ▁"),
        (11, "中文😀 é́ don't  \n\n x"), (12, "a" * 3000), (13, " " * 50 + "y"), (14, "one two three. " * 900), (15, "\x00\x01"), (16, "�"),
    ]
    return spark.createDataFrame([(i, t, "en", "clash", "clash", "clash") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# --- exact dedup ---------------------------------------------------------------------------


def opened(spark, name, path=None):
    return exactdup.DigestIndex.opened(spark, path or new_path(spark, "index"), name, buckets=4)


def test_one_delivery_keeps_the_largest_id(spark, docs, nothing, monkeypatch):
    expected = Counter()
    groups = {}
    for r in docs.collect():
        groups.setdefault(plain(r["text"]), []).append(r["doc_id"])
    for text, ids in groups.items():
        keep = max(ids, key=lambda x: -1 if x is None else x)
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=str):
            expected[(i, keep, len(ids), i == keep and first, digest)] += 1
            first = first and i != keep
    for hot in (10_000, 1):  # few and all digests above the share that is broadcast
        monkeypatch.setattr(exactdup, "HOT", hot)
        index = opened(spark, f"one_{hot}")
        found = exactdup.deduplicated(index, exactdup.digests(docs, "doc_id"), "doc_id", "d").collect()
        index.close()
        got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex()) for r in found)
        assert got == expected
    index = opened(spark, "none")
    assert exactdup.deduplicated(index, exactdup.digests(nothing, "doc_id"), "doc_id", "d").isEmpty()
    index.close()


def test_the_index_outlives_a_session_name_and_a_repeated_delivery(spark, docs):
    path = new_path(spark, "index")
    index = opened(spark, "kept_one", path)
    first = exactdup.digests(docs.where("doc_id <= 5"), "doc_id")
    exactdup.deduplicated(index, first, "doc_id", "first").collect()
    index.close()
    index = opened(spark, "kept_two", path)
    before = index.table().count()
    again = exactdup.deduplicated(index, first, "doc_id", "first")
    assert again.where("kept").count() == before == index.table().count() == 3
    later = exactdup.deduplicated(index, exactdup.digests(docs.where("doc_id > 4"), "doc_id"), "doc_id", "later").collect()
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in later if r["doc_id"] in (5, 6, 7)}
    assert got == {5: (5, False), 6: (6, True), 7: (7, True)}
    shown = index.table().select("digest").hint("merge").join(index.table().hint("merge"), "digest")
    assert "Exchange hashpartitioning" not in shown._jdf.queryExecution().executedPlan().toString()
    index.close()


# --- conversation repair -------------------------------------------------------------------

CHAR = re.compile(r"[^\x20\x09-\x0D]")


def audited(rows):
    """Cost and audit by all scripts at once: the least (cost, letters) per state, row by row."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    states = {"": (0, "", ())}

    def grown(states):
        for _ in range(4):
            for state, (cost, audit, lines) in list(states.items()):
                for role in after[state].replace("s", ""):
                    new = (cost + 5, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[role]))
                    states[role] = min(states.get(role, new), new)
        return states

    for role, text, fault in rows:
        new = {}

        def offer(state, cost, audit, lines):
            new[state] = min(new.get(state, (cost, audit, lines)), (cost, audit, lines))  # noqa: B023

        for state, (cost, audit, lines) in grown(states).items():
            offer(state, cost + 2, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            for to in after[state]:
                if role[:1] == to:
                    offer(to, cost + extra, audit + "K", (*lines, f"{role}:{text}"))
                if to in "ua":
                    offer(to, cost + 1 + extra, audit + "R", (*lines, {"u": "user:", "a": "assistant:"}[to] + text))
        states = new
    states = grown(states)
    return min(states[x] for x in ("", "a") if x in states)


def repaired(rows):
    """The contract, row by row, for ``(conv_id, turn, role, text)`` in order of reading."""
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            held[conv] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    out = {}
    for conv, kept in held.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        seen, faults = set(), []
        for _, role, text in kept:
            found = CHAR.findall(text)
            faults.append(
                "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = audited([(r, t, f) for (_, r, t), f in zip(kept, faults)])
        count = Counter(faults)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


def got(frame):
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = [tuple(r) for r in frame.select(*columns).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def made_up(seed, conversations_, longest):
    random_ = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ufo", "User"]
    texts = ["Yes.", "No", "a\nb!", "", " \x0b", None, "What?", "é中.", "\x85", "Yes.", "long " * 30 + "."]
    rows = []
    for conv in [None, *range(conversations_)]:
        for turn in range(random_.randint(0, longest)):
            rows.append((conv, random_.choice([turn, turn, turn, None, turn + 3]), random_.choice(roles), random_.choice(texts)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, audit string, part string, cost string"


def frame(spark, rows, parts=1):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).coalesce(parts)


@pytest.mark.parametrize("block", [4096, 5, 1])
def test_repair_equals_brute_force(spark, monkeypatch, block):
    # small blocks cut conversations, so that they are put together from parts
    rows = made_up(1, 150, 9) + [(999, i, ["user", "assistant"][i % 2], f"Turn {i % 40}.") for i in range(300)]
    rows += [(1000, 0, "user", "Again and again.")] * 50
    monkeypatch.setattr(conversations, "BLOCK_ROWS", block)
    monkeypatch.setattr(conversations, "_blocks", patched(block))
    assert got(conversations.repaired(conversations.damaged(frame(spark, rows)))) == repaired(rows)


def patched(block, blocks=conversations._blocks):
    def made(kind):
        run = blocks(kind)

        def inside(batches):
            conversations.BLOCK_ROWS = block
            yield from run(batches)

        return inside

    return made


def test_halving_equals_enumeration():
    random_ = random.Random(2)
    for _ in range(600):
        codes = bytes(random_.randrange(12) for _ in range(random_.randint(0, 5)))
        rows = [("suat"[c // 3], "x", ("", "blank", "truncated")[c % 3]) for c in codes]
        audit, state = conversations.least(codes, 0, conversations.END_COSTS)
        audit += conversations.ENDING[state]
        cost, expected, _ = audited(rows)
        assert audit == expected and conversations.applied(audit, 0, codes, [r for r, _, _ in rows], ["x"] * len(rows))[1] == cost
        # every script of at most as many letters, one by one
        least = None
        for n in range(len(codes), len(codes) + (3 if len(codes) < 5 else 2)):
            for letters in itertools.product("DIKR", repeat=n):
                if sum(x != "I" for x in letters) == len(codes) and (found := played(letters, rows)) is not None:
                    least = min(least or (found, "".join(letters)), (found, "".join(letters)))
        assert least is None or least >= (cost, audit)


def played(letters, rows):
    """Cost of a script, None where it isn't one."""
    out, cost, at = "", 0, 0
    due = lambda: "a" if out.endswith("u") else "u"
    for letter in letters:
        if letter == "I":
            out, cost = out + due(), cost + 5
            continue
        role, _, fault = rows[at]
        at += 1
        if letter == "D":
            cost += 2
            continue
        if fault == "blank":
            return None
        cost += 5 * (fault == "truncated") + (letter == "R")
        out += due() if letter == "R" else role
    return cost if re.fullmatch("(s?(ua)+)?", out) else None


def test_repair_of_the_given_table_and_odd_tables(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in given.collect()]
    assert got(queries.op11_conversation_repair(spark, sf_dir)) == repaired(rows)
    none = conversations.repaired(conversations.damaged(frame(spark, [])))
    assert none.columns[0] == "conv_id" and none.isEmpty()
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    rows = [(dropped, 0, "user", "x."), (5000, None, None, None), (5001, 0, "assistant", "y " * 500_000)]
    assert got(conversations.repaired(conversations.damaged(frame(spark, rows)))) == repaired(rows)
    assert repaired(rows)[dropped] == (0, 0, 0, 0, 0, 0, "", empty)


# --- alignment -----------------------------------------------------------------------------


def by_ranges(texts):
    """Every overlap of byte ranges, token by token."""
    one = Tokenizer.from_file(queries.VOCABULARY)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    a_side, b_side = alignment.byte_level(queries.VOCABULARY), alignment.pieces(queries.PIECES)
    found, counts = [], Counter()
    for text in texts:
        text = text or ""
        a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
        whole = (" " + text).encode()
        if not text or b"".join(a_side.token[x] for x in a) != whole or b"".join(b_side.token[x] for x in b) != whole:
            a, b = [], []
        edges = [list(itertools.accumulate((len(side.token[x]) for x in ids), initial=0)) for side, ids in ((a_side, a), (b_side, b))]
        links = [
            (x, y) for x in range(len(a)) for y in range(len(b))
            if max(edges[0][x], edges[1][y]) < min(edges[0][x + 1], edges[1][y + 1])
        ]
        cuts = sorted(set(edges[0]) & set(edges[1]))
        groups = []
        for low, high in zip(cuts, cuts[1:]):
            parts = [",".join(str(x) for x, e in zip(ids, edge) if low <= e < high) for ids, edge in ((a, edges[0]), (b, edges[1]))]
            groups.append("|".join(parts))
        counts.update((a[x], b[y]) for x, y in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        found.append((len(a), len(b), len(groups), [(a[x], b[y]) for x, y in links], digest))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (n_a, n_b, groups, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for n_a, n_b, groups, links, digest in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_ranges(spark, docs, nothing, sf_dir):
    given = table(spark, sf_dir, "documents").orderBy(F.length("text")).limit(60).select("doc_id", "text")
    every = docs.where("doc_id <> 14 OR doc_id IS NULL").select("doc_id", "text").union(given.withColumn("doc_id", F.col("doc_id") + 10**6))
    every = every.cache()
    rows = every.collect()
    expected = Counter((r["doc_id"], *x) for r, x in zip(rows, by_ranges([r["text"] for r in rows])))
    result = alignment.aligned(every.withColumn("lot", F.lit("clash")), "doc_id", queries.VOCABULARY, queries.PIECES)
    assert Counter(tuple(r) for r in result.select("doc_id", *COLUMNS).collect()) == expected
    by_id = {r["doc_id"]: r for r in result.collect()}
    for i in (1, 2, 10):  # null, empty, bytes that don't come back
        assert tuple(by_id[i][c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "")
    assert alignment.aligned(nothing, "doc_id", queries.VOCABULARY, queries.PIECES).isEmpty()


def test_lots_and_lanes_change_nothing(spark, docs, monkeypatch):
    random_ = np.random.default_rng(3)
    for _ in range(50):
        sizes = [random_.integers(1, 5, n) for n in random_.integers(1, 400, 6)]
        others = []
        for x in sizes:  # other cuts of the same bytes
            inside = np.sort(random_.choice(np.arange(1, x.sum()), min(x.sum() - 1, int(random_.integers(0, 300))), replace=False))
            others.append(np.diff([0, *inside, x.sum()]))
        a, b = np.cumsum(np.concatenate(sizes)), np.cumsum(np.concatenate(others))
        first = [np.cumsum([0, *map(len, x)]) for x in (sizes, others)]
        plain_, cut = (alignment.lockstep(a, b, alignment.lanes(a, b, *first, n)) for n in (10**9, 7))
        assert all((x == y).all() for x, y in zip((plain_.a, plain_.b, plain_.cut), (cut.a, cut.b, cut.cut)))
    side = alignment.byte_level(queries.VOCABULARY), alignment.pieces(queries.PIECES)
    texts = [(r["text"] or "").encode() for r in docs.collect()]
    together, apart = alignment.aligned_lot(texts, *side), [alignment.aligned_lot([t], *side) for t in texts]
    for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
        assert list(together[name]) == [x[name][0] for x in apart]
    long = alignment.aligned_lot([b"x" + b" " * 10**6 + b"y", b"\n" * 10**6, b"a" * 10**6], *side)
    assert (long["n_a"] > 0).all() and (long["n_links"] >= np.maximum(long["n_a"], long["n_b"])).all()
