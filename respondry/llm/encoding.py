"""Ids of a byte-level vocabulary at the speed of a compiled encoder, for texts of any kind.

The compiled encoder backtracks over white space and gives up on very long runs of it, so a text with
such a run is encoded by :mod:`respondry.llm.bpe`; both give the ids of the vocabulary's own library.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import tiktoken

from respondry.llm import bpe

#: White space in a run that the compiled encoder is not given.
LONG_RUN = re.compile(r"\s{5000}")


@cache
def encoder(path: str) -> tiktoken.Encoding:
    """A fast encoder with the file's vocabulary; its ids must rise with the rank of their merge."""
    vocab = bpe.vocabulary(path)
    merged = [code & bpe.ID_MASK for code in sorted(vocab.merges.values())]
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids don't follow the order of merges")
    ranks = {token: i for i, token in vocab.tokens.items() if i not in vocab.special.values()}
    return tiktoken.Encoding("packing", pat_str=bpe.PATTERN.pattern, mergeable_ranks=ranks, special_tokens=vocab.special)


@cache
def without_special(path: str) -> bpe.Vocabulary:
    """The vocabulary for which the strings of special tokens are plain text."""
    vocab = bpe.vocabulary(path)
    return bpe.Vocabulary(vocab.tokens, vocab.bytes_to_id, vocab.merges, {}, vocab.never)


def ids(path: str, text: str, special: bool = True) -> np.ndarray:
    """Ids of a text; the strings of special tokens are these tokens, or plain text."""
    if LONG_RUN.search(text):
        vocab = bpe.vocabulary(path) if special else without_special(path)
        return np.frombuffer(bpe.encode(vocab, text, {}), "<u4")
    encoding = encoder(path)
    return encoding.encode_to_numpy(text, allowed_special="all" if special else set(), disallowed_special=())
