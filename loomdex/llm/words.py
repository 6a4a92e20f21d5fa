"""Words of a block of texts as hash codes, and shingles of words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.llm.common import Rolling, U, byte_codes, mix, word_spans

#: Letters, digits and every byte of other characters.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
#: All but white space.
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SHINGLE = 5
#: Bits of a shingle's code; the rest of 64 numbers the text within its block.
CODE = 44


def hashed_words(data: np.ndarray, at: np.ndarray, inside: np.ndarray = WORD, fold: bool = True):
    """Hash, start and end of each word, and each text's first word (one more entry than texts)."""
    start, end, first = word_spans(data, at[1:], inside)
    roll = Rolling(byte_codes(FOLD[data] if fold else data))
    return roll.spans(start, end), start, end, first


def shingles(words: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text: text, code, how often; and a hash of each whole text.

    A text with fewer than k words has one shingle of all of them; one without words has none.
    """
    n = np.diff(first)
    roll = Rolling(words)
    count = np.where(n > 0, np.maximum(n - k + 1, 1), 0)
    text = np.repeat(np.arange(len(n)), count)
    begin = first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    code = roll.spans(begin, np.minimum(begin + k, first[1:][text]))
    both = np.sort((text.astype(U) << U(CODE)) | (code >> U(64 - CODE)))
    head = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
    often = np.diff(np.r_[head, len(both)])
    both = both[head]
    whole = mix(roll.spans(first[:-1], first[1:]) + n.astype(U))
    return (both >> U(CODE)).astype(np.int64), both & U((1 << CODE) - 1), often, whole


def same_row() -> list[Column]:
    """Key that equal rows share (a null id has a key of its own)."""
    return [F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.xxhash64("text").alias("mark")]
