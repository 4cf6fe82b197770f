"""Hashed character n-grams of words, computed for many texts at once with numpy."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

#: Lengths of the character n-grams, a word's two borders counting as characters.
SIZES = (3, 4, 5)
#: Characters handled at once; a longer text is cut between words and its parts are put together.
BLOCK = 1 << 19

_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


@cache
def _word_chars() -> np.ndarray:
    """Which code points belong to words: letters, marks and numbers; all beyond the first plane."""
    table = np.ones(0x110000, dtype=bool)
    table[:0x10000] = [unicodedata.category(chr(c))[0] in "LMN" for c in range(0x10000)]
    return table


def pieces(texts: Iterable[str | None]) -> Iterator[tuple[int, str]]:
    """(number of the text, part of it in lower case), cut at a blank where a text exceeds a block."""
    for number, text in enumerate(texts):
        text, at = text or "", 0
        while len(text) - at > BLOCK:
            end = max(text.rfind(" ", at, at + BLOCK), text.rfind("\n", at, at + BLOCK))
            end = at + BLOCK if end <= at else end
            yield number, text[at:end].lower()
            at = end
        yield number, text[at:].lower()


def blocks(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Parts of texts, together about a block long, with the numbers of their texts."""
    numbers, parts, size = [], [], 0
    for number, part in pieces(texts):
        if parts and size + len(part) > BLOCK:
            yield np.array(numbers), parts
            numbers, parts, size = [], [], 0
        numbers.append(number)
        parts.append(part)
        size += len(part) + 1
    if parts:
        yield np.array(numbers), parts


class Grams:
    """The n-grams of some parts: ``bucket`` and ``word`` of each; ``part`` of each word.

    With ``runs`` a word that equals the word before it is left out, so a run of one word counts once.
    """

    def __init__(self, parts: list[str], bits: int, runs: bool = False):
        whole = "\0" + "\0".join(parts) + "\0"
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = _word_chars()[codes]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        number = np.cumsum(begins) - 1
        border = np.cumsum(~inside)
        ends = np.cumsum([len(p) + 1 for p in parts])
        self.words = int(number[-1]) + 1
        self.part = np.searchsorted(ends, np.flatnonzero(begins) - 1, side="right")
        chars = np.where(inside, codes, 0).astype(np.uint64)
        rolled, buckets, words = chars, [], []
        for n in range(2, max(SIZES) + 1):
            rolled = rolled[:-1] * _STEP + chars[n - 1 :]
            if n not in SIZES or not len(rolled):
                continue
            last = len(codes) - n
            # All characters between the first and the last belong to one word.
            valid = np.flatnonzero((border[n - 2 : n - 1 + last] == border[1 : 2 + last]) & inside[1 : 2 + last])
            buckets.append((((rolled[valid] + np.uint64(n)) * _MIX) >> np.uint64(64 - bits)).astype(np.int32))
            words.append(number[valid + 1].astype(np.int32))
        self.bucket = np.concatenate(buckets) if buckets else np.empty(0, np.int32)
        self.word = np.concatenate(words) if words else np.empty(0, np.int32)
        if runs and self.words:
            name = np.bincount(self.word, weights=self.bucket, minlength=self.words)
            first = np.ones(self.words, dtype=bool)
            first[1:] = (name[1:] != name[:-1]) | (self.part[1:] != self.part[:-1])
            kept = first[self.word]
            self.bucket, self.word = self.bucket[kept], (np.cumsum(first) - 1)[self.word[kept]]
            self.part, self.words = self.part[first], int(first.sum())

    def word_means(self, value: np.ndarray) -> np.ndarray:
        """The mean of a value per bucket over the n-grams of each word; every word has one at least."""
        counts = np.bincount(self.word, minlength=self.words)
        return np.bincount(self.word, weights=value[self.bucket], minlength=self.words) / np.maximum(counts, 1)
