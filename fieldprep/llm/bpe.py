"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

Words are counted over all documents by lossy counting: every partition keeps a bounded table, drops
its rarest words with their counts when the table is full and hands on its most frequent ones, so
counts are lower bounds, and a word that is rare in every partition may be missed. The most
frequent ones are merged once, compiled with their ids into a minimal acyclic transducer, and
the transducer is memory-mapped in every Python worker. Words that it does not hold are merged
there, many at once, by the rule of the vocabulary: the pair of lowest rank first. So the lexicon
decides the speed and never the ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from fieldprep.llm.batches import steps, texts
from fieldprep.llm.lexicon import Lexicon, compile_lexicon

#: Words of the lexicon; what a partition's table holds at most and hands on.
LEXICON_WORDS, COUNTED, HANDED_ON = 50_000, 200_000, 20_000
#: Merged words that a worker remembers, of this many bytes at most.
REMEMBERED, REMEMBERED_BYTES = 150_000, 64
#: A longer word is merged alone, by a heap.
LONG_WORD = 256

# Fixed values of the byte-level format: how texts are split, and the order in which the bytes
# that are no visible characters get characters of their own.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Code points whose classes do not differ between Unicode versions in use; texts with others are
#: split by the tokenizer library itself, whose tables decide.
SETTLED = r"\x00-՗‐-⁤₠-₿ぁ-ゖ゠-ヿ一-鿯가-힣\U0001f300-\U0001f64f"

_EMPTY = np.int64(-1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _byte_chars() -> dict[str, int]:
    hidden = [b for b in range(256) if b not in VISIBLE]
    return {chr(b): b for b in VISIBLE} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """What a byte-level tokenizer file says: ids of bytes, ranks of merges, bytes of ids, whole tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, chars = stated["model"], _byte_chars()
        if model["type"] != "BPE" or stated["normalizer"] or stated["pre_tokenizer"]["type"] != "ByteLevel" or stated["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE file")
        vocab = model["vocab"]
        whole = {t["content"]: t["id"] for t in stated["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in stated["added_tokens"]):
            raise ValueError("tokens that take in blanks are not supported")
        self.whole = whole
        self.token_bytes = [b""] * (max([*vocab.values(), *whole.values()]) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(chars[c] for c in token)
        for token, i in whole.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for char, b in chars.items():
            self.byte_id[b] = vocab[char]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array([vocab[x] for x in col], np.int64) for col in zip(*((a, b, a + b) for a, b in merges), strict=True))
        # An open-addressed table from a pair of ids to its rank.
        self.made, size = made, 1 << 18
        self.keys, self.ranks, self.probes = np.full(size, _EMPTY), np.zeros(size, np.int64), 1
        for rank, key in reversed(list(enumerate((left << 32 | right).tolist()))):
            at, probe = key * int(_MIX) % 2**64 >> 46, 1
            while self.keys[at] not in (_EMPTY, key):
                at, probe = (at + 1) % size, probe + 1
            self.keys[at], self.ranks[at], self.probes = key, rank, max(self.probes, probe)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of merges where it is none."""
        key = left << 32 | right
        at = ((key.astype(np.uint64) * _MIX) >> np.uint64(46)).astype(np.int64)
        ranks = np.full(len(key), len(self.made), np.int64)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            slot = self.keys[at]
            hit = slot == key[open_]
            ranks[open_[hit]] = self.ranks[at[hit]]
            more = ~hit & (slot != _EMPTY)
            open_, at = open_[more], (at[more] + 1) % len(self.keys)
            if not len(open_):
                break
        return ranks


def merge_words(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The ids of each word as little-endian 32-bit numbers, many words advanced together."""
    none = len(vocabulary.made)
    symbols = vocabulary.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    ids: list[bytes] = [b""] * len(words)

    def give(symbols: np.ndarray, owner: np.ndarray) -> None:
        if len(owner):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            data, ends = symbols.astype("<u4").tobytes(), np.append(starts[1:], len(owner))
            for word, a, b in zip(owner[starts].tolist(), (4 * starts).tolist(), (4 * ends).tolist(), strict=True):
                ids[word] = data[a:b]

    ranks = np.append(vocabulary.rank(symbols[:-1], symbols[1:]), none) if len(symbols) else symbols
    ranks[np.flatnonzero(np.diff(owner)) if len(owner) else []] = none
    while len(symbols):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        least = np.minimum.reduceat(ranks, starts)
        sizes = np.diff(np.append(starts, len(owner)))
        finished = np.repeat(least == none, sizes)
        if finished.any():
            give(symbols[finished], owner[finished])
            symbols, owner, ranks = symbols[~finished], owner[~finished], ranks[~finished]
            sizes, least = sizes[least < none], least[least < none]
            if not len(symbols):
                break
        chosen = ranks == np.repeat(least, sizes)
        at = np.flatnonzero(chosen)
        # Of pairs that overlap in a row, every second one is merged, from the left.
        run = np.cumsum(np.diff(at, prepend=-2) != 1) - 1
        run_start = np.flatnonzero(np.diff(run, prepend=-1))
        at = at[(np.arange(len(at)) - run_start[run]) % 2 == 0]
        symbols[at] = vocabulary.made[ranks[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        ranks[at] = ranks[at + 1]
        symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
        new = at - np.arange(len(at))  # where the merged symbols are now
        for left in (new, new[new > 0] - 1):
            left = left[left + 1 < len(symbols)]
            left = left[owner[left] == owner[left + 1]]
            ranks[left] = vocabulary.rank(symbols[left], symbols[left + 1])
    return ids


def merge_long(word: bytes, vocabulary: Vocabulary) -> bytes:
    """The ids of one word by a heap of pairs, for words of any length."""
    symbols = vocabulary.byte_id[np.frombuffer(word, np.uint8)].tolist()
    n, none = len(symbols), len(vocabulary.made)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    first = vocabulary.rank(np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64)).tolist()
    heap = [(r, i, symbols[i], symbols[i + 1]) for i, r in enumerate(first) if r < none]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j < 0 or symbols[i] != a or symbols[j] != b:
            continue
        symbols[i], symbols[j], after[i] = int(vocabulary.made[rank]), -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0:
                r = int(vocabulary.rank(np.array([symbols[x]]), np.array([symbols[y]]))[0])
                if r < none:
                    heapq.heappush(heap, (r, x, symbols[x], symbols[y]))
    return np.array([s for s in symbols if s >= 0], "<u4").tobytes()


class Splitter:
    """Splits a text into words, whole tokens apart."""

    def __init__(self, whole: dict[str, int]):
        self.words, self.unsettled = regex.compile(SPLIT), regex.compile(f"[^{SETTLED}]")
        self.whole = regex.compile("(" + "|".join(sorted(map(regex.escape, whole), key=len, reverse=True)) + ")") if whole else None
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def _plain(self, text: str) -> list[str]:
        if self.unsettled.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.words.findall(text)

    def __call__(self, text: str) -> list[str]:
        if self.whole is None or not self.whole.search(text):
            return self._plain(text)
        parts = self.whole.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._plain(part)) if w]


class Encoder:
    """Encodes texts: the lexicon first, merging for the words it lacks."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon, self.split = vocabulary, lexicon, Splitter(vocabulary.whole)
        self.fixed = {token: np.array([i], "<u4").tobytes() for token, i in vocabulary.whole.items()}
        self.remembered: dict[str, bytes] = dict(self.fixed)

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words that are not remembered."""
        coded = [w.encode("utf-8", "replace") for w in words]
        places = self.lexicon.find(coded).tolist()
        ids = [self.lexicon.ids_of(p) if p >= 0 else None for p in places]
        rest = [i for i, x in enumerate(ids) if x is None]
        short = [i for i in rest if len(coded[i]) <= LONG_WORD]
        for i, found in zip(short, merge_words([coded[i] for i in short], self.vocabulary), strict=True):
            ids[i] = found
        for i in rest:
            if len(coded[i]) > LONG_WORD:
                ids[i] = merge_long(coded[i], self.vocabulary)
        return dict(zip(words, ids, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        out: list[bytes] = []
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > 1 << 20:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        words = [self.split(t) for t in texts]
        new = set().union(*words).difference(self.remembered)
        if len(self.remembered) + len(new) > REMEMBERED:
            self.remembered = dict(self.fixed)
            new = set().union(*words).difference(self.fixed)
        found = self._learn(list(new))
        self.remembered.update(found)
        out = [b"".join(map(self.remembered.__getitem__, ws)) for ws in words]
        for word in found:
            if len(word) > REMEMBERED_BYTES:
                del self.remembered[word]
        return out


def decode(ids: bytes, token_bytes: list[bytes]) -> str:
    """The text of some ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def count_words(docs: DataFrame, vocabulary: Vocabulary, counted: int = COUNTED, handed_on: int = HANDED_ON) -> DataFrame:
    """(word, n): the frequent words of all texts; a count lacks at most what a partition dropped."""
    whole = vocabulary.whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = Splitter(whole), Counter()
        for batch in steps(batches):
            for text in texts(batch):
                counts.update(split(text))
                if len(counts) > counted:
                    floor = sorted(counts.values())[len(counts) // 2]
                    counts = Counter({w: n for w, n in counts.items() if n > floor})
        top = [(w, n) for w, n in counts.most_common(handed_on) if w not in whole and len(w) <= REMEMBERED_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, words: int = LEXICON_WORDS) -> Lexicon:
    """The transducer of the ``words`` most frequent words of ``docs``."""
    top = [r["word"].encode() for r in count_words(docs, vocabulary).orderBy(F.desc("n"), "word").limit(words).collect()]
    ids = merge_words(top, vocabulary)
    return compile_lexicon({w: np.frombuffer(x, "<u4").tolist() for w, x in zip(top, ids, strict=True)})


_ENCODERS: dict[str, Encoder] = {}


def _encoding(docs: DataFrame, path: str, words: int):
    """A function that gives a worker its encoder, made once per worker and content of vocabulary and lexicon."""
    vocabulary = Vocabulary(path)
    lexicon = build_lexicon(docs, vocabulary, words).to_bytes()
    # Both have fixed bounds: the vocabulary file, and the lexicon's number of words.
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, lexicon))
    with open(path, "rb") as file:
        name = hashlib.blake2b(lexicon, key=hashlib.blake2b(file.read()).digest()).hexdigest()

    def encoder() -> Encoder:
        if name not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[name] = Encoder(shared.value[0], Lexicon.mapped(shared.value[1]))
        return _ENCODERS[name]

    return encoder


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))


def encode_documents(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id and ids (little-endian 32-bit numbers in a binary column) of every row of ``docs``.

    ``path`` is a byte-level BPE file of the tokenizers library, read on the driver. Strings of its
    whole tokens are encoded as these tokens. A NULL text is the empty one, which has no ids. Rows
    that repeat, or have no doc_id, are encoded like any other. Other columns are not read.
    """
    encoder = _encoding(docs, path, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            ids = pa.array(encoder().encode(texts(batch)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text that the ids stand for; NULL ids are no ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(path).token_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            text = pa.array([decode(x, shared.value) for x in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary, text string")


def round_trip(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256: both ways in one pass, the decoded text only as its hash."""
    encoder = _encoding(docs, path, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            ids, pieces = encoder().encode(texts(batch)), encoder().vocabulary.token_bytes
            hashes = [hashlib.sha256(decode(x, pieces).encode("utf-8", "replace")).hexdigest() for x in ids]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            columns = [batch.column(0), counts, pa.array(ids, pa.binary()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded_sha256 string")
