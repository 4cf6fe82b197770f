"""A minimal acyclic transducer from words to numbers, laid out for a memory map.

Words come in sorted order; the suffixes that earlier words share are kept once, so the automaton
is the smallest that accepts exactly these words. An edge carries the number of words that go
through smaller edges of its state, so the sum along a word's path, with one for each word that ends
on the way, is the place of the word among all words.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np


class Lexicon:
    """The automaton of some words and the ids each word stands for.

    ``edges`` holds state * 256 + byte in order; ``target``, ``output`` belong to it; ``final`` to states.
    The ids of word n are ``ids[at[n]:at[n + 1]]``.
    """

    FIELDS = (("edges", "<i8"), ("target", "<i4"), ("output", "<i4"), ("final", "<i4"), ("at", "<i8"), ("ids", "<u4"))

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.edges, self.target, self.output, self.final, self.at, self.ids = (arrays[n] for n, _ in self.FIELDS)
        self.words = len(self.at) - 1

    def to_bytes(self) -> bytes:
        parts = [np.asarray(getattr(self, n), dtype=t).tobytes() for n, t in self.FIELDS]
        sizes = np.array([len(p) for p in parts], "<i8").tobytes()
        return sizes + b"".join(p + b"\0" * (-len(p) % 8) for p in parts)

    @classmethod
    def mapped(cls, blob: bytes) -> Lexicon:
        """The lexicon as a memory map of a file that is already unlinked, so nothing is left behind."""
        with tempfile.TemporaryFile() as file:
            file.write(blob)
            file.flush()
            view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at, arrays = 8 * len(cls.FIELDS), {}
        for (name, kind), size in zip(cls.FIELDS, np.frombuffer(view, "<i8", len(cls.FIELDS)).tolist(), strict=True):
            arrays[name] = np.frombuffer(view, kind, size // np.dtype(kind).itemsize, at)
            at += size + -size % 8
        return cls(arrays)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word; -1 for a word that is not in the lexicon."""
        found = np.full(len(words), -1, dtype=np.int64)
        if not len(self.edges):
            return found
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        open_, state, total, depth = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        while len(open_):
            done = sizes[open_] == depth
            if done.any():
                hit = self.final[state[done]] > 0
                found[open_[done][hit]] = total[done][hit]
                open_, state, total = open_[~done], state[~done], total[~done]
                if not len(open_):
                    break
            key = state * 256 + data[starts[open_] + depth]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            ok = self.edges[edge] == key
            total = (total + self.final[state] + self.output[edge])[ok]
            open_, state, depth = open_[ok], self.target[edge[ok]].astype(np.int64), depth + 1
        return found

    def ids_of(self, place: int) -> bytes:
        return self.ids[self.at[place] : self.at[place + 1]].tobytes()


def compile_lexicon(entries: dict[bytes, list[int]]) -> Lexicon:
    """The lexicon of words with their ids."""
    words = sorted(w for w in entries if w)
    known: dict[tuple, int] = {}
    nodes: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, {}]]

    def keep(node: list) -> int:
        """The number of the finished state that equals this one."""
        shape = (node[0], tuple(node[1].items()))
        if shape not in known:
            known[shape] = len(nodes)
            nodes.append(shape)
        return known[shape]

    def finish(word: bytes, depth: int) -> None:
        """States below ``depth`` on the path of ``word`` get no further edges."""
        while len(path) - 1 > depth:
            node = path.pop()
            path[-1][1][word[len(path) - 1]] = keep(node)

    last = b""
    for word in words:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        finish(last, same)
        path.extend([False, {}] for _ in word[same:])
        path[-1][0] = True
        last = word
    finish(last, 0)
    root = keep(path[0])
    # The root becomes state 0; a state's targets were finished before it, so words are counted in order.
    number = {root: 0} | {old: i + 1 for i, old in enumerate(x for x in range(len(nodes)) if x != root)}
    below, rows = {}, []
    for old, (final, edges) in enumerate(nodes):
        count = 0
        for byte, target in edges:
            rows.append((number[old] * 256 + byte, number[target], count))
            count += below[target]
        below[old] = count + final
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    finals = np.zeros(len(nodes), np.int32)
    finals[[number[old] for old, (final, _) in enumerate(nodes) if final]] = 1
    ids = [entries[w] for w in words]
    at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    flat = np.array([i for x in ids for i in x], dtype=np.uint32)
    return Lexicon({"edges": table[:, 0], "target": table[:, 1], "output": table[:, 2], "final": finals, "at": at, "ids": flat})
