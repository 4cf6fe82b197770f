"""Secrets by fixed patterns, and by probabilistic automata inferred from what the patterns found.

The values that the patterns label are samples of credential formats. Their prefix tree is folded
into a probabilistic automaton per kind: a state holds how often each character class, or the end,
came next; letters and digits lead on by their place, so that formats of few samples keep their
lengths, and other characters by themselves. States are taken in breadth first order, and a state is
merged into an accepted one if the frequencies of both, and of all their common successors, agree
within Hoeffding's bound. Any token is then scored by its log likelihood per character under each
automaton against a bigram model of ordinary tokens. Tokens that gain as much by it as all but the
least typical of the kind's values that were kept aside are added; pattern matches stay, and a token
that they cover in part is scored as a whole.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.batches import steps
from fieldprep.llm.store import cut

KINDS = ("assign", "access", "hex", "format")
#: Labelled values of a kind that an automaton is inferred from, ordinary tokens for the background.
VALUES, ORDINARY = 600, 4000
#: Fewest labelled values of a kind, lengths that are learnt from (tokens of any length are scored).
LEAST_VALUES, LENGTHS = 8, (12, 128)
#: Confidence of the merge test, fewest times that a state was seen to be tested; one value in this many is kept
#: aside, of which this share may score below the threshold.
ALPHA, SEEN, ASIDE, BELOW = 0.05, 8, 4, 0.05
#: The least gain in log likelihood per character that makes a token a credential.
LEAST_GAIN = 0.25
#: Log likelihood of a bigram that follows a class which ordinary tokens never have.
UNSEEN = math.log(1e-4)

# The base patterns.
WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, so the same as runs of which the short ones are dropped
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")

#: Classes of characters and how many characters each has.
SIZES = {"d": 10, "h": 6, "l": 20, "H": 6, "U": 20}
_CLASS = {c: "d" for c in "0123456789"} | {c: "h" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
_CLASS |= {c: "H" for c in "ABCDEF"} | {c: "U" for c in "GHIJKLMNOPQRSTUVWXYZ"} | {c: c for c in "+/_.=-"}
_TABLE = str.maketrans(_CLASS)
#: How many classes there are; what ends a token.
CLASSES, END = len(set(_CLASS.values())), "$"


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base patterns, in order of start and kind."""
    found = []
    lowered = text.lower() if text else ""
    if any(w in lowered for w in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, token, whether a base match touches it) of tokens that do not lie in one base match."""
    at = 0
    for m in TOKEN.finditer(text):
        while at < len(taken) and taken[at][2] <= m.start():
            at += 1
        ahead = itertools.takewhile(lambda x: x[0] < m.end(), itertools.islice(taken, at, None))
        touching = [(start, end) for start, _, end, _ in ahead if end > m.start()]
        if not any(start <= m.start() and end >= m.end() for start, end in touching):
            yield m.start(), m.end(), m[0], bool(touching)


class Automaton:
    """States of which each has seen some classes and ends, and the state that follows each ``move``.

    What a state has not seen shares as much likelihood as it has seen different things (Witten and
    Bell's estimate), so the rarer a state, the more it allows; the state then stays.
    """

    def __init__(self, seen: list[Counter], moves: list[dict[str, int]]):
        self.moves, self.logs, self.unseen = moves, [], []
        for counts in seen:
            n, kinds = sum(counts.values()), len(counts)
            self.logs.append({c: math.log(k / (n + kinds)) for c, k in counts.items()})
            self.unseen.append(math.log(kinds / (n + kinds) / max(1, CLASSES + 1 - kinds)))

    def score(self, shape: str) -> float:
        total, state = 0.0, 0
        for c in shape:
            total += self.logs[state].get(c, self.unseen[state]) - math.log(SIZES.get(c, 1))
            state = self.moves[state].get(_move(c), state)
        return total + self.logs[state].get(END, self.unseen[state])


def _move(c: str) -> str:
    """What a class leads on by: letters and digits by their place alone, other characters by themselves."""
    return "a" if c in SIZES else c


def _agree(a: int, n: int, b: int, m: int) -> bool:
    return abs(a / n - b / m) < math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def infer(values: list[str]) -> Automaton:
    """The automaton of some values, by merging compatible states of their prefix tree.

    States that were seen fewer than ``SEEN`` times prove nothing, as the bound exceeds every
    difference there: each joins the accepted state that makes what follows it likeliest.
    """
    seen, nexts = [Counter()], [{}]
    for value in sorted(values):
        node = 0
        for c in value.translate(_TABLE):
            seen[node][c] += 1
            if (move := _move(c)) not in nexts[node]:
                nexts[node][move] = len(seen)
                seen.append(Counter()), nexts.append({})
            node = nexts[node][move]
        seen[node][END] += 1

    def compatible(a: int, b: int) -> bool:
        open_ = [(a, b)]
        while open_:
            a, b = open_.pop()
            n, m = seen[a].total(), seen[b].total()
            if not all(_agree(seen[a][c], n, seen[b][c], m) for c in seen[a].keys() | seen[b].keys()):
                return False
            open_ += [(nexts[a][c], nexts[b][c]) for c in nexts[a].keys() & nexts[b].keys()]
        return True

    def likelihood(a: int, b: int) -> float:
        """Of what state b has seen, under state a."""
        n, kinds = seen[a].total(), len(seen[a])
        return sum(k * math.log((seen[a][c] or kinds / (CLASSES + 1)) / (n + kinds)) for c, k in seen[b].items())

    def fold(a: int, b: int) -> None:
        """The subtree at b into state a."""
        open_ = [(a, b)]
        while open_:
            a, b = open_.pop()
            if a == b:
                continue
            seen[a] += seen[b]
            for c, child in nexts[b].items():
                if c in nexts[a]:
                    open_.append((nexts[a][c], child))
                else:
                    nexts[a][c] = child

    accepted, waiting = [0], [(0, c) for c in sorted(nexts[0])]
    while waiting:
        parent, c = waiting.pop(0)
        state = nexts[parent][c]
        if state in accepted:
            continue
        if seen[state].total() < SEEN:
            like = max(accepted, key=lambda a: likelihood(a, state))
        else:
            like = next((a for a in accepted if seen[a].total() >= SEEN and compatible(a, state)), None)
        if like is None:
            accepted.append(state)
            waiting += [(state, x) for x in sorted(nexts[state])]
        else:
            nexts[parent][c] = like
            fold(like, state)
            # Folding may have given accepted states new branches.
            waiting += [(a, x) for a in accepted for x in sorted(nexts[a]) if nexts[a][x] not in accepted and (a, x) not in waiting]
    number = {state: i for i, state in enumerate(accepted)}
    return Automaton([seen[s] for s in accepted], [{c: number[t] for c, t in nexts[s].items()} for s in accepted])


@dataclass
class Model:
    """Automata with the least gain that each asks for, and the bigrams of ordinary tokens."""

    automata: list[Automaton] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    background: dict[str, float] = field(default_factory=dict)

    def ordinary(self, shape: str) -> float:
        """Log likelihood under the bigrams; one that was not seen counts as one seen once."""
        pairs = zip("^" + shape, shape + "$", strict=True)
        return sum(self.background.get(a + b, self.background.get(a, UNSEEN / 2)) - math.log(SIZES.get(b, 1)) for a, b in pairs)

    def gains(self, token: str) -> list[float]:
        """How much better per character each automaton explains a token than the background does."""
        shape = token.translate(_TABLE)
        ordinary = self.ordinary(shape)
        return [(a.score(shape) - ordinary) / len(shape) for a in self.automata]

    def is_secret(self, token: str) -> bool:
        return any(g >= t for g, t in zip(self.gains(token), self.thresholds, strict=True))

    def spans(self, text: str) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, int, str]]]:
        """Base matches, and the added ones."""
        base = base_matches(text)
        if not self.automata:
            return base, []
        return base, [(a, 3, b, t) for a, b, t, _ in candidates(text, base) if self.is_secret(t)]


def fit(values: dict[str, list[str]], ordinary: list[str]) -> Model:
    """An automaton per kind with enough values; none without ordinary tokens to compare with.

    Each ``ASIDE``-th value of a kind is kept aside: the automaton has not seen it, and all of these
    but the least typical set the gain that the kind asks for.
    """
    known = [values[k] for k in KINDS[:3] if len(values.get(k, [])) >= LEAST_VALUES]
    if not known or not ordinary:
        return Model()
    pairs, first = Counter(), Counter()
    for shape in (t.translate(_TABLE) for t in ordinary):
        for a, b in zip("^" + shape, shape + "$", strict=True):
            pairs[a + b] += 1
            first[a] += 1
    background = {p: math.log((n + 1) / (first[p[0]] + CLASSES + 1)) for p, n in pairs.items()}
    background |= {a: -math.log(n + CLASSES + 1) for a, n in first.items()}
    model = Model([infer([v for i, v in enumerate(vs) if i % ASIDE]) for vs in known], [], background)
    for i, vs in enumerate(known):
        gains = [model.gains(v)[i] for v in vs[::ASIDE]]
        model.thresholds.append(max(LEAST_GAIN, float(np.quantile(gains, BELOW, method="lower"))))
    return model


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def rank(value: str) -> int:
    """Where a value stands in the order that samples are taken in: 63 bits of its hash."""
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest()) >> 1


class Smallest:
    """The ``size`` distinct values of smallest rank among all that were added."""

    def __init__(self, size: int):
        self.size, self.ranks, self.bound = size, {}, 1 << 63

    def add(self, value: str) -> None:
        if value not in self.ranks and (r := rank(value)) <= self.bound:
            self.ranks[value] = r
            if len(self.ranks) >= 2 * self.size:
                self.ranks = dict(self.items())
                self.bound = max(self.ranks.values())

    def items(self) -> list[tuple[str, int]]:
        return sorted(self.ranks.items(), key=lambda x: (x[1], x[0]))[: self.size]


def samples(docs: DataFrame) -> dict[str, list[str]]:
    """Of each kind the ``VALUES`` distinct values of smallest rank in all texts, of "" ``ORDINARY`` unmatched tokens.

    A task hands on its own smallest values; the smallest of all are among these however rows are dealt.
    """
    sizes = {"": ORDINARY} | dict.fromkeys(KINDS[:3], VALUES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {k: Smallest(n) for k, n in sizes.items()}
        for batch in steps(batches):
            for text in batch.column(1).to_pylist():
                base = base_matches(text)
                for _, k, _, v in base:
                    if LENGTHS[0] <= len(v) <= LENGTHS[1]:
                        least[KINDS[k]].add(v)
                for _, _, t, touched in candidates(text, base):
                    if not touched and len(t) <= LENGTHS[1]:
                        least[""].add(t)
        rows = [(k, v, r) for k, kept in least.items() for v, r in kept.items()]
        kinds, values, ranks = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(ranks, pa.int64())], names=["kind", "value", "rank"])

    found = cut(_texts(docs).mapInArrow(run, "kind string, value string, rank bigint").distinct())
    picks = {k: found.filter(F.col("kind") == k).orderBy("rank", "value").limit(n).collect() for k, n in sizes.items()}
    return {k: [r["value"] for r in rows] for k, rows in picks.items()}


def fit_on(docs: DataFrame) -> Model:
    """A model from the values that the base patterns find in ``docs`` and the tokens that none matches, as ``samples`` picks them."""
    values = samples(docs)
    return fit(values, values[""])


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_format, base, spans of every row of ``docs``.

    ``base`` and ``spans`` list kind:start:end in code points, by start and then kind; ``base`` has the
    patterns' matches, ``spans`` also the added ones. A NULL text is the empty one. Rows that repeat,
    or have no doc_id, are searched like any other. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    names = ["n_assign", "n_access", "n_hex", "n_format", "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def said(found):
            return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in found)

        for batch in steps(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = shared.value.spans(text)
                n = Counter(k for _, k, _, _ in base)
                rows.append((n[0], n[1], n[2], len(added), said(base), said(sorted(base + added))))
            columns = [pa.array(c, pa.string() if isinstance(c[0], str) else pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_format bigint, base string, spans string"
    return _texts(docs).mapInArrow(run, schema)
