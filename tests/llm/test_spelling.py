import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldprep.llm import spelling

SCHEMA = "doc_id bigint, text string, n int, word string, root string"


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _words(rows, least=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 2}


def _brute(counts, ratio=10):
    near = {w: [v for v in counts if _one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def _found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)


def _texts(seed, size=60):
    draws = random.Random(seed)
    stems = ["".join(draws.choices("abcdé", k=draws.randint(6, 10))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "abababab"]
    rows = []
    for i in range(size):
        words = []
        for _ in range(60):
            w = draws.choice(stems[: 1 + draws.randint(0, len(stems) - 1)])
            if draws.random() < 0.25:
                at = draws.randrange(len(w))
                w = draws.choice([w[:at] + w[at + 1 :], w[:at] + draws.choice("abcdé") + w[at:], w[:at] + draws.choice("abcdé") + w[at + 1 :]])
            words.append(w.upper() if draws.random() < 0.1 else w)
        rows.append((i, draws.choice([" ", ", ", "-1-"]).join(words)))
    return rows


@pytest.mark.parametrize("unit", [spelling.UNIT, 20])
def test_equals_brute_force(spark, unit):
    chain = [(100 + i, "needles needles xeedles xeedles") for i in range(2)] + [(200 + i, "needled " * 20) for i in range(2)] + [(300 + i, "needlez " * 5) for i in range(1)]
    rows = _texts(1) + chain + [(400 + i, "beedled " * 300) for i in range(2)]
    expected = _brute(_words(rows))
    assert len(expected) > 150 and any(v[0] and v[0] != v[1] for v in expected.values())
    assert _found(spelling.variants(_frame(spark, rows).repartition(3), unit=unit)) == expected


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé", min_size=3, max_size=8), max_size=60), st.integers(0, 1))
def test_a_task_finds_all_pairs_once(words, across):
    words = sorted(words)
    read = words * 2
    counts = np.array([len(w) * 7 % 5 + 1 for w in read], np.int64)
    backward = np.array([False] * len(words) + [True] * len(words))
    blocks = np.array([across * (hash(w) % 2) for w in read], np.int64)
    near, best_n, best = spelling.near_words(read, counts, backward, blocks, 1)
    split = bool(blocks.any())
    for k, w in enumerate(words):
        others = [v for v in words if _one_edit(w, v) and (not split or blocks[words.index(v)] != blocks[k])]
        assert near[k] + near[k + len(words)] == len(others)
        top = [(-best_n[i], read[best[i]]) for i in (k, k + len(words)) if best[i] >= 0]
        assert min(top, default=None) == min(((-counts[words.index(v)], v) for v in others), default=None)


def test_the_acceptor_is_minimal_and_numbers_words():
    words = sorted(["walked", "walking", "walks", "talked", "talking", "talks", "", "w"])
    acceptor = spelling.Acceptor()
    start = acceptor.accept(words)
    assert acceptor.count[start] == len(words)
    for i, w in enumerate(words):
        state, base = acceptor.walk(start, w)
        assert acceptor.final[state] and base == i
    assert acceptor.walk(start, "t")[0] != acceptor.walk(start, "w")[0]
    assert acceptor.walk(start, "talk")[0] == acceptor.walk(start, "walk")[0]


def test_very_long_words(spark):
    long = "ab" * 20000
    rows = [(1, f"{long}x {long}x"), (2, f"{long} {long} c{long[1:]}x"), (3, f"c{long[1:]}x"), (4, "q" * 30000), (5, "q" * 30000)]
    expected = _words(rows)
    found = _found(spelling.variants(_frame(spark, rows)))
    assert {w: v[2] for w, v in found.items()} == expected
    for w, v in found.items():
        assert v[3] == sum(_one_edit(w, x) for x in expected if abs(len(x) - len(w)) < 2 and x != w)


def test_nulls_ties_repeats_and_empty_tables(spark):
    assert _found(spelling.variants(_frame(spark, []))) == {}
    assert _found(spelling.variants(_frame(spark, [(1, None), (None, ""), (2, "short words only 1234567")]))) == {}
    rows = [(None, "variant variant Àvariant"), (3, "variant " * 30), (3, "variant " * 30), (4, "varient varient vaariant vaariant"), (4, "Varient"), (5, "Àvariant àvariant àvariant")]
    rows += [(6, "bariants bariants cariants cariants dariants dariants")]
    assert _found(spelling.variants(_frame(spark, rows))) == _brute(_words(rows))
