import random

import numpy as np
import pytest
import xxhash

from fieldprep.llm import simhash as op
from fieldprep.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute(ids_and_prints):
    top = {i: i for i, _ in ids_and_prints}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, (i, a) in enumerate(ids_and_prints):
        for j, b in ids_and_prints[:n]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in ids_and_prints}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A b C d", "É a b c d e a b c d e", "w " * 70_000])
def test_fingerprint(text):
    assert op.fingerprint(text) == plain_fingerprint(text)


def planted(seed, n, clusters=()):
    """Random fingerprints, chains of four flipped bits, and dense groups around centres."""
    r = random.Random(seed)
    found = {r.getrandbits(64) for _ in range(n)} | {0, 2**64 - 1, 1, 15}
    for x in list(found)[: n // 4]:
        for _ in range(3):
            for b in r.sample(range(64), r.choice([1, 3, 4, 5])):
                x ^= 1 << b
            found.add(x)
    for size in clusters:
        centre = r.getrandbits(64)
        for _ in range(size):
            x = centre
            for b in r.sample(range(64), r.choice([0, 1, 2, 3, 5])):
                x ^= 1 << b
            found.add(x)
    return np.array(sorted(found), dtype=np.uint64)


@pytest.mark.parametrize("seed", range(4))
def test_subtrie_join_alone(seed):
    keys = planted(seed, 200, (150,))
    of = op.link_subtries(keys, 0, 0, 0)
    turned = np.sort((keys << np.uint64(32)) | (keys >> np.uint64(32)))
    other = op.link_subtries(turned, 0, 0, 0)
    # Links of both tries together are all links.
    names = [int(k) for k in keys]
    back = {int((k << np.uint64(32)) | (k >> np.uint64(32))): i for i, k in enumerate(turned)}
    want = brute([(i, k) for i, k in enumerate(names)])
    groups = {i: i for i in range(len(names))}

    def find(x):
        while groups[x] != x:
            x = groups[x]
        return x

    at = {k: i for i, k in enumerate(names)}
    pairs = [(i, int(of[i])) for i in range(len(names))]
    turned_names = {i: at[k] for k, i in back.items()}
    pairs += [(turned_names[i], turned_names[int(other[i])]) for i in range(len(names))]
    for a, b in pairs:
        x, y = find(a), find(b)
        groups[max(x, y)] = min(x, y)
    assert {i: find(i) for i in groups} == want


@pytest.mark.parametrize("node_size", [8, 100, 1 << 14])
def test_links_connect_what_brute_force_connects(spark, node_size, monkeypatch):
    monkeypatch.setattr(op, "DEEPEST", 6)
    prints = planted(7, 150, (120, 40))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp bigint")
    links = components(op.link_prints(df, node_size=node_size)).collect()
    top = {int(r.u): int(r.v) for r in links}
    signed = [int(x) for x in prints.view(np.int64)]
    got = {}
    for x in signed:
        got.setdefault(top.get(x, x), set()).add(x)
    want = {}
    for i, root in brute(list(enumerate(int(p) for p in prints))).items():
        want.setdefault(root, set()).add(signed[i])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(4000))
    rows = [(9, base, 1), (4, base, 1), (7, base.replace("word200", "other"), 1), (8, "something else entirely here now", 1)]
    rows += [(1, None, 1), (2, "", 1), (3, " ", 1), (None, base, 1), (None, "lonely text without an id", 1), (8, "something else entirely here now", 2)]
    found = op.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, fp int")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == sorted(
        [("9", "4"), ("4", "4"), ("7", "4"), ("8", "8"), ("8", "8"), ("1", "1"), ("2", "1"), ("3", "1"), ("None", "4"), ("None", "None")]
    )
    assert all(r.fingerprint == f"{plain_fingerprint(t):016x}" for r in found for i, t, _ in rows if i is not None and i == r.doc_id)


def test_empty_table(spark):
    assert op.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(70, 70)]
    found = components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert {r.u: r.v for r in found} == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 200)}}
