import hashlib
import random
from collections import Counter

import pytest

from fieldprep.llm import repeats as op


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n, size):
    """Texts with shared passages, edited copies, periodic stretches, wide characters and short ones."""
    r = random.Random(seed)
    words = ["ab", "c", "de", "é", "fgh", "the", "日本"]

    def prose(k):
        return " ".join(r.choice(words) for _ in range(k))

    passages = [prose(size // 2) for _ in range(3)]
    texts = [None, "", "x", "y" * (4 * size), "ab" * (3 * size)]
    for _ in range(n):
        text = prose(r.randint(0, 2 * size))
        if texts and r.random() < 0.4 and texts[-1]:
            text = texts[-1]
            for _ in range(r.randint(0, 3)):
                at = r.randint(0, max(0, len(text) - 1))
                text = text[:at] + r.choice(["", "Q", "zz"]) + text[at + r.randint(0, 2) :]
        if r.random() < 0.6:
            p = r.choice(passages)
            a = r.randint(0, len(p) // 2)
            at = r.randint(0, len(text))
            text = text[:at] + p[a : a + r.randint(0, len(p))] + text[at:]
        texts.append(text)
    return texts


@pytest.mark.parametrize(("seed", "length", "gram"), [(1, 40, 8), (2, 60, 10), (3, 60, 32), (4, 400, 64)])
def test_matches_brute_force(spark, seed, length, gram):
    texts = corpus(seed, 60, length // 2)
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, gram string, n int")
    found = sorted(op.repeated_bytes(docs, length, gram).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found] == brute(texts, length)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 97)
    texts = corpus(9, 25, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    found = sorted(op.repeated_bytes(docs, 50, 8).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found] == brute(texts, 50)


def test_repeated_rows_and_missing_ids(spark):
    text = "".join(chr(97 + (i * i) % 23) for i in range(90))
    rows = [(1, text), (1, text), (None, text[:70] + "Z"), (None, "alone " * 3), (2, None)]
    found = op.repeated_bytes(spark.createDataFrame(rows, "doc_id bigint, text string"), 40, 8).collect()
    want = brute([t for _, t in rows], 40)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in found) == sorted((str(i), w[0], w[1], w[3]) for (i, _), w in zip(rows, want, strict=True))


def test_empty_table(spark):
    assert op.repeated_bytes(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_planted_passages_show_in_n_removed(spark):
    """Passages of over 50 words: from 400 bytes on they go whole, below that they stay; n_bytes is the text's length."""
    r = random.Random(5)
    prose = lambda k: " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(3, 8))) for _ in range(k))
    long, short = prose(90), " ".join("".join(r.choices("qrstuvwxyz", k=4)) for _ in range(60))
    assert len(short) < 380 < 400 < len(long)
    clean = [prose(150) for _ in range(12)]
    planted = [f"{prose(r.randint(5, 90))} {p} {prose(r.randint(5, 90))}" for p in [long] * 5 + [short] * 5]
    docs = spark.createDataFrame(list(enumerate(clean + planted)), "doc_id bigint, text string")
    found = sorted(op.repeated_bytes(docs).collect())
    assert [x.n_bytes for x in found] == [len(t) for t in clean + planted]
    assert [x.n_removed >= len(long) for x in found] == [False] * 12 + [True] * 5 + [False] * 5
    assert [x.n_removed for x in found[:12] + found[17:]] == [0] * 17
    assert [(x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in found] == brute(clean + planted, 400)
