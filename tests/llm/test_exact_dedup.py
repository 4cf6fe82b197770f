import hashlib
import re

import numpy as np
import pytest

from fieldprep.llm import exact_dedup as op


def brute(pairs):
    """doc_id -> (keep_id, group_size, digest) by the plain definition."""
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in pairs]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    return sorted((i, min(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm)


@pytest.mark.parametrize("keys_per_shard", [3, 4096])
def test_matches_brute_force(spark, keys_per_shard):
    texts = ["", None, " ", "\t\n", "a b", "a  b", "a b", "ä", "x" * 200_000, "x" * 200_000, "a b "]
    pairs = [(3 * i % 60, texts[i % len(texts)] if i % 7 else f"own {i}") for i in range(60) if 3 * i % 60 == 3 * i or i % 2]
    pairs = list({p[0]: p for p in pairs}.values())
    docs = spark.createDataFrame([(i, t, "de", 1) for i, t in pairs], "doc_id bigint, text string, digest string, shard int")
    found = op.exact_dedup(docs, keys_per_shard=keys_per_shard).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == brute(pairs)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)
    assert {r.stored for r in found} == {True, False}


def test_any_history_gives_the_same_verdict(spark):
    pairs = [(i, f"t{i % 5}") for i in range(40)]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    from pyspark.sql import functions as F

    for rule in (F.lit(False), F.lit(True), F.col("doc_id") % 3 == 0, F.col("doc_id") > 30):
        found = op.exact_dedup(docs, rule).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == brute(pairs)


def test_missing_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "b"), (5, "a"), (5, "a"), (5, "c")]
    found = op.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in found) == [
        ("5", "5", 1, True), ("5", "5", 3, True), ("5", "5", 3, True), ("None", "5", 3, False), ("None", "None", 1, True),
    ]


def test_empty_table(spark):
    assert op.exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_hash_is_minimal_and_perfect():
    words = np.random.default_rng(1).integers(0, 2**63, (5000, 4)).astype(np.uint64)
    words[1:500, 0] = words[0, 0]  # equal leading words do not disturb it
    levels = op._unpack(op._pack(op.build_levels(words)))
    assert sorted(op.slot_of(levels, words)) == list(range(5000))
