"""The pipeline against a plain version of its stages, on a small table."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from test_simhash import brute, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from fieldprep.llm import mixing, queries, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r, rows, labels = random.Random(12), [], []
    for i in range(240):
        words = ["".join(r.choices("abcdefghilmnoprstu", k=r.randint(2, 8))) for _ in range(r.randint(60, 220))]
        bad = i % 8 == 0
        if bad:
            words[::9] = ["dreckig"] * len(words[::9])
        rows.append((i, " ".join(words), "en", f"s{i % 4}", len(words)))
        if i % 5:
            labels.append((i, 1, int(bad)))
    for i in range(60):
        base = rows[3 * i + 1]
        text = base[1].replace(" ", "  ", 5) if i % 2 else base[1] + "\n"
        rows.append((1000 + i, text, "en", "s0", 1))
    long = " ".join("".join(r.choices("abcdefghilm", k=5)) for _ in range(3000))
    rows += [(2000 + i, long.replace(" ", f" w{i} ", 1), None, None, 1) for i in range(6)]
    rows += [(3000, "", "en", "s1", 0), (3001, None, "en", "s1", None), (3002, "one <|endoftext|>", "en", "s2", 2)]
    where = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{where}/labels.parquet")
    return str(where)


def test_stages_keep_columns_and_match_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, texts = docs.dtypes, {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    model = toxicity.fit_on(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
    assert len(clean) < len(texts)
    out = stages["toxicity"](spark, docs, folder)
    assert out.dtypes == columns and {r.doc_id for r in out.collect()} == clean

    out = stages["exact_dedup"](spark, out, folder)
    first = {}
    for i in sorted(clean):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i] or ""), i)
    assert out.dtypes == columns and sorted(r.doc_id for r in out.collect()) == sorted(first.values())

    out = stages["simhash_near_dedup"](spark, out, folder)
    roots = brute([(i, plain_fingerprint(texts[i])) for i in sorted(first.values())])
    stay = sorted(i for i, root in roots.items() if i == root)
    assert out.dtypes == columns and sorted(r.doc_id for r in out.collect()) == stay and len(stay) < len(first)

    kept = out
    out = stages["mixing"](spark, out, folder)
    times = {r.doc_id: r.taken // r["size"] for r in mixing.mix(kept).collect() if r["size"]}
    assert out.dtypes == columns
    assert Counter(r.doc_id for r in out.collect() if r.text and r.text.strip()) == Counter({i: n for i, n in times.items() if n})

    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    for r in stages["bpe"](spark, out, folder).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_registered(spark, folder):
    found = queries.QUERIES["pipeline"](spark, folder)
    assert found.count() > 50 and len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_rows_without_doc_id_and_repeated_rows(spark):
    from fieldprep.llm import exact_dedup, simhash

    long = " ".join(f"w{i}" for i in range(2000))
    rows = [(1, "a b", "x"), (1, "a b", "x"), (1, "c", "y"), (None, "a  b", "z"), (None, "only", "z"), (None, "only", "q"), (2, long, "r"), (None, long + " end", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
    exact = exact_dedup.drop_copies(docs)
    assert exact.dtypes == docs.dtypes
    assert sorted((str(r.doc_id), r.text[:4]) for r in exact.collect()) == sorted([("1", "a b"), ("1", "c"), ("None", "only"), ("2", long[:4]), ("None", long[:4])])
    near = simhash.drop_near_copies(exact)
    assert near.dtypes == docs.dtypes
    assert sorted((str(r.doc_id), r.text[:4]) for r in near.collect()) == sorted([("1", "a b"), ("1", "c"), ("None", "only"), ("2", long[:4])])
    for empty in (exact_dedup.drop_copies(docs.limit(0)), simhash.drop_near_copies(docs.limit(0)), mixing.mixed(docs.limit(0).withColumnRenamed("row", "source"))):
        assert empty.count() == 0


def test_a_copy_goes_though_its_doc_id_stays_with_another_text(spark):
    from fieldprep.llm import exact_dedup, simhash

    r = random.Random(21)
    near, other = (" ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(300)) for _ in range(2))
    rows = [(0, "a b", 1), (1, "a  b", 2), (1, "c", 3), (1, "c", 4), (2, "c ", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest int")
    kept = exact_dedup.drop_copies(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted((x.doc_id, x.text) for x in kept.collect()) == [(0, "a b"), (1, "c"), (2, "c ")]
    docs = spark.createDataFrame([(0, near, 1), (1, near.upper(), 2), (1, other, 3), (2, other.upper(), 4)], "doc_id bigint, text string, print int")
    kept = simhash.drop_near_copies(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted((x.doc_id, x.print) for x in kept.collect()) == [(0, 1), (1, 3)]
