import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldprep.llm import bpe
from fieldprep.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORDS = ["the", " the", " tion", "tion", " stone", "stones", " stones", "aaaa", " é", "的"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    vocabulary = bpe.Vocabulary(PATH)
    coded = [w.encode() for w in WORDS]
    entries = {w: np.frombuffer(x, "<u4").tolist() for w, x in zip(coded, bpe.merge_words(coded, vocabulary), strict=True)}
    return bpe.Encoder(vocabulary, Lexicon.mapped(compile_lexicon(entries).to_bytes()))


def same(library, encoder, texts):
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, ids, got in zip(texts, want, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids.ids, repr(text)
        assert bpe.decode(got, encoder.vocabulary.token_bytes) == library.decode(ids.ids, skip_special_tokens=False)


def test_special_cases(library, encoder):
    same(library, encoder, [
        "", " ", "\n\n a  b\t", "it's we'll I'D 's", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "a b c\x1c\x85d",
        "日本語 text ä̈ 👩‍👩‍👧 ١٢٣ Ⅷ ½", "﻿x​y", "a" * 3000, "ab" * 700, "x" * 255 + " " + "y" * 257, "00112233" * 200, "՘ ࢏౜", "é" * 400,
    ])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_any_text(library, encoder, texts):
    same(library, encoder, texts)


def test_random_bytes_of_prose(library, encoder):
    r = random.Random(3)
    texts = ["".join(r.choice(["th", "er", "an", "é", " ", " ", "\n", "1", "!", "aaa", "ing", "ß"]) for _ in range(400)) for _ in range(200)]
    same(library, encoder, texts)


def test_long_words_have_the_ids_of_short_ones(encoder):
    r = random.Random(5)
    words = [bytes(r.choices(b"abcdeth", k=r.randint(1, 120))) for _ in range(300)]
    assert bpe.merge_words(words, encoder.vocabulary) == [bpe.merge_long(w, encoder.vocabulary) for w in words]


def test_settled_code_points_split_as_the_library_splits(library):
    """Every code point that the fast path takes, in four surroundings."""
    pattern, settled = regex.compile(bpe.SPLIT), regex.compile(f"[{bpe.SETTLED}]")
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and settled.match(chr(c))]
    for i in range(0, len(points), 500):
        text = "\n".join(f"a{c}a 1{c}1 !{c}! {c} {c}" for c in points[i : i + 500])
        assert [b for _, b in library.pre_tokenizer.pre_tokenize_str(text)] == [m.span() for m in pattern.finditer(text)]


def test_lexicon_is_minimal_and_numbers_words():
    words = [b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"a", b"ab" * 50]
    lexicon = Lexicon.mapped(compile_lexicon({w: [i, i + 1] for i, w in enumerate(words)}).to_bytes())
    places = lexicon.find([*words, b"", b"t", b"tapss", b"zzz", b"tas"])
    assert sorted(places[: len(words)]) == list(range(len(words))) and set(places[len(words) :]) == {-1}
    assert [np.frombuffer(lexicon.ids_of(p), "<u4").tolist() for p in places[: len(words)]] == [[i, i + 1] for i in range(len(words))]
    assert len(lexicon.final) < len({w[:i] for w in words for i in range(len(w) + 1)})
    small = compile_lexicon({b"tap": [1], b"taps": [1], b"top": [1], b"tops": [1]})
    assert len(small.final) == 5  # the classic example: the suffixes ap(s) and op(s) are shared
    assert compile_lexicon({}).find([b"a", b""]).tolist() == [-1, -1]


def test_documents(spark, library):
    rows = [(1, "the the stone", "x"), (2, None, "y"), (3, "", "z"), (None, "the the stone", "x"), (1, "w " * 60_000, "x"), (4, "<|endoftext|>", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    coded = bpe.decode_documents(bpe.encode_documents(docs, PATH, words=3), PATH).collect()
    want = sorted((str(i), hashlib.sha256(np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest(), t or "") for i, t, _ in rows)
    assert sorted((str(r.doc_id), hashlib.sha256(r.ids).hexdigest(), r.text) for r in coded) == want
    assert bpe.decode_documents(bpe.encode_documents(docs.limit(0), PATH), PATH).count() == 0


def test_counts_keep_frequent_words(spark):
    docs = spark.createDataFrame([(" ".join(f"u{i}" for i in range(900)) + " often" * 50,)] * 3, "text string").coalesce(1)
    found = {r.word: r.n for r in bpe.count_words(docs, bpe.Vocabulary(PATH), counted=500, handed_on=5).collect()}
    assert found[" often"] == 150
