"""Toxicity, language and secret models: held-out accuracy, and plain versions of the fixed parts."""

import itertools
import math
import random
import re
import unicodedata
import zlib

import numpy as np

from fieldprep.llm import language, secrets, subwords, toxicity

INSULTS = ["dreckig", "idiotic", "wretched", "stupidly"]


def prose(r, n, letters="abcdefghilmnoprstu"):
    return " ".join("".join(r.choices(letters, k=r.randint(2, 8))) for _ in range(n))


def toxic_corpus(n=1200):
    r, rows = random.Random(4), []
    for i in range(n):
        text, bad = prose(r, r.randint(5, 200)), int(i % 3 == 0)
        if bad:
            words = text.split()
            for _ in range(max(1, len(words) // 12)):
                words[r.randrange(len(words))] = r.choice(INSULTS)
            text = " ".join(words)
        rows.append((i, text, bad))
    return rows


def held(i, modulus, rest):
    return zlib.crc32(str(i).encode()) % modulus == rest


def test_toxicity_on_held_out_documents(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "y"), (9001, "", "y"), (9002, "idiotik stupidli wretchet " * 400, "z")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows] + [(0, 0), (9001, None)], "doc_id bigint, toxic int")
    model = toxicity.fit_on(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == len(rows) + 3
    right = [found[i].predicted == b for i, _, b in rows if held(i, 3, 1)]
    assert np.mean(right) > 0.95
    assert all(found[i].held_out == held(i, 3, 1) for i, _, _ in rows) and found[None].held_out is False
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found.values())
    assert found[9001].predicted == 0 and found[None].predicted == 0
    assert found[9002].score > 0.5  # misspelt everywhere
    clean = toxicity.drop_toxic(docs, model)
    assert clean.dtypes == docs.dtypes
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, r in found.items() if not r.predicted)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.predicted for r in toxicity.score(docs, toxicity.fit_on(docs, none)).collect()] == [0, 0]
    assert toxicity.score(docs.limit(0), toxicity.fit_on(docs.limit(0), none)).count() == 0
    all_toxic = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, toxic int")
    assert [r.predicted for r in toxicity.score(docs, toxicity.fit_on(docs, all_toxic)).collect()] == [1, 1]


def test_held_out_labels_are_never_used(spark):
    rows = toxic_corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    turned = [(i, 1 - b if held(i, 3, 1) else b) for i, _, b in rows]
    a = toxicity.fit_on(docs, spark.createDataFrame([(i, b) for i, _, b in rows], "doc_id bigint, toxic int"))
    b = toxicity.fit_on(docs, spark.createDataFrame(turned, "doc_id bigint, toxic int"))
    assert np.array_equal(a.value, b.value) and (a.scale, a.shift) == (b.scale, b.shift)


def test_language_on_held_out_documents(spark):
    r, sets = random.Random(2), {"aa": "abcdefgh", "bb": "efghijkl", "cc": "äöüßmnop"}
    rows = [(i, prose(r, r.randint(3, 60), sets[x]), x) for i, x in enumerate(["aa", "bb", "cc"] * 150)]
    odd = [(9000, None, "aa"), (9001, "", "bb"), (9002, "12 34 !?", "cc"), (9003, "é", None), (None, prose(r, 20, sets["bb"]), None), (9004, prose(r, 90_000, sets["aa"]), None)]
    docs = spark.createDataFrame([(*x, "s") for x in rows + odd], "doc_id bigint, text string, lang string, lang_pred string")
    found = {x.doc_id: x for x in language.identify(docs, language.fit_on(docs)).collect()}
    assert np.mean([found[i].lang_pred == x for i, _, x in rows if held(i, 5, 0)]) > 0.97
    assert [found[i].lang_pred for i in (9000, 9001, 9002)] == ["und"] * 3 and [found[i].score for i in (9000, 9001, 9002)] == [0.0] * 3
    assert found[9003].lang_pred in sets and found[None].lang_pred == "bb" and found[9004].lang_pred == "aa"
    assert all(found[i].held_out == held(i, 5, 0) for i, _, _ in rows) and all(0 <= x.score <= 1 for x in found.values())
    assert language.identify(docs.limit(0), language.fit_on(docs.limit(0))).count() == 0
    unlabelled = docs.withColumn("lang", docs.lang.substr(9, 1)).filter("doc_id < 5").replace("", None, "lang")
    assert {x.lang_pred for x in language.identify(unlabelled, language.fit_on(unlabelled)).collect()} == {"und"}


def test_ngrams_of_words():
    g = subwords.Grams(["Ab, é1", "", "x x x y"], 30)
    assert (g.words, g.part.tolist()) == (6, [0, 0, 2, 2, 2, 2])
    assert np.bincount(g.word).tolist() == [3, 3, 1, 1, 1, 1]  # with borders: 2 + 1, 2 + 1, 1 each
    runs = subwords.Grams(["x x x y"], 30, runs=True)
    assert runs.words == 2
    long = ["ab " * subwords.BLOCK, None, "c" * (2 * subwords.BLOCK)]
    assert {n for n, _ in subwords.pieces(long)} == {0, 1, 2}
    assert "".join(p for n, p in subwords.pieces(long) if n == 0) == long[0]


def plain_base(text):
    found = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    for m in re.finditer(rf"""(?:{word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            found.append((m.start(), 0, m.end(), m[1]))
    found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_base_patterns():
    r = random.Random(8)
    bits = ["password", "PassWd", "toKen", "apikey", "API_KEY", "ſecret", "toKen", ": ", "=", " = '", '": "', "AKIA", "ABCDEFGH123456", "0a1b2c3d4e5f6071", "abc", "é", "x+/_.=-", " ", "\n", "secret"]
    for _ in range(3000):
        text = "".join(r.choices(bits, k=r.randint(0, 12)))
        assert secrets.base_matches(text) == plain_base(text), text


def test_inferred_formats_are_added(spark):
    r = random.Random(6)
    key = lambda: "sk_" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=24))
    rows = [(i, f"{prose(r, 10)} {'token = ' if i % 10 else ''}{key()} at 2024-01-{i % 28 + 1:02d}T10.00.00 v{i}.{i}.release") for i in range(300)]
    rows += [(900, None), (901, ""), (None, "0123456789abcdef0123"), (901, "é AKIA" + "Q" * 20)]
    docs = spark.createDataFrame([(*x, "s") for x in rows], "doc_id bigint, text string, spans string")
    found = secrets.find(docs, secrets.fit_on(docs)).collect()
    assert len(found) == len(rows)
    by_id = {x.doc_id: x for x in found if x.doc_id is not None and x.doc_id < 900}
    for i, text in rows[:300]:
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b, _ in plain_base(text))
        assert by_id[i].base == base and set(filter(None, base.split(","))) <= set(by_id[i].spans.split(","))
        at = text.index("sk_")
        added = [x for x in by_id[i].spans.split(",") if x.startswith("format")]
        assert added in ([], [f"format:{at}:{at + 27}"] if i % 10 == 0 else [])
    # The threshold leaves out the least typical twentieth.
    assert sum(x.n_format for x in by_id.values()) >= 25
    lone = [x for x in found if x.doc_id is None]
    assert (lone[0].n_hex, lone[0].spans) == (1, "hex:0:20")
    assert secrets.find(docs.limit(0), secrets.fit_on(docs.limit(0))).count() == 0


def test_automaton_is_smaller_than_its_prefix_tree():
    r = random.Random(3)
    values = ["".join(r.choices("0123456789abcdef", k=32)) for _ in range(200)]
    automaton = secrets.infer(values)
    assert len(automaton.logs) == 33  # a state per place and one for the beginning
    score = lambda t: automaton.score(t.translate(secrets._TABLE)) / len(t)
    assert score("".join(r.choices("0123456789abcdef", k=32))) > score("thequickbrownfoxjumpsoverthelazy")


def test_ordinary_tokens_come_from_all_texts(spark):
    r = random.Random(9)
    few = [(i, " ".join(f"id-{r.randrange(10**9):09d}/x" for _ in range(6))) for i in range(1200)]
    many = [(5000 + i, " ".join(f"v{r.randrange(10**4)}.{r.randrange(10**4)}.release+{x}" for x in "abcdefgh")) for i in range(1200)]
    labelled = [(9000 + i, "token = " + "".join(r.choices("ABCDEFGH0123456789", k=24))) for i in range(40)]
    rows = few + many + labelled
    tokens = {t for _, text in few + many for t in text.split()}
    expected = sorted(tokens, key=secrets.rank)[: secrets.ORDINARY]
    models = []
    for n, part in ((1, rows), (7, rows[::-1]), (3, r.sample(rows, len(rows)))):
        docs = spark.createDataFrame(part, "doc_id bigint, text string").coalesce(1) if n == 1 else spark.createDataFrame(part, "doc_id bigint, text string").repartition(n)
        assert secrets.samples(docs)[""] == expected
        models.append(secrets.fit_on(docs))
    assert models[0].background == models[1].background == models[2].background
    assert models[0].thresholds == models[1].thresholds == models[2].thresholds
    least = secrets.Smallest(5)
    for t in sorted(tokens):
        least.add(t)
    assert [t for t, _ in least.items()] == expected[:5]


def test_long_documents_are_learnt_from(spark):
    r = random.Random(12)
    sets = {"long": "abcdefgh", "short": "mnopqrst", "mixed": "uvwxyzäö"}
    rows = [(i, "1 2 3. " + prose(r, 2500, sets["long"]), "long") for i in range(40)]
    rows += [(100 + i, prose(r, 30, sets["short"]), "short") for i in range(60)]
    # Nearly all of this language is long or without a letter, as are its smallest hashes.
    rows += [(1000 + i, prose(r, 2500, sets["mixed"]) if i % 2 else "12 !", "mixed") for i in range(60)] + [(3000 + i, prose(r, 30, sets["mixed"]), "mixed") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit_on(docs, sample=20)
    assert model.languages == ["long", "mixed", "short"]
    said, _ = model.predict([prose(r, 40, sets[x]) for x in model.languages])
    assert said == model.languages


def test_a_repeated_document_does_not_fill_the_sample(spark):
    r = random.Random(13)
    rows = [(1, prose(r, 20), "aa")] * 3000 + [(10 + i, prose(r, 20), "aa") for i in range(60)]
    seen = []
    fit, language.fit = language.fit, lambda texts, langs: seen.extend(texts)
    try:
        language.fit_on(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), sample=30)
    finally:
        language.fit = fit
    assert len(seen) == 30 == len(set(seen))


def test_every_language_is_learnt(spark):
    r, rows = random.Random(14), []
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 4200)]
    alphabets = {f"l{k:03d}": letters[7 * k : 7 * k + 7] for k in range(600)}
    for x, alphabet in alphabets.items():
        rows += [(len(rows) + j, prose(r, 40, alphabet), x) for j in range(8)]
    model = language.fit_on(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.languages == sorted(alphabets) and model.values.shape[1] == language.DIMENSIONS
    # The vectors and the table of all languages say the same.
    few = language.Model(model.languages, (model.values @ model.weights), model.bias)
    texts = [prose(r, 30, alphabets["l007"]), "", prose(r, 3, alphabets["l599"])]
    assert np.allclose(few.logits(texts), model.logits(texts), atol=1e-4)
    assert language.amounts(4) == (300, 10_000) and language.amounts(512)[0] >= 100 and language.amounts(10**6) == (8, 400)


def test_toxicity_is_learnt_from_long_documents(spark):
    rows, r = [], random.Random(15)
    for i in range(240):
        words = prose(r, 2600).split()
        if i % 3 == 0:
            for at in range(0, len(words), 12):
                words[at] = r.choice(INSULTS)
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    assert min(len(t) for _, t, _ in rows) > toxicity.LONGEST
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id bigint, text string")
    model = toxicity.fit_on(docs, spark.createDataFrame([(i, b) for i, _, b in rows], "doc_id bigint, toxic int"), sample=(60, 60))
    z = model.scores([prose(r, 40) + " idiotic wretched stupidly dreckig " * 4, prose(r, 40)])
    assert z[0] > 0.7 > z[1]
    assert toxicity.taken([5, 9, 4], 12) == [5, 7, 0]


def test_every_token_beside_base_matches_is_scored():
    r = random.Random(16)
    key = lambda letters: "sk_" + "".join(r.choices(letters, k=24))
    letters, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    words = prose(r, 40_000).split()
    values = {"assign": [key(letters + digits) for _ in range(200)] + [key(letters) for _ in range(200)]}
    values["access"] = ["sk_" + "".join(r.choices(digits, k=16)) + "-" + key(letters)[3:] for _ in range(200)]
    model = secrets.fit(values, [a + b + c for a, b, c in zip(words, words[1:], words[2:]) if len(a + b + c) >= 12][:4000])
    text = "a " + key(letters) + " b sk_1234567890123456-" + key(letters)[3:] + " c token=" + (own := key(letters + digits))
    base, added = model.spans(text)
    assert [k for _, k, _, _ in base] == [2, 0]
    # One without a digit, one of which a base match covers the digits; the value of the assignment is its base match.
    assert [text[a:b] for a, _, b, _ in added] == text.split()[1::2][:2] and own == base[1][3]
    assert list(secrets.candidates("0123456789abcdef0123", secrets.base_matches("0123456789abcdef0123"))) == []
    assert [x[3] for x in secrets.candidates(text, base)] == [False, True]


def test_automata_of_planted_formats():
    r = random.Random(17)
    letters, digits, hexes = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    pick = lambda alphabet, k: "".join(r.choices(alphabet, k=k))
    formats = {
        "assign": lambda: "key_" + pick(letters + digits, 24),
        "access": lambda: "AKIA" + pick(letters + digits, 16),
        "hex": lambda: pick(hexes, r.choice((16, 40))),
    }
    words = prose(r, 12_000).split()
    ordinary = [t for t in (a + b + c for a, b, c in zip(words, words[1:], words[2:])) if len(t) >= 12][:4000]
    values = {k: [make() for _ in range(120)] for k, make in formats.items()}
    model = secrets.fit(values, ordinary)
    # Every length is a state of its own: key_ and 24 more, AKIA and 16 more, up to 40, and the empty beginning.
    assert [len(a.logs) for a in model.automata] == [29, 21, 41]
    for make in formats.values():
        assert np.mean([model.is_secret(make()) for _ in range(400)]) >= 0.9
    assert not any(model.is_secret(t) for t in ordinary)
    assert not any(model.is_secret(pick("abcdefghijklmnop", 20) + ".") for _ in range(200))
    few = secrets.fit({k: v[: secrets.LEAST_VALUES] for k, v in values.items()}, ordinary)
    assert np.mean([few.is_secret(formats["access"]()) for _ in range(400)]) >= 0.5
    assert secrets.fit({k: v[: secrets.LEAST_VALUES - 1] for k, v in values.items()}, ordinary).automata == []


def test_likelihoods_of_an_automaton_sum_to_one():
    a = secrets.infer(["ab1", "ab2", "xy-z", "x", "12345678"] * 3)
    for logs, unseen in zip(a.logs, a.unseen, strict=True):
        assert abs(sum(np.exp(x) for x in logs.values()) + (secrets.CLASSES + 1 - len(logs)) * np.exp(unseen) - 1) < 1e-9


def plain_score(model, text):
    """The score of one text, word by word and window by window."""
    word_char = lambda c: ord(c) >= 0x10000 or unicodedata.category(c)[0] in "LMN"
    words = "".join(c if word_char(c) else "\0" for c in (text or "").lower()).split("\0")
    words = [w for w, _ in itertools.groupby(w for w in words if w)]
    means = []
    for word in words:
        codes = [0, *map(ord, word), 0]
        values = []
        for n in subwords.SIZES:
            for i in range(len(codes) - n + 1):
                h = 0
                for c in codes[i : i + n]:
                    h = (h * 0x100000001B3 + c) % 2**64
                values.append(float(model.value[((h + n) * 0x9E3779B97F4A7C15) % 2**64 >> (64 - toxicity.BITS)]))
        means.append(sum(values) / len(values))
    half = toxicity.WINDOW // 2
    starts = range(0, max(1, len(words) - half), half)
    best = max((sum(means[a : a + toxicity.WINDOW]) / toxicity.WINDOW + model.bias for a in starts), default=None)
    z = min(model.bias, 0.0) if not words else best
    return 1 / (1 + math.exp(-(model.scale * z + model.shift)))


def test_scores_equal_a_plain_scorer():
    r = random.Random(18)
    rows = toxic_corpus(240)
    model = toxicity.fit([t for _, t, _ in rows], np.array([b for _, _, b in rows]), 1 / 3)
    texts = [None, "", " .,! ", "a", "x x x y", "é ÄÖ 𝒳𝒴 idiotic!", "q" * 700, *(t for _, t, _ in rows[:30])]
    texts += [prose(r, n) for n in (11, 12, 13, 23, 24, 25, 36, 37, 48, 49)] + [prose(r, 500).replace(" ", "\n-", 40)]
    assert np.allclose(model.scores(texts), [plain_score(model, t) for t in texts], rtol=1e-4, atol=1e-7)


def test_few_toxic_texts_are_learnt_from():
    found = []
    rows = toxic_corpus(1200)
    for seed in (7, 8):
        r = random.Random(seed)
        few = r.sample([x for x in rows if x[2]], 32) + r.sample([x for x in rows if not x[2]], 240)
        model = toxicity.fit([t for _, t, _ in few], np.array([b for _, _, b in few]), 32 / 272, seed=seed)
        rest = [x for x in rows if x not in few]
        said = model.scores([t for _, t, _ in rest]) >= toxicity.THRESHOLD
        found.append((np.mean([s for s, x in zip(said, rest, strict=True) if x[2]]), np.mean([s for s, x in zip(said, rest, strict=True) if not x[2]])))
    # 24 texts to learn from and 8 to calibrate on: about two thirds are found (0.65 and 0.68), not nine tenths.
    assert all(hit >= 0.55 and wrong <= 0.03 for hit, wrong in found), found
