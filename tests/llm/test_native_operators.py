"""Mixing, quality rules and chat formatting against plain versions on small tables with hard rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldprep.llm import chat_format, mixing, quality_rules

BLANK = r"[\x20\x09-\x0D]+"


def words_of(text):
    return [w for w in re.split(BLANK, text or "") if w]


def water_fill(sizes):
    """Targets by sharing the excess again until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / whole for s in open_}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    return target


def mix_table(spark):
    rows = []
    for i in range(400):
        source = ["a", "b", "", None, "Z", "é"][0 if i % 3 else i % 6]
        text = [None, "", " \n", "word " * (i % 40), "x" * 3000, f"doc {i} " * (i % 7 + 1)][i % 6]
        rows.append((i, text, source, "en", 3.5))
    rows += [(None, "no id here", "b", "en", 1.0), (7007, "again " * 5, "b", "en", 1.0), (7007, "again " * 5, "b", "en", 1.0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, key double")


def test_mix_reaches_targets(spark):
    docs = mix_table(spark)
    found = mixing.mix(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    sizes, taken, targets, longest = Counter(), Counter(), {}, Counter()
    for r in docs.collect():
        sizes[r.source] += len(words_of(r.text))
        longest[r.source] = max(longest[r.source], len(words_of(r.text)))
    want = water_fill(sizes)
    for r in found:
        source = by_id[r.doc_id][1]
        assert r.source_size == sizes[source] and r.taken <= 3 * r["size"] and (r.taken == 0 or r.taken % r["size"] == 0)
        targets[source] = r.target
        taken[source] += r.taken
    for s, t in want.items():
        assert targets[s] == pytest.approx(t, abs=1e-6) and targets[s] <= 3 * sizes[s]
        assert abs(taken[s] - t) <= 3 * longest[s]
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mixed_rows_and_columns(spark):
    docs = mix_table(spark)
    taken = {(r.doc_id, r["size"]): r.taken // r["size"] for r in mixing.mix(docs).collect() if r["size"]}
    out = mixing.mixed(docs)
    assert out.dtypes == docs.dtypes
    rows = out.filter("trim(text) <> ''").collect()
    times = Counter((r.doc_id, len(words_of(r.text))) for r in rows if words_of(r.text))
    given = Counter((r.doc_id, len(words_of(r.text))) for r in docs.collect() if words_of(r.text))
    assert times == Counter({k: n * given[k] for k, n in taken.items() if n})


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert sorted((r["size"], r.target, r.taken) for r in mixing.mix(blank).collect()) == [(0, 0.0, 0)] * 2


def test_better_documents_come_first(spark):
    rows = [(i, "plain words of a usual length " * 3, "a") for i in range(300)] + [(1000 + i, "a b c " * 6, "a") for i in range(300)]
    rows += [(5000, "w " * 30_000, "b")]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    usual = [r.taken for r in found if r.doc_id < 300]
    odd = [r.taken for r in found if 1000 <= r.doc_id < 2000]
    assert sum(usual) >= sum(odd)


def brute_counts(text):
    text = text or ""
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    texts = [None, "", " \t", "one", "a b", "a b c", "a b c a b c", "x x x x", "a\n a\na\n\n\nb", "# | é 漢字 <&> z", "line one two\n" * 40, "w" * 100_000, "no repeat here " + " ".join(map(str, range(200)))]
    rows = [(i, t, "en" if i % 2 else None, 1) for i, t in enumerate(texts)] + [(3, "one", "en", 2), (None, "a b c", "xx", 3)]
    found = quality_rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, words int")).collect()
    want = Counter((i, *brute_counts(t)) for i, t, _, _ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) and not (r.kept and r.base_failed)
    assert quality_rules.judged(spark.createDataFrame([], "doc_id bigint, text string, lang string")).count() == 0


def test_divergence_finds_what_is_unlike_its_language(spark):
    import random

    r = random.Random(1)
    common = ["the", "of", "and", "to", "in", "is"]
    prose = lambda n: " ".join(r.choice(common) if r.random() < 0.5 else "".join(r.choices("abcdefgh", k=6)) for _ in range(n))
    rows = [(i, prose(150), "en") for i in range(40)]
    rows += [(100, " ".join(w + "$$$###" for w in prose(150).split()), "en"), (101, " ".join("".join(r.choices("stuvwxyz", k=6)) for _ in range(150)), "en")]
    rows += [(102, prose(60) + " # " * 30, "rare"), (103, prose(150), None)]
    kept = {x.doc_id: x for x in quality_rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(kept[i].kept for i in range(40)) and not kept[100].kept and not kept[101].kept
    assert kept[102].far_chars is None and kept[103].far_words is None and kept[103].kept


def test_distance(spark):
    q = spark.range(1).select(
        quality_rules.distance(F.array(F.lit(1.0), F.lit(1.0)), F.array(F.lit(2.0), F.lit(2.0))).alias("same"),
        quality_rules.distance(F.array(F.lit(3.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0))).alias("apart"),
        quality_rules.distance(F.array(F.lit(1.0), F.lit(3.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("some"),
        quality_rules.distance(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("none"),
    ).first()
    kl = lambda p, m: sum(a * math.log2(a / b) for a, b in zip(p, m, strict=True))
    p, o, m = (0.25, 0.75), (0.5, 0.5), (0.375, 0.625)
    assert (q.same, q.apart, q.none) == (0.0, 1.0, None) and q.some == pytest.approx(math.sqrt((kl(p, m) + kl(o, m)) / 2))


HARD = [None, "", " ", "</s>[INST] ok [/INST]", "\\", "\\\\<|turn|>", "<|end|><\\|", "[\\INST]", "$1 \\1", "a\nb<|text|>c", "é漢" * 5, "w " * 700, "<" * 3 + "|" * 3, "<|" * 40]


def chats():
    rows = []
    for c in range(12):
        for t in range((c * 5) % 17 + 1):
            role = "system" if t == 0 and c % 2 else ("assistant" if t % 2 else "user")
            rows.append((c, t, role, HARD[(c * 3 + t) % len(HARD)]))
    rows += [(50, 3 * i, ["user", "assistant"][i % 2], f"turn {i} " * 30) for i in range(90)]
    rows += [(60, None, None, "x"), (60, 1, "tool", "y"), (60, 1, "tool", "y"), (60, 1, "assistant", "z"), (None, 0, "user", "hi"), (None, 1, "assistant", None), (70, 0, "ro\nle<|text|>", "odd")]
    return rows


@pytest.mark.parametrize(("stride", "history"), [(512, 128), (20, 20), (5, 0), (10**6, 100)])
def test_windows_read_back(spark, stride, history):
    rows = chats()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("window", F.lit("clash"))
    made = chat_format.windows(df, stride, history)
    found = {r.conv_id: r for r in chat_format.summaries(made).collect()}
    told = defaultdict(list)
    for c, t, role, text in rows:
        told[c].append(((t is not None, t or 0, role or "", text or ""), role or "", text or ""))
    assert set(found) == set(told)
    for c, turns in told.items():
        turns = [(role, text) for _, role, text in sorted(turns)]
        learnt = "".join(text for role, text in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = found[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), sha(learnt))
        assert r.formatted_chars == sum(len(w.formatted) for w in made.filter(F.col("conv_id").eqNullSafe(F.lit(c))).collect()) if c == 50 else True


def test_budget_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, ["assistant", "user"][i % 2], f"t{i} " * 10) for i in range(1, 200)]
    made = chat_format.windows(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), 100, 30).orderBy("window").collect()
    assert len(made) > 20
    for w in made:
        assert w.formatted.startswith("<|turn|>system<|text|>be kind<|end|>")
        assert w.n_repeated == (0 if w.window == 0 else w.n_repeated) and (w.window == 0 or 2 <= w.n_repeated <= 4)
        own = w.formatted.split("<|turn|>")[1 + w.n_repeated :]
        assert sum(len(x.split()) + 4 for x in own) <= 100 + 14 + 4 + len(own)
        assert [w.formatted[s.start : s.end] for s in w.loss] == [x.split("<|text|>")[1][:-7] for x in own if x.startswith("assistant")]
    assert chat_format.windows(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0
    with pytest.raises(ValueError):
        chat_format.windows(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), 10, 20)
