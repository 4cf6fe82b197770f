"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the vectors of its words, a word that of its hashed character n-grams, and a
linear softmax over the mean gives the language. Vectors and softmax are trained together by
stochastic gradient descent in numpy, on short windows of words so that short texts are known too.
On documents kept aside the logits are divided by a temperature, so that scores are the probability
of being right, and a score is chosen below which a prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.bags import Trainer
from fieldprep.llm.batches import steps
from fieldprep.llm.subwords import Grams, blocks

BITS, DIMENSIONS, SPREAD = 16, 16, 3
#: Words in a window that is learnt from.
WINDOW = 16
#: The most documents of a language that a model is fitted on, the most characters that one gives.
SAMPLE, LONGEST = 300, 10_000
#: Characters that all languages share; with many of them a document gives fewer, then a language fewer documents, but never below these.
CHARACTERS, SHORTEST, FEWEST = 24_000_000, 400, 8
#: Of the sample, one document in this many calibrates the scores.
CALIBRATE = 4
#: The share of wrong predictions among the accepted ones that rejection aims at.
WRONG = 0.002
UNKNOWN = "und"


@dataclass
class Model:
    """``values`` of a bucket per language; with ``weights`` its vector, of which these make the values of all languages."""

    languages: list[str] = field(default_factory=list)
    values: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0
    least: float = 0.0
    weights: np.ndarray | None = None

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """The mean of the word values of each text, per language; zero words count nothing."""
        sums, words = np.zeros((len(texts), self.values.shape[1])), np.zeros(len(texts))
        for numbers, parts in blocks(texts):
            g = Grams(parts, BITS, runs=True)
            if g.words:
                text = numbers[g.part]
                words += np.bincount(text, minlength=len(texts))
                share = 1.0 / np.bincount(g.word, minlength=g.words)[g.word]
                for k in range(self.values.shape[1]):
                    sums[:, k] += np.bincount(text[g.word], weights=self.values[g.bucket, k] * share, minlength=len(texts))
        means = sums / np.maximum(words, 1)[:, None]
        return (means if self.weights is None else means @ self.weights) + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lettered = np.array([any(map(str.isalpha, t or "")) for t in texts], dtype=bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = softmax(self.logits(texts) / self.temperature)
        best, score = p.argmax(axis=1), np.where(lettered, p.max(axis=1), 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)], score


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 5, epochs: int = 4, rate: float = 0.5) -> Model:
    """A model from labelled texts; one language alone is always predicted, none gives ``und``."""
    languages = sorted(set(langs))
    if not languages:
        return Model()
    number = {x: i for i, x in enumerate(languages)}
    label = np.array([number[x] for x in langs])
    held = np.arange(len(texts)) % CALIBRATE == CALIBRATE - 1
    some = [t for t, h in zip(texts, held, strict=True) if not h]
    t = Trainer(some, len(languages), width=WINDOW, bits=BITS, dimensions=DIMENSIONS, spread=SPREAD, seed=seed)
    target = label[~held][t.doc]
    weight = np.minimum(5.0, len(target) / (len(languages) * np.maximum(1, np.bincount(target, minlength=len(languages)))))
    for epoch in range(epochs):
        chosen = t.rng.permutation(len(target))
        for i in range(0, len(chosen), 512):
            batch = chosen[i : i + 512]
            t.step(batch, target[batch], weight[target[batch]], rate * (1 - epoch / epochs))
    # A table of all languages would grow with them; the vectors do not.
    few = len(languages) <= DIMENSIONS
    model = Model(languages, t.values() if few else t.vectors.astype(np.float32), t.bias, weights=None if few else t.weights)
    if held.any():
        z, y = model.logits([t for t, h in zip(texts, held, strict=True) if h]), label[held]
        grid = np.geomspace(0.05, 20, 60)
        cost = [-np.log(np.maximum(softmax(z / s)[np.arange(len(y)), y], 1e-12)).mean() for s in grid]
        model.temperature = float(grid[int(np.argmin(cost))])
        p = softmax(z / model.temperature)
        order = np.argsort(-p.max(axis=1))
        wrong = np.cumsum(p.argmax(axis=1)[order] != y[order]) / np.arange(1, len(y) + 1)
        good = np.flatnonzero(wrong <= WRONG)
        model.least = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0
    return model


def held_out() -> Column:
    """Rows that no model may learn from: those whose crc32 of the doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def amounts(languages: int, sample: int = SAMPLE) -> tuple[int, int]:
    """Documents that a language gives to the sample at most, and characters that a document gives."""
    each = max(SHORTEST, min(LONGEST, CHARACTERS // (languages * sample)))
    return min(sample, max(FEWEST, CHARACTERS // (languages * each))), each


def fit_on(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the documents that have a language and a letter and are not held out.

    Every language is learnt, from its ``sample`` documents with the smallest hash, whatever their
    length; a long one gives its first characters from its first letter on, as many as ``amounts`` says.
    """
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Model()
    most, each = amounts(len(counts), sample)
    opening = F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, each)
    hashed = known.select("lang", F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("hash"), "text")
    # Hashes are even, so a share of their range holds that share of a language's documents, give or take; the smallest
    # ones are all in it if it holds enough. Where documents repeat it may not, and is widened.
    shares = {x: (most + 6 * most**0.5 + 20) / n for x, n in counts.items()}
    picked, wanted = {}, shares
    while wanted:
        bounds = [(x, min(2**63 - 1, int(share * 2.0**64) - 2**63) if share < 1 else 2**63 - 1) for x, share in sorted(wanted.items())]
        under = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound bigint"))
        near = hashed.join(under, "lang").filter(F.col("hash") <= F.col("bound")).select("lang", "doc_id", "hash", opening.alias("text")).distinct()
        found = {x: [] for x in wanted}
        for r in near.collect():
            found[r["lang"]].append((r["hash"], r["doc_id"], r["text"]))
        picked |= found
        wanted = {x: 8 * share for x, share in wanted.items() if share < 1 and len(found[x]) < most}
    rows = sorted((i, x, text) for x, found in picked.items() for _, i, text in sorted(found)[:most])
    return fit([text for *_, text in rows], [x for _, x, _ in rows])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs``.

    A text that is NULL or has no letter is ``und`` with score 0 and rejected. A row without doc_id
    is predicted and not held out. Rows that repeat are each returned. ``lang`` is not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            langs, found = shared.value.predict(batch.column(2).to_pylist())
            rejected = (found < shared.value.least) | (found == 0)
            columns = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(found), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")
