"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed character n-grams, a window of consecutive words is
the mean of its words, and a linear softmax over that mean gives the window's class. Vectors and
softmax are trained together, so a misspelling that was never seen shares the vectors of the
n-grams it keeps. A few hostile words vanish in the mean of a long text, so a text is as toxic as
its most toxic window: every window of a clean text is an example of clean, while of a toxic text
only its windows that the model finds most toxic count, all of them in the first epochs.

At prediction the softmax of two classes needs one number per n-gram, the product of its vector and
the difference of the class weights; what executors receive is that table, of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.bags import Trainer, spans
from fieldprep.llm.batches import steps, texts
from fieldprep.llm.store import cut
from fieldprep.llm.subwords import Grams, blocks

BITS, DIMENSIONS = 17, 8
#: Toxic texts per text that must hold an n-gram for it to be learnt, and the bounds of that number of texts.
PER_SPREAD, SPREAD = 16, (3, 6)
#: Texts read in all epochs together, and the bounds of the number of epochs: few texts are read more often.
READ, EPOCHS = 4800, (8, 24)
#: Words in a window; the next one begins half a window later.
WINDOW = 24
#: The most labelled documents, clean and toxic, that a model is fitted on; characters from which a document is long.
SAMPLE, LONGEST = (1500, 1200), 10_000
#: Of the sample, one document in this many calibrates the scores.
CALIBRATE = 4
THRESHOLD = 0.7


@dataclass
class Model:
    """A value per n-gram bucket, the bias of a window, and the scale and shift of calibrated scores."""

    value: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def logits(self, said: list[str | None]) -> np.ndarray:
        """The largest window logit of each text; that of an empty window where it has no word."""
        best = np.full(len(said), -np.inf)
        for numbers, parts in blocks(said):
            grams = Grams(parts, BITS, runs=True)
            if grams.words:
                first, end = spans(grams.part, WINDOW)
                sums = np.concatenate([[0.0], np.cumsum(grams.word_means(self.value))])
                np.maximum.at(best, numbers[grams.part[first]], (sums[end] - sums[first]) / WINDOW + self.bias)
        return np.where(np.isfinite(best), best, min(self.bias, 0.0))

    def scores(self, said: list[str | None]) -> np.ndarray:
        z = self.logits(said) * self.scale + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _train(said: list[str], toxic: np.ndarray, seed: int, rate: float) -> Model:
    spread = int(np.clip(toxic.sum() // PER_SPREAD, *SPREAD))
    epochs = int(np.clip(READ // len(said), *EPOCHS))
    t = Trainer(said, 2, width=WINDOW, bits=BITS, dimensions=DIMENSIONS, spread=spread, seed=seed)
    target = toxic[t.doc]
    for epoch in range(epochs):
        take = np.ones(len(t.doc), bool)
        if epoch >= 2:
            z = t.window_sums(t.vectors @ (t.weights[:, 1] - t.weights[:, 0])) + t.bias[1] - t.bias[0]
            top = np.full(len(said), -np.inf)
            np.maximum.at(top, t.doc, z)
            # Toxic: the worst window and others that look toxic. Clean: all but most of the safely clean.
            take = np.where(target == 1, (z >= top[t.doc]) | (z > 1), (z > -4) | (t.rng.random(len(z)) < 0.2))
        chosen = t.rng.permutation(np.flatnonzero(take))
        share = np.bincount(target[chosen], minlength=2)
        weight = np.minimum(len(chosen) / (2 * np.maximum(1, share)), 5.0)
        for i in range(0, len(chosen), 512):
            batch = chosen[i : i + 512]
            t.step(batch, target[batch], weight[target[batch]], rate * (1 - epoch / epochs))
    return Model((t.vectors @ (t.weights[:, 1] - t.weights[:, 0])).astype(np.float32), float(t.bias[1] - t.bias[0]))


def _calibrate(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the scores, targets drawn in by one row each.

    Newton steps, each halved until the loss falls; they end when no step lowers it.
    """
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    want = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, start = np.stack([z, np.ones_like(z)], axis=1), np.array([1.0, -2.0])

    def loss(beta: np.ndarray) -> float:
        at = x @ beta
        return float((weight * (np.logaddexp(0, at) - want * at)).sum() + 5e-4 * ((beta - start) ** 2).sum())

    beta, now = start, loss(start)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -60, 60)))
        slope = x.T @ (weight * (p - want)) + 1e-3 * (beta - start)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        while (then := loss(beta - move)) >= now and np.abs(move).max() > 1e-9:
            move = move / 2
        if then >= now:
            break
        beta, now = beta - move, then
    return max(0.1, float(beta[0])), float(beta[1])


def fit(said: list[str], toxic: np.ndarray, share: float, seed: int = 7, rate: float = 1.0) -> Model:
    """A model from labelled texts; ``share`` is the part of all labelled texts that is toxic.

    Without texts of both classes every score is that share.
    """
    toxic = np.asarray(toxic, np.int64)
    held = np.arange(len(said)) % CALIBRATE == 0
    if min(np.bincount(toxic[~held], minlength=2)) == 0 or min(np.bincount(toxic[held], minlength=2)) == 0:
        even = float(np.clip(share, 1e-12, 1 - 1e-12))
        return Model(np.zeros(1 << BITS, np.float32), 0.0, 0.0, float(np.log(even / (1 - even))))
    model = _train([t for t, h in zip(said, held, strict=True) if not h], toxic[~held], seed, rate)
    z, y = model.logits([t for t, h in zip(said, held, strict=True) if h]), toxic[held]
    # Both classes weigh the same, so the threshold leans to neither, however rare toxic texts are.
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    model.scale, model.shift = _calibrate(z, y, weight)
    return model


def held_out() -> Column:
    """Rows that no model may learn from: those whose crc32 of the doc_id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def taken(lengths: list[int], room: int) -> list[int]:
    """Characters that each text gives if ``room`` is left for all: whole texts, the one that exceeds it in part."""
    takes = []
    for n in lengths:
        takes.append(min(n, room))
        room -= takes[-1]
    return takes


def fit_on(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Model:
    """A model from the labelled documents that have a text and are not held out.

    Of each class the first documents in the order of a hash of their ids are read, ``sample`` at
    most: those of up to ``LONGEST`` characters, and where these are too few the others, whole, as
    long as the class has ``LONGEST`` characters for each missing document. A document labelled twice
    has the larger label; of the texts of a doc_id that repeats the last in order is read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")  # other columns may bear any name
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = docs.filter(~held_out() & F.col("text").isNotNull()).groupBy("doc_id").agg(F.max(F.length("text")).alias("n"), F.count("*").alias("rows"))
    known = cut(sizes.join(marked, "doc_id"))
    counts = {r["toxic"]: r["rows"] for r in known.groupBy("toxic").agg(F.sum("rows").alias("rows")).collect()}
    order = (F.col("n") > LONGEST, F.xxhash64("doc_id"), "doc_id")
    picks = []
    for c, most in enumerate(sample):
        rows = known.filter(F.col("toxic") == c).orderBy(*order).limit(most).collect()
        short, long = ([r for r in rows if (r["n"] > LONGEST) == over] for over in (False, True))
        picks += [(r["doc_id"], c, r["n"]) for r in short]
        takes = taken([r["n"] for r in long], (most - len(short)) * LONGEST)
        picks += [(r["doc_id"], c, n) for r, n in zip(long, takes, strict=True) if n]
    # At most as many ids as the sample allows.
    ids = docs.sparkSession.createDataFrame(picks, "doc_id bigint, toxic int, take int")
    text = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.max(F.substr(F.col("text"), F.lit(1), F.col("take"))).alias("text"))
    rows = sorted(text.collect(), key=lambda r: (r["toxic"], r["doc_id"]))
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.int64), share)


def _shared(docs: DataFrame, model: Model):
    return docs.sparkSession.sparkContext.broadcast(model)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A NULL or wordless text is scored as an empty window. A row without doc_id is scored and not
    held out. Rows that repeat are each returned. Other columns are not read.
    """
    shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = shared.value.scores(texts(batch))
            columns = [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns as they are."""
    shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield batch.filter(pa.array(shared.value.scores(texts(batch)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
