"""Averaged hashed subword embeddings with a linear softmax, trained by gradient descent in numpy."""

from __future__ import annotations

import numpy as np

from fieldprep.llm.subwords import Grams, blocks


def spans(part: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of each window: every half width, none across parts, the last one shorter."""
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    sizes = np.diff(np.append(starts, len(part)))
    half = width // 2
    count = np.maximum(1, -(-(sizes - half) // half))
    which = np.repeat(np.arange(len(starts)), count)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    first = starts[which] + nth * half
    return first, np.minimum(first + width, (starts + sizes)[which])


def _runs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these sizes laid end to end: the run of each element and its place within."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _sums(rows: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows by key."""
    return np.stack([np.bincount(keys, weights=rows[:, d], minlength=size) for d in range(rows.shape[1])], axis=1)


class Trainer:
    """Windows of words over some texts, the n-gram vectors and the softmax.

    A word is the mean of its n-grams' vectors, a window the sum of its words over ``width``: a short
    window is filled up with words of vector zero. N-grams that fewer than ``spread`` texts hold keep
    the vector zero, since they could only be learnt by heart.
    """

    def __init__(self, texts: list[str], classes: int, *, width: int, bits: int, dimensions: int, spread: int, seed: int):
        self.rng, self.width = np.random.default_rng(seed), width
        base, bucket, word, sizes, held = 0, [], [], [], np.zeros(1 << bits, np.int64)
        first, end, doc = [], [], []
        for numbers, parts in blocks(texts):
            g = Grams(parts, bits, runs=True)
            if not g.words:
                continue
            a, b = spans(g.part, width)
            first.append(a + base)
            end.append(b + base)
            doc.append(numbers[g.part[a]])
            order = np.argsort(g.word, kind="stable")
            bucket.append(g.bucket[order])
            word.append((g.word[order] + base).astype(np.int32))
            sizes.append(np.bincount(g.word, minlength=g.words))
            # A text cut into several blocks counts once for each of them.
            held += np.bincount(np.unique(g.bucket * np.int64(len(texts)) + numbers[g.part][g.word]) // len(texts), minlength=1 << bits)
            base += g.words
        none = [np.empty(0, np.int64)]
        self.bucket, self.word, sizes = (np.concatenate(x or none) for x in (bucket, word, sizes))
        self.first, self.end, self.doc = (np.concatenate(x or none) for x in (first, end, doc))
        self.at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.known = held >= spread
        self.vectors = self.rng.uniform(-1, 1, (1 << bits, dimensions)) / dimensions * self.known[:, None]
        self.weights, self.bias = self.rng.normal(0, 0.1, (dimensions, classes)), np.zeros(classes)
        self.moved = np.full(1 << bits, 1e-12)

    def _rows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-gram of each row, the chosen window it lies in, its share of the window."""
        which, nth = _runs(self.end[chosen] - self.first[chosen])
        words = self.first[chosen][which] + nth
        sizes = self.at[words + 1] - self.at[words]
        of, nth = _runs(sizes)
        return self.bucket[self.at[words][of] + nth], which[of], (1.0 / (sizes * self.width))[of]

    def step(self, chosen: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One step down the weighted cross-entropy of the chosen windows; a vector's step shrinks as it has moved."""
        rows, which, share = self._rows(chosen)
        hidden = _sums(self.vectors[rows] * share[:, None], which, len(chosen))
        logits = hidden @ self.weights + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(chosen)), target] -= 1
        error = p * weight[:, None] / len(chosen)
        back = error @ self.weights.T
        used, inverse = np.unique(rows, return_inverse=True)
        slope = _sums(back[which] * share[:, None], inverse, len(used)) * self.known[used][:, None]
        self.moved[used] += (slope**2).mean(axis=1)
        self.vectors[used] -= rate * slope / np.sqrt(self.moved[used])[:, None]
        self.weights -= rate * hidden.T @ error
        self.bias -= rate * error.sum(axis=0)

    def values(self) -> np.ndarray:
        """What each n-gram adds to each class before averaging."""
        return (self.vectors @ self.weights).astype(np.float32)

    def window_sums(self, value: np.ndarray) -> np.ndarray:
        """The filled-up mean of a value per n-gram over each window."""
        sizes = np.maximum(np.diff(self.at), 1)
        words = np.bincount(self.word, weights=value[self.bucket], minlength=len(sizes)) / sizes
        sums = np.concatenate([[0.0], np.cumsum(words)])
        return (sums[self.end] - sums[self.first]) / self.width
