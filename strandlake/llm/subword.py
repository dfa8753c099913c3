"""Text classifier: hashed character n-gram embeddings, averaged per word and then per text, into a linear softmax.

Embeddings and softmax are trained together by stochastic gradient descent in numpy. A text is the bag of its distinct
words; a word weighs less the more of the training texts it is in. A word never seen shares its n-grams' vectors with
words that were. Once trained, every n-gram has a fixed contribution to each class, so scoring looks up words only.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
#: Distinct words whose contributions a worker remembers; dropped together when full. Words cut into n-grams at a time.
CACHED, STEP = 150_000, 8_000


@dataclass(frozen=True)
class Settings:
    """n-gram lengths (characters, with word ends), buckets, dimensions, passes, step size, and texts per step.

    ``sparse`` shortens the vector of each n-gram a step uses, in proportion to its step size; those of no use become zero.
    """

    shortest: int = 3
    longest: int = 5
    buckets: int = 1 << 16
    dims: int = 8
    passes: int = 12
    step: float = 0.5
    batch: int = 32
    common: float = 1e-3
    sparse: float = 0.0
    seed: int = 7


def distinct_words(text: str) -> list[str]:
    return list(set(text.lower().split()))


def ngrams(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of <word>, and of the whole word; ordered by word number."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    word = np.repeat(np.arange(len(words)), size)
    buckets, owner = [], []
    for n in range(s.shortest, s.longest + 1):
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n, U64)
        for k in range(n):
            h = h * U64(0x100000001B3) + code[k : len(code) - n + 1 + k]
        inside = np.flatnonzero(word[: len(h)] == word[n - 1 :])
        buckets.append(h[inside])
        owner.append(word[inside])
    power = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, U64))
    buckets.append(np.add.reduceat(code * power[np.arange(len(code)) - first[word]], first[:-1]))
    owner.append(np.arange(len(words)))
    h, w = np.concatenate(buckets), np.concatenate(owner)
    h = (h ^ (h >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    order = np.argsort(w, kind="stable")
    return ((h >> U64(40)) % U64(s.buckets)).astype(np.int64)[order], w[order]


@dataclass
class Model:
    """score: (buckets, classes) contributions; weight of the words seen in training; bias; scale of calibration."""

    settings: Settings
    labels: list
    score: np.ndarray
    bias: np.ndarray
    seen: dict[str, float]
    scale: float = 1.0
    shift: np.ndarray | None = None
    floor: float = 0.0

    def dumps(self) -> bytes:
        return pickle.dumps(self)


class Scorer:
    """logits(texts) of a model, with a bounded cache of words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, self.model.score.shape[1] + 1), np.float32)

    def _learn(self, words: list[str]) -> None:
        m = self.model
        rows = np.empty((len(words), m.score.shape[1] + 1), np.float32)
        rows[:, -1] = [m.seen.get(w, 1.0) for w in words]
        for at in range(0, len(words), STEP):
            some = rows[at : at + STEP]
            bucket, word = ngrams(words[at : at + STEP], m.settings)
            count = np.bincount(word, minlength=len(some))
            for k in range(m.score.shape[1]):
                some[:, k] = np.bincount(word, m.score[bucket, k], len(some)) / count * some[:, -1]
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.table = np.concatenate((self.table, rows))

    def logits(self, texts: list[str]) -> np.ndarray:
        bags = [distinct_words(t) for t in texts]
        flat = [w for b in bags for w in b]
        every = set(flat)
        new = [w for w in every if w not in self.known]
        if len(self.known) + len(new) > CACHED:
            self._forget()
            new = list(every)
        if new:
            self._learn(sorted(new))
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        ends = np.concatenate(([0], np.cumsum([len(b) for b in bags], dtype=np.int64)))
        out = np.tile(self.model.bias, (len(texts), 1)).astype(np.float64)
        full = np.flatnonzero(np.diff(ends) > 0)
        if len(full):
            sums = np.add.reduceat(self.table[at].astype(np.float64), ends[full], axis=0)
            out[full] += sums[:, :-1] / sums[:, -1:]
        return out

    def probabilities(self, texts: list[str]) -> np.ndarray:
        x = self.logits(texts) * self.model.scale
        if self.model.shift is not None:
            x = x + self.model.shift
        return softmax(x)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list, s: Settings = Settings()) -> Model:
    """A model of the given texts; texts are used whole, in a fixed random order."""
    names = sorted(set(labels))
    number: dict[str, int] = {}
    docs = []
    for t in texts:  # one at a time: each text's own copies of its words go again
        bag = sorted(distinct_words(t))
        docs.append(np.fromiter((number.setdefault(w, len(number)) for w in bag), np.int32, len(bag)))
    words = list(number)
    parts, grams = [], []
    for at in range(0, len(words), STEP):  # in steps, for n-grams of all words at once take much memory
        b, w = ngrams(words[at : at + STEP], s)
        parts.append(b.astype(np.int32))
        grams.append(np.bincount(w, minlength=len(words[at : at + STEP])))
    bucket = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    grams = np.concatenate(grams) if grams else np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(grams)))
    share = np.bincount(np.concatenate(docs) if docs else [], minlength=len(words)) / max(1, len(docs))
    weight = s.common / (s.common + share)
    rng = np.random.RandomState(s.seed)
    embed = (rng.rand(s.buckets, s.dims) - 0.5) * 1e-3  # n-grams never trained add next to nothing
    out = (rng.rand(s.dims, len(names)) - 0.5) / s.dims
    bias = np.zeros(len(names))
    squares_e, squares_o, squares_b = np.full(s.buckets, 1e-8), 1e-8, 1e-8
    target = np.array([names.index(y) for y in labels])
    full = np.array([i for i, d in enumerate(docs) if len(d)], np.int64)
    for _ in range(s.passes):
        order = rng.permutation(full)
        for at in range(0, len(order), s.batch):
            part = order[at : at + s.batch]
            own = np.concatenate([docs[i] for i in part])
            doc = np.repeat(np.arange(len(part)), [len(docs[i]) for i in part])
            mass = np.bincount(doc, weight[own], len(part))
            per_word = weight[own] / mass[doc] / grams[own]
            n = grams[own]
            ends = np.concatenate(([0], np.cumsum(n)))
            idx = bucket[np.repeat(first[own] - ends[:-1], n) + np.arange(ends[-1])]
            used, place = np.unique(idx, return_inverse=True)
            value = np.bincount(np.repeat(doc, n) * len(used) + place, np.repeat(per_word, n), len(part) * len(used)).reshape(len(part), len(used))
            hidden = value @ embed[used]
            error = softmax(hidden @ out + bias)
            error[np.arange(len(part)), target[part]] -= 1
            error /= len(part)
            grad_o = hidden.T @ error
            grad_e = value.T @ (error @ out.T)
            squares_e[used] += (grad_e**2).sum(axis=1)
            squares_o += (grad_o**2).sum()
            squares_b += (error.sum(axis=0) ** 2).sum()
            rate = s.step / np.sqrt(squares_e[used])[:, None]
            new = embed[used] - rate * grad_e
            if s.sparse:
                new *= np.maximum(0, 1 - s.sparse * rate / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12))
            embed[used] = new
            out -= s.step * grad_o / np.sqrt(squares_o)
            bias -= s.step * error.sum(axis=0) / np.sqrt(squares_b)
    seen = {w: float(weight[i]) for w, i in number.items() if weight[i] < 0.9}
    return Model(s, names, (embed @ out).astype(np.float32), bias, seen)


def calibrate(model: Model, texts: list[str], labels: list, counts: dict | None = None) -> Model:
    """Fits one scale to held-back texts (most likely of a fixed grid), then shifts classes to their true counts."""
    known = [i for i, y in enumerate(labels) if y in model.labels]
    if known:
        x = Scorer(model).logits([texts[i] for i in known])
        y = np.array([model.labels.index(labels[i]) for i in known])
        grid = 2.0 ** np.arange(-3, 4.01, 0.5)
        loss = [-np.log(softmax(x * k)[np.arange(len(y)), y] + 1e-12).mean() for k in grid]
        model.scale = float(grid[int(np.argmin(loss))])
    if counts:
        here = np.array([max(1, labels.count(y)) for y in model.labels], float)
        true = np.array([max(1, counts.get(y, 1)) for y in model.labels], float)
        model.shift = np.log(true / true.sum()) - np.log(here / here.sum())
    return model
