"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words in lower case and their first 4, 5 and 6 letters, hashed to ``2 ** BITS`` places; each counts once
a window. The machine adds linear weights and, by factors of ``RANK`` numbers a term, the interaction of every pair of terms
in the window, so it can learn that an insult with a mention of a group weighs more than both. A text is cut over its
whole length into windows of ``2 * STEP`` words, one every ``STEP`` words, so two words at most ``STEP`` apart meet in one; its most
toxic window decides: the score is the largest of them, so long clean parts do not water an insult down.

It is fitted by AdaGrad in numpy on a sample of labelled texts chosen by a hash of the id: ``PER_CLASS`` of each class in expectation, and in that
order only texts whose terms fit in ``MOST_PLACES`` places together (256 MB), so one very long text cannot fill the driver. As no
label says which window is toxic, the first ``WHOLE`` passes learn a text's label for all its windows with equal weights; every further pass halves the
share that is learned, the most toxic windows first, down to one. A fifth of the sample is not learned but sets slope and offset of
the logistic that turns a text's largest margin into its score, with equal weight for either class. Empty texts and nulls have no terms and score by
the offset alone. Without labels of both classes all scores are 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.llm.common import remainder, written

BITS, RANK, STEP = 18, 8, 32
PER_CLASS, MOST_PLACES, BATCH, EPOCHS, WHOLE, RATE, DECAY, SEED = 2500, 1 << 26, 32, 12, 2, 0.3, 1e-4, 1
MASK = (1 << BITS) - 1
#: words that are scored together, a multiple of STEP
LONGEST = STEP << 10
WORD = re.compile(r"[^\W\d_]+")


class Terms(dict):
    """Places of the terms of a word, remembered within the task."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= 1 << 18:
            self.clear()
        forms = [word, *(f"{word[:k]}*" for k in (4, 5, 6) if len(word) >= k)]
        value = self[word] = tuple(zlib.crc32(f.encode("utf-8", "surrogatepass")) & MASK for f in forms)
        return value


def windows(text: str | None, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """Places of all terms window after window, and where each window begins. There is one window at least."""
    words = WORD.findall(text.lower()) if text else []
    parts: list[set[int]] = []
    for at in range(0, len(words), STEP):
        own: set[int] = set()
        own.update(*map(terms.__getitem__, words[at : at + STEP]))
        parts.append(own)
    out, starts = [], []
    for k in range(max(1, len(parts) - 1)):  # a window is two parts
        starts.append(len(out))
        out.extend(set().union(*parts[k : k + 2]))
    return np.array(out, np.int32), np.array(starts, np.int64)


class Machine:
    def __init__(self, rng: np.random.Generator):
        self.offset = np.zeros(1, np.float32)
        self.linear = np.zeros(1 << BITS, np.float32)
        self.slope, self.shift = 1.0, 0.0
        self.columns: np.ndarray | None = None  # made by the first score, when nothing is learned any more
        self.factors = rng.normal(0, 0.01, (1 << BITS, RANK)).astype(np.float32)

    def margins(self, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One number for each window; a window without terms has the offset. Values are scaled to unit length."""
        sizes = np.diff(np.append(starts, len(places)))
        full = sizes > 0
        out = np.full(len(starts), self.offset[0], np.float32)
        if full.any():
            at, n = starts[full], sizes[full].astype(np.float32)
            v = self.factors[places]
            sums = np.add.reduceat(v, at, axis=0)
            squares = np.add.reduceat((v * v).sum(axis=1), at)
            out[full] += np.add.reduceat(self.linear[places], at) / np.sqrt(n) + 0.5 * ((sums * sums).sum(axis=1) - squares) / n
        return out

    def largest(self, text: str | None, terms: Terms) -> float:
        """The largest of the margins of a text's windows, from sums over its parts of ``STEP`` words.

        A window's sums are those of its two parts less those of the terms that both parts hold. Words go through in
        blocks that begin with the last part of the block before, so memory does not grow with the text.
        """
        words = WORD.findall(text.lower()) if text else []
        best = -np.inf
        for at in range(0, max(1, len(words) - STEP), LONGEST):
            own = list(map(terms.__getitem__, words[at : at + LONGEST + STEP]))
            flat = np.fromiter(chain.from_iterable(own), np.int64)
            part = np.repeat(np.arange(len(own)) // STEP, np.fromiter(map(len, own), np.int64, len(own)))
            keys = np.unique((part << BITS) | flat)
            parts = max(1, -(-len(own) // STEP))
            sums = self._sums(keys, parts)
            if parts > 1:
                twice = keys[np.isin(keys + (1 << BITS), keys, assume_unique=True)]
                sums = sums[:-1] + sums[1:] - self._sums(twice, parts)[:-1]
            n = np.maximum(sums[:, 0], 1)
            margins = self.offset[0] + sums[:, 1] / np.sqrt(n) + 0.5 * ((sums[:, 3:] ** 2).sum(axis=1) - sums[:, 2]) / n
            best = max(best, float(margins.max()))
        return best

    def _sums(self, keys: np.ndarray, parts: int) -> np.ndarray:
        """Of the terms of each part, given as sorted ``part << BITS | place``: number, weights, squares and factors summed."""
        if self.columns is None:
            squares = (self.factors * self.factors).sum(axis=1)
            self.columns = np.column_stack([np.ones_like(self.linear), self.linear, squares, self.factors]).astype(np.float64)
        out = np.zeros((parts, 3 + RANK))
        if len(keys):
            part = keys >> BITS
            first = np.flatnonzero(np.diff(part, prepend=-1))
            out[part[first]] = np.add.reduceat(self.columns[keys & MASK], first, axis=0)
        return out

    def score(self, text: str | None, terms: Terms) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.largest(text, terms) + self.shift, -30, 30))))


def calibrate(fm: Machine, margins: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression of the label on the largest margin by damped Newton steps."""
    if len(set(y.tolist())) < 2:
        return
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    x, theta = np.stack([margins, np.ones_like(margins)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - 0.5 * np.linalg.solve(hessian, x.T @ (weight * (p - y)) + 1e-3 * (theta - [1.0, 0.0]))
    if theta[0] > 0:
        fm.slope, fm.shift = map(float, theta)


def _picked(fm: Machine, text: tuple[np.ndarray, np.ndarray], share: float) -> tuple[list[np.ndarray], float]:
    """The most toxic windows of a text, a share of them but one at least, and the weight of each."""
    places, starts = text
    count = max(1, int(len(starts) * share))
    top = range(count) if count == len(starts) else np.argpartition(-fm.margins(places, starts), count - 1)[:count]
    ends = np.append(starts[1:], len(places))
    return [places[starts[k] : ends[k]] for k in top], 1 / count


def train(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS) -> Machine:
    rng = np.random.default_rng(SEED)
    fm = Machine(rng)
    everything = rng.permutation(len(texts))
    kept, learned = everything[: len(texts) // 5], everything[len(texts) // 5 :]
    seen_w, seen_v, seen_b = np.full(1 << BITS, 1e-6, np.float32), np.full((1 << BITS, RANK), 1e-6, np.float32), 1e-6
    for epoch in range(epochs):
        share = 0.5 ** max(0, epoch - WHOLE + 1)
        order = rng.permutation(learned)
        for part in np.array_split(order, max(1, len(order) // BATCH)):
            chosen, label, weight = [], [], []
            for i in part:
                own, each = _picked(fm, texts[i], share)
                chosen += own
                label += [y[i]] * len(own)
                weight += [each] * len(own)
            label, sizes = np.array(label, np.float32), np.array([len(c) for c in chosen])
            flat, starts = np.concatenate(chosen), np.append(0, np.cumsum(sizes)[:-1])
            p = 1 / (1 + np.exp(-np.clip(fm.margins(flat, starts), -30, 30)))
            d = (p - label) * np.array(weight, np.float32) / len(part)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            n = np.maximum(sizes, 1).astype(np.float32)
            v = fm.factors[flat]
            sums = np.stack([np.bincount(owner, column, len(sizes)) for column in v.T], axis=1).astype(np.float32)
            gw, gv = d[owner] / np.sqrt(n[owner]), (d / n)[owner][:, None] * (sums[owner] - v)
            used, inverse = np.unique(flat, return_inverse=True)
            dw = np.bincount(inverse, gw, len(used)).astype(np.float32) + DECAY * fm.linear[used]
            dv = np.stack([np.bincount(inverse, column, len(used)) for column in gv.T], axis=1).astype(np.float32) + DECAY * fm.factors[used]
            seen_w[used] += dw * dw
            seen_v[used] += dv * dv
            fm.linear[used] -= RATE * dw / np.sqrt(seen_w[used])
            fm.factors[used] -= 0.2 * RATE * dv / np.sqrt(seen_v[used])
            seen_b += float(d.sum()) ** 2
            fm.offset -= RATE * float(d.sum()) / np.sqrt(seen_b)
    calibrate(fm, np.array([float(fm.margins(*texts[i]).max()) for i in kept]), y[kept])
    return fm


FEATURED = "doc_id long, toxic int, turn long, places binary, starts binary"


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    terms = Terms()
    for batch in batches:
        rows = [windows(text, terms) for text in batch["text"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "turn": batch["turn"], "places": [p.tobytes() for p, _ in rows], "starts": [s.tobytes() for _, s in rows]})


def fit(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """Fit on the labelled rows whose remainder is not 0; None without both classes."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(remainder(F.col("doc_id"), 5) != 0)
    counts = dict(known.groupBy("toxic").count().collect())
    if len(counts) < 2:
        return None
    unit = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("toxic") == 1, min(1.0, PER_CLASS / counts[1])).otherwise(min(1.0, PER_CLASS / counts[0]))
    # at most about twice PER_CLASS rows of 20 bytes, so the plan may send them to all tasks
    chosen = known.where(unit < rate).withColumn("turn", F.xxhash64(F.lit(SEED + 1), "doc_id"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows, room = [], MOST_PLACES
    for r in written(found.mapInPandas(_featured, FEATURED), "features").orderBy("turn", "doc_id", "starts", "places").toLocalIterator():
        if len(r.places) // 4 <= room:
            room -= len(r.places) // 4
            rows.append((r.toxic, np.frombuffer(r.places, np.int32), np.frombuffer(r.starts, np.int64)))
    if len({r[0] for r in rows}) < 2:
        return None
    return train([(p, s) for _, p, s in rows], np.array([y for y, _, _ in rows]))


def _score(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fm, terms = model.value, Terms()
        for batch in batches:
            score = np.zeros(len(batch))
            for k, text in enumerate(batch.pop("text") if fm else []):
                score[k] = fm.score(text, terms)
            batch["score"] = score
            yield batch[["doc_id", "score"]]

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; a fifth of the ids is held out of the training."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = slim.mapInPandas(_score(model), "doc_id long, score double")
    return out.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
