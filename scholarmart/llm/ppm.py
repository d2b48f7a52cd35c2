"""Language-model scores by prediction by partial matching over bytes, pretrained on the corpus.

The model is a trie of byte contexts of up to ``ORDER`` bytes. A symbol (a byte, or the end of the text) is predicted in the
longest context that the trie knows; if it was not seen there, the context escapes to the one a byte shorter, from whose counts the
symbols of the longer one are excluded, and so on down to the uniform distribution over the symbols never seen. The
chance to escape is estimated from the number of distinct symbols of the context (method D: each gives half a count to the
escape). Probabilities of all symbols after any text sum to 1.

All training bytes are counted and no run is pruned, so the model grows with the corpus: every task counts runs of
``ORDER + 1`` bytes, Spark sums them, and shorter runs follow from longer ones. The value of a run, the logarithm of the chance of
its last byte, depends on the run alone, so it is worked out once for each distinct run of the table. Contexts of three bytes
and more lie with all their longer ones where the last three bytes of the context are equal; the runs are dealt by those, and a task builds
the tries of its part, at least ``CHUNK`` runs at a time. Shorter contexts are known to all tasks; the alphabet bounds them, not the corpus.

The ``KEPT`` most frequent runs at most have their values at hand where texts are scored; the others of a text are
joined with theirs, and summed. That decides where a value is looked up, not which value it is.

The base counts words exactly over all training texts. Words with a share of at least ``1 / FREQUENT`` (so at most that many) are
scored in the task; all others are joined with their counts.

A null text is an empty one. Rows that repeat an id are scored row by row; rows without an id count as id '' for the split.
Without training rows every symbol has probability 1/256 and the base is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.llm.common import remainder, words_of, written

ORDER, KEPT, FREQUENT = 5, 1 << 20, 1 << 20
NEAR = 3  # bytes of context by which runs are dealt
CHUNK = 1 << 18
PAD, END, SYMBOLS = b"\xff", b"\xfe", 256  # neither byte occurs in UTF-8
PIECE = 1 << 19
COUNTED = 1 << 21
ROWS = 1000  # scored at a time
END_WORD = b""


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text with its end, in pieces that begin with the ``ORDER`` bytes before them."""
    whole = PAD * ORDER + data + END
    for at in range(ORDER, len(whole), PIECE):
        yield whole[at - ORDER : at + PIECE]


def grams(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``ORDER + 1`` bytes as numbers, and where the runs of each piece begin."""
    buffer = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(buffer) - ORDER), np.uint64)
    for k in range(ORDER + 1):
        out <<= np.uint64(8)
        out |= buffer[k : k + len(out)]
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes) - sizes
    keep = np.ones(len(buffer), bool)
    keep[(starts[:, None] + np.arange(ORDER)).reshape(-1)] = False
    return out[keep[ORDER:]], starts - ORDER * np.arange(len(pieces))


def _batched(texts, size: int) -> Iterator[list[tuple[int, bytes]]]:
    """Pieces of texts, with the place of their text, in lists of about ``size`` bytes."""
    own, total = [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text.encode("utf-8", "surrogatepass") if text else b""):
            own.append((i, piece))
            total += len(piece)
            if total >= size:
                yield own
                own, total = [], 0
    if own:
        yield own


def _merged(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts of equal values."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.add.reduceat(counts, first)


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the runs of a task, in all texts and in training texts; what it holds is bounded by ``COUNTED`` different runs
    and one list of pieces for each kind of text."""
    held = {kind: (np.empty(0, np.uint64), np.empty(0, np.int64)) for kind in (False, True)}

    def counted(kind: bool) -> pd.DataFrame:
        values, counts = held[kind]
        held[kind] = values[:0], counts[:0]
        return pd.DataFrame({"gram": values.view(np.int64), "n": counts, "trained": np.zeros_like(counts) if kind else counts})

    for batch in batches:
        for kind in held:
            for own in _batched(batch["text"][batch["held"] == kind], PIECE):
                new, n = np.unique(grams([p for _, p in own])[0], return_counts=True)
                held[kind] = _merged(np.concatenate([held[kind][0], new]), np.concatenate([held[kind][1], n]))
                if len(held[kind][0]) >= COUNTED:
                    yield counted(kind)
    for kind in held:
        if len(held[kind][0]):
            yield counted(kind)


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update(words_of(text))
            counts[END_WORD] += 1
        if len(counts) >= 1 << 20:
            yield pd.DataFrame({"word": list(counts.keys()), "n": list(counts.values())})
            counts.clear()
    if counts:
        yield pd.DataFrame({"word": list(counts.keys()), "n": list(counts.values())})


class Index:
    """Places of sorted numbers: two hash tables, and a binary search for the few that fit in neither."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(4 * len(keys)).bit_length()))
        self.factors = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
        self.tables, left = [], np.arange(len(keys))
        for factor in self.factors:
            slots = np.full(1 << int(64 - int(self.shift)), -1, np.int32)
            at = ((keys[left] * factor) >> self.shift).astype(np.int64)
            slots[at] = left
            held = np.full(len(slots), ~np.uint64(0), np.uint64)
            held[slots >= 0] = keys[slots[slots >= 0]]
            self.tables.append((factor, held, slots))
            left = left[slots[at] != left]
        self.rest, self.rest_at = keys[left], left

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, or -1."""
        factor, held, slots = self.tables[0]
        at = (values * factor) >> self.shift
        out = np.where(held[at] == values, slots[at], -1)
        for factor, held, slots in self.tables[1:]:
            miss = np.flatnonzero(out < 0)
            own = values[miss]
            at = (own * factor) >> self.shift
            out[miss] = np.where(held[at] == own, slots[at], -1)
        if len(self.rest):
            miss = np.flatnonzero(out < 0)
            at = np.minimum(np.searchsorted(self.rest, values[miss]), len(self.rest) - 1)
            out[miss] = np.where(self.rest[at] == values[miss], self.rest_at[at], -1)
        return out


class Trie:
    """Counts of kept runs by length, as logarithms of symbol and escape probabilities.

    ``kept``: for each context length from 0 to ``ORDER`` the runs (context and symbol), their counts, and the counts of all
    symbols, kept or not, after their contexts.
    """

    def __init__(self, kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.runs, self.contexts, self.of_run = [], [], []
        self.count, self.total, self.distinct, self.mass = [], [], [], []
        for runs, n, total in kept:
            order = np.argsort(runs)
            runs, n, total = runs[order], n[order].astype(float), total[order].astype(float)
            contexts, first, owner = np.unique(runs >> np.uint64(8), return_index=True, return_inverse=True)
            self.runs.append(runs)
            self.contexts.append(contexts)
            self.of_run.append(owner)
            self.count.append(n)
            self.total.append(total[first])
            self.distinct.append(np.bincount(owner, minlength=len(contexts)).astype(float))
            self.mass.append(np.bincount(owner, n, minlength=len(contexts)))
        self.run_index, self.context_index = [Index(r) for r in self.runs], [Index(c) for c in self.contexts]
        with np.errstate(divide="ignore"):
            self.log_count = [np.log10(2 * n - 1) for n in self.count]
            self.log_whole = [np.log10(2 * t) for t in self.total]
            self.log_escape = [np.log10(2 * (t - m) + d) - w for t, m, d, w in zip(self.total, self.mass, self.distinct, self.log_whole)]
            # of the shorter context, once the symbols of the longer one are excluded; by the longer one
            self.log_rest, self.log_rest_escape = [None], [None]
            for k in range(1, len(self.runs)):
                shorter = self.run_index[k - 1].find(self.runs[k] & np.uint64((1 << (8 * k)) - 1))  # kept, as its count is no smaller
                excluded = np.bincount(self.of_run[k], self.count[k - 1][shorter], minlength=len(self.contexts[k]))
                parent = self.context_index[k - 1].find(self.contexts[k] & np.uint64((1 << (8 * (k - 1))) - 1))
                fresh = self.distinct[k - 1][parent] - self.distinct[k]
                whole = 2 * (self.total[k - 1][parent] - excluded)
                escape = 2 * (self.total[k - 1][parent] - self.mass[k - 1][parent]) + fresh
                self.log_rest.append(np.log10(whole))
                self.log_rest_escape.append(np.where(whole > 0, np.log10(escape) - np.log10(np.where(whole > 0, whole, 1)), 0.0))

    def log_probabilities(self, values: np.ndarray) -> np.ndarray:
        """Of the last byte of each run of ``ORDER + 1`` bytes, given the ones before it."""
        out = np.zeros(len(values))
        open_, own = np.arange(len(values)), values
        longer = np.full(len(values), -1, np.int64)  # the context whose symbols are excluded
        for k in range(len(self.runs) - 1, -1, -1):
            runs = own & np.uint64((1 << (8 * (k + 1))) - 1)
            at = self.run_index[k].find(runs)
            hit = np.flatnonzero(at >= 0)
            context = self.of_run[k][at[hit]]
            whole = self.log_whole[k][context]
            if k < len(self.runs) - 1:
                after = longer[hit]
                whole = np.where(after >= 0, self.log_rest[k + 1][after], whole)
            out[open_[hit]] += self.log_count[k][at[hit]] - whole
            miss = np.flatnonzero(at < 0)
            open_, own, after = open_[miss], own[miss], longer[miss]
            context = self.context_index[k].find(runs[miss] >> np.uint64(8)).astype(np.int64)
            escape = np.where(context >= 0, self.log_escape[k][context], 0.0) if len(self.contexts[k]) else np.zeros(len(miss))
            if k < len(self.runs) - 1 and len(self.contexts[k + 1]):
                escape = np.where(after >= 0, self.log_rest_escape[k + 1][after], escape)
            out[open_] += escape
            longer = context
        seen = np.where(longer >= 0, self.distinct[0][0] if len(self.distinct[0]) else 0, 0)
        out[open_] -= np.log10(SYMBOLS - seen)
        return out

    def text_scores(self, texts) -> np.ndarray:
        """log10 probability of each text with its end."""
        out = np.zeros(len(texts))
        for own in _batched(texts, PIECE):
            values, starts = grams([p for _, p in own])
            np.add.at(out, [i for i, _ in own], np.add.reduceat(self.log_probabilities(values), starts))
        return out


def _level(runs: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs with a context of ``k`` bytes, from longer ones: counts, and counts of all symbols after their contexts."""
    runs = runs & np.uint64((1 << (8 * (k + 1))) - 1)
    if len(runs):
        runs, n = _merged(runs, n)
    owner = np.unique(runs >> np.uint64(8), return_inverse=True)[1]
    return runs, n, np.bincount(owner, n)[owner] if len(runs) else n


class Values:
    """Values of some runs; the index over them is built where it is used and does not travel."""

    def __init__(self, runs: np.ndarray, values: np.ndarray):
        order = np.argsort(runs)
        self.runs, self.values, self.index = runs[order], values[order], None

    def __getstate__(self):
        return self.__dict__ | {"index": None}

    def text_scores(self, texts) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """log10 probability of each text as far as its runs are here, and its other runs with their numbers."""
        self.index = self.index or Index(self.runs)
        out, rest = np.zeros(len(texts)), []
        for own in _batched(texts, PIECE):
            values, starts = grams([p for _, p in own])
            at, rows = self.index.find(values), np.array([i for i, _ in own])
            known = at >= 0
            chances = np.zeros(len(values))
            chances[known] = self.values[at[known]]
            np.add.at(out, rows, np.add.reduceat(chances, starts))
            if not known.all():
                of_row = np.repeat(rows, np.diff(np.append(starts, len(values)))).astype(np.uint64)
                rest.append(np.unique((of_row << np.uint64(48) | values)[~known], return_counts=True))
        codes, times = _merged(np.concatenate([c for c, _ in rest]), np.concatenate([n for _, n in rest])) if rest else (np.empty(0, np.uint64), np.empty(0, np.int64))
        cuts = np.searchsorted(codes, np.arange(1, len(texts), dtype=np.uint64) << np.uint64(48))
        runs = (codes & np.uint64((1 << 48) - 1)).astype(np.int64)
        return out, np.split(runs, cuts), np.split(times, cuts)


def _value(short):
    """Values of runs that come in the order of ``near``; ``short`` has the counts of the contexts below ``NEAR`` bytes."""

    def valued(part: pd.DataFrame) -> pd.DataFrame:
        runs, trained = part["gram"].to_numpy().astype(np.uint64), part["trained"].to_numpy()
        seen = trained > 0
        trie = Trie(short.value + [_level(runs[seen], trained[seen], k) for k in range(NEAR, ORDER + 1)])
        return pd.DataFrame({"gram": part["gram"], "n": part["n"], "value": trie.log_probabilities(runs)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total, most = [], 0, CHUNK
        for batch in batches:
            held.append(batch)
            total += len(batch)
            if total >= most:
                whole = pd.concat(held, ignore_index=True)
                near = whole["near"].to_numpy()
                at = int(np.searchsorted(near, near[-1]))
                if at:
                    yield valued(whole[:at])
                held = [whole[at:]]
                total = len(whole) - at
                most = max(CHUNK, 2 * total)
        if total:
            yield valued(pd.concat(held, ignore_index=True))

    return run


def run_values(texts: DataFrame) -> DataFrame:
    """``gram, n, value`` of every distinct run of ``texts(text, held)``, by the counts of those that are not held out."""
    counted = texts.mapInPandas(_count_grams, "gram long, n long, trained long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))
    counted = written(counted, "grams")
    low = counted.where("trained > 0").groupBy(F.col("gram").bitwiseAND(F.lit((1 << (8 * NEAR)) - 1)).alias("run")).agg(F.sum("trained").alias("n")).toArrow()
    runs, n = low.column("run").to_numpy().astype(np.uint64), low.column("n").to_numpy()
    short = texts.sparkSession.sparkContext.broadcast([_level(runs, n, k) for k in range(NEAR)])
    near = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << (8 * NEAR)) - 1))
    dealt = counted.withColumn("near", near).repartition("near").sortWithinPartitions("near")
    return written(dealt.mapInPandas(_value(short), "gram long, n long, value double"), "values")


def _least(values: DataFrame) -> int:
    """The smallest count that at most ``KEPT`` runs reach."""
    rows = values.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count("*").alias("runs"), F.sum("n").alias("mass")).toArrow().to_pylist()
    least, reached = None, 0
    for row in sorted(rows, key=lambda r: -r["n"]):
        reached += row["runs"]
        if reached > KEPT:
            break
        least = row["n"]
    return least or sum(r["mass"] for r in rows) // KEPT + 1


def _score(values, frequent, symbols: int, distinct: int):
    denominator = np.log10(symbols + 0.5 * (distinct + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, row = TaskContext.get().partitionId(), 0
        known = {w: (np.log10(c + 0.5) - denominator) for w, c in frequent.value.items()}
        for whole in batches:
            for batch in (whole.iloc[i : i + ROWS] for i in range(0, len(whole), ROWS)):
                rows = []
                for text in batch["text"]:
                    words, base, tail, n_known = Counter(words_of(text)), 0.0, {}, 0
                    words[END_WORD] += 1
                    for word, times in words.items():
                        value = known.get(word)
                        if value is None:
                            tail[word] = times
                        else:
                            base += times * value
                            n_known += times
                    rows.append(((part << 40) + row, words.total(), n_known, base, list(tail.keys()), list(tail.values())))
                    row += 1
                frame = pd.DataFrame(rows, columns=["row", "n_tokens", "n_known", "base_score", "words", "times"])
                frame["doc_id"] = batch["doc_id"].astype("Int64").reset_index(drop=True)
                frame["score"], frame["runs"], frame["run_times"] = values.value.text_scores(batch["text"])
                yield frame

    return run


def scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = remainder(F.col("doc_id"), 5) == 1
    training = slim.where(~held).select("text")
    words = written(training.mapInPandas(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "words")
    symbols, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    common = words.where(F.col("c") * FREQUENT >= symbols).toArrow()
    frequent = spark.sparkContext.broadcast(dict(zip(common.column("word").to_pylist(), common.column("c").to_pylist())))
    values = run_values(slim.select("text", held.alias("held")))
    least = _least(values)
    near = values.where(F.col("n") >= least).select("gram", "value").toArrow()
    near = spark.sparkContext.broadcast(Values(near.column("gram").to_numpy().astype(np.uint64), near.column("value").to_numpy()))

    schema = "row long, doc_id long, n_tokens long, n_known long, base_score double, words array<binary>, times array<long>, score double, runs array<long>, run_times array<long>"
    part = written(slim.mapInPandas(_score(near, frequent, symbols, distinct), schema), "scored")
    tail = part.select("row", F.explode(F.arrays_zip("words", "times")).alias("t")).select("row", F.col("t.words").alias("word"), F.col("t.times").alias("n")).join(words, "word", "left")
    value = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(symbols + 0.5 * (distinct + 1)))
    tail = tail.select("row", (F.col("n") * value).alias("base"), F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"), F.lit(0.0).alias("own"))
    far = values.where(F.col("n") < least).select("gram", "value")
    runs = part.select("row", F.explode(F.arrays_zip("runs", "run_times")).alias("t")).select("row", F.col("t.runs").alias("gram"), F.col("t.run_times").alias("times")).join(far, "gram")
    tail = tail.union(runs.select("row", F.lit(0.0).alias("base"), F.lit(0).alias("known"), (F.col("times") * F.col("value")).alias("own")))
    tail = tail.groupBy("row").agg(F.sum("base").alias("rest"), F.sum("known").alias("rest_known"), F.sum("own").alias("rest_own"))
    out = part.drop("words", "times", "runs", "run_times").join(tail, "row", "left")
    return out.select("doc_id", held.alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"), F.lit(symbols).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("rest_own", F.lit(0.0))).alias("score"))
