"""Language of a text by a byte convolutional network, trained in numpy.

Bytes are embedded; filters of several widths run over a window of ``WINDOW`` bytes; each filter keeps its largest response; a
softmax names the language. A text is cut into windows over its whole length (the last is padded); its
prediction comes from the mean log-probability of its windows, weighted by their bytes.

The network is fitted on a sample bounded by ``PER_LABEL`` texts of each label in expectation, chosen by a hash of
the id, with up to ``PER_TEXT`` windows spread evenly over each text. At most ``MOST_LABELS`` labels can be told apart.
Texts that are null, empty or without a letter are ``und`` with score 0. Without training rows every text is ``und``.
Rows that repeat an id are scored alike; rows without an id are trained on or held out by the crc32 of ''.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmart.llm.common import remainder

WINDOW, EMBED, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
PER_LABEL, PER_TEXT, MOST_LABELS, EPOCHS, RATE, SEED = 500, 2, 1000, 6, 0.01, 8


@dataclass
class Network:
    labels: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: list[np.ndarray]  # for each width: width x EMBED x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray


def windows_of(data: bytes) -> np.ndarray:
    """Whole text as rows of ``WINDOW`` bytes, padded with 0."""
    rows = -(-len(data) // WINDOW)
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(rows, WINDOW)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: np.ndarray, labels: list[str], y: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Adam over mini-batches; the gradient of a max-pooled filter flows to the place of its maximum only."""
    rng = np.random.default_rng(SEED)
    params = [rng.normal(0, 0.5, (256, EMBED))] + [rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))), np.zeros(len(labels))]
    params = [p.astype(np.float32) for p in params]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = (1 / np.maximum(1, np.bincount(y, minlength=len(labels)))).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            own = order[at : at + 64]
            x, b, step = rows[own], len(own), step + 1
            embedded, pooled, places = params[0][x], [], []
            for w, f in zip(WIDTHS, params[1:-3]):
                length = WINDOW - w + 1
                patches = np.concatenate([embedded[:, k : k + length] for k in range(w)], axis=2)
                response = (patches.reshape(-1, w * EMBED) @ f.reshape(w * EMBED, FILTERS)).reshape(b, length, FILTERS)
                places.append(response.argmax(axis=1))
                pooled.append(np.take_along_axis(response, places[-1][:, None], 1)[:, 0])
            z = np.concatenate(pooled, axis=1) + params[-3]
            h = np.maximum(z, 0)
            p = _softmax(h @ params[-2] + params[-1])
            p[np.arange(b), y[own]] -= 1
            d = p * (weight[y[own]] / weight[y[own]].sum())[:, None]
            grads = [np.zeros_like(q) for q in params]
            grads[-2], grads[-1] = h.T @ d, d.sum(axis=0)
            dz = (d @ params[-2].T) * (z > 0)
            grads[-3] = dz.sum(axis=0)
            for i, (w, place) in enumerate(zip(WIDTHS, places)):
                own_dz = dz[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(w):
                    byte = x[np.arange(b)[:, None], place + k]
                    grads[1 + i][k] = np.einsum("bfe,bf->ef", params[0][byte], own_dz)
                    np.add.at(grads[0], byte, own_dz[:, :, None] * params[1 + i][k].T[None])
            for q, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(labels, params[0], params[1:-3], params[-3], params[-2], params[-1])


class Scorer:
    """The trained network with its convolutions as look-ups of byte pairs."""

    def __init__(self, net: Network):
        self.net, self.tables = net, []
        for w, f in zip(WIDTHS, net.filters):
            single = [net.embed @ f[k] for k in range(w)]
            self.tables.append([(k, (single[k][:, None] + single[k + 1][None, :]).reshape(65536, FILTERS) if k + 1 < w else single[k]) for k in range(0, w, 2)])

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(rows), 64):
            x = rows[at : at + 64].astype(np.int32)
            pair, pooled = (x[:, :-1] << 8) | x[:, 1:], []
            for w, tables in zip(WIDTHS, self.tables):
                length = WINDOW - w + 1
                response = None
                for k, t in tables:
                    add = t.take((pair if len(t) == 65536 else x)[:, k : k + length], axis=0)
                    response = add if response is None else np.add(response, add, out=response)
                pooled.append(response.max(axis=1))
            z = np.maximum(np.concatenate(pooled, axis=1) + self.net.bias, 0) @ self.net.dense + self.net.offset
            z -= z.max(axis=1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(out)


def _sample(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in rows:
        out = []
        for lang, text in zip(batch["lang"], batch["text"]):
            whole = windows_of(text.encode("utf-8", "surrogatepass"))
            for at in np.unique(np.linspace(0, len(whole) - 1, PER_TEXT).astype(int)):
                out.append((lang, whole[at].tobytes()))
        yield pd.DataFrame(out, columns=["lang", "window"])


def fit(labelled: DataFrame) -> Network | None:
    """Fit on rows ``(doc_id, text, lang)``; None without any."""
    rows = labelled.where("text is not null and lang is not null and text <> ''").select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = dict(rows.groupBy("lang").count().limit(MOST_LABELS + 1).collect())
    if not counts:
        return None
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} languages")
    rates = F.create_map(*(F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, PER_LABEL / n))))
    unit = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1 << 30)) / float(1 << 30)
    found = rows.where(unit < rates[F.col("lang")]).mapInPandas(_sample, "lang string, window binary").collect()
    found = sorted((r.lang, bytes(r.window)) for r in found)
    labels = sorted({lang for lang, _ in found})
    if not labels:
        return None
    x = np.frombuffer(b"".join(w for _, w in found), np.uint8).reshape(-1, WINDOW)
    return train(x, labels, np.array([labels.index(lang) for lang, _ in found]))


def _predict(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model.value) if model.value else None
        for batch in batches:
            pred, score = [], []
            for text in batch.pop("text"):
                if scorer is None or not text or not any(c.isalpha() for c in text):
                    pred.append("und")
                    score.append(0.0)
                    continue
                data = text.encode("utf-8", "surrogatepass")
                total = np.zeros(len(model.value.labels))
                for at in range(0, len(data), 1 << 20):  # bounded memory for very long texts
                    part = data[at : at + (1 << 20)]
                    rows = windows_of(part)
                    size = np.full(len(rows), WINDOW)
                    size[-1] = len(part) - WINDOW * (len(rows) - 1)
                    total += size @ scorer.log_probabilities(rows)
                p = _softmax(total[None] / len(data))[0]
                pred.append(model.value.labels[int(p.argmax())])
                score.append(float(p.max()))
            batch["lang_pred"], batch["score"] = pred, score
            yield batch

    return run


def predict(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``; only the text is an input."""
    slim = docs.select(*keep, F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(net)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInPandas(_predict(model), f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row; a quarter of the ids is held out of the training."""
    held = remainder(F.col("doc_id"), 4) == 2
    net = fit(docs.where(~held))
    return predict(docs.select("doc_id", "text"), net, ["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of ``least`` or more, with all their columns."""
    net = fit(docs.where(remainder(F.col("doc_id"), 4) != 2))
    told = predict(docs.select(F.struct("*").alias("row"), "text"), net, ["row"])
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("row.*")
