"""Quality of documents by a small convolutional network over bytes, in numpy.

A byte has four learnt numbers. Filters eight bytes wide move over the whole document in steps of four; the document is
covered by chunks of 512 bytes that overlap by half, each of which keeps every filter's maximum. The mean and the
maximum over the chunks go through a hidden layer to one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, ship

ship(__name__)

STEP, HALF, DEPTH, FILTERS, HIDDEN = 4, 256, 4, 32, 16
#: Bytes that go through the filters at a time, whole half chunks.
PIECE = 1_024 * HALF
#: Bound of the labelled sample, and of the chunks that a document of it gives, spread over its whole text.
TRAIN_ROWS, TRAIN_CHUNKS, STEPS, BATCH, RATE = 3_000, 4, 1_200, 32, 4e-3


def padded(text: str) -> np.ndarray:
    """The text's bytes with zeros up to whole half chunks, two of them at least."""
    data = text.encode("utf-8", "surrogatepass")
    halves = max(2, -(-len(data) // HALF))
    return np.frombuffer(data.ljust(halves * HALF, b"\0"), np.uint8)


def filtered(data: np.ndarray, model: dict) -> np.ndarray:
    """Filter values at every place, one row per step; the last place sees the padding."""
    places = model["embed"][data].reshape(-1, STEP * DEPTH)
    out = places @ model["first"]
    out[:-1] += places[1:] @ model["second"]
    return out


def half_maxima(data: np.ndarray, model: dict) -> np.ndarray:
    """Each filter's maximum over each half chunk; a long text goes through the filters piece by piece."""
    halves = []
    for low in range(0, len(data), PIECE):
        # The last place of a piece sees the first of the next one.
        values = filtered(data[low : low + PIECE + STEP], model)[: min(PIECE, len(data) - low) // STEP]
        halves.append(values.reshape(-1, HALF // STEP, FILTERS).max(axis=1))
    return np.concatenate(halves)


def probability(text: str, model: dict) -> float:
    halves = half_maxima(padded(text), model)
    chunks = np.maximum(np.maximum(halves[:-1], halves[1:]) + model["bias"], 0)
    pooled = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])
    hidden = np.maximum(pooled @ model["hidden"] + model["hidden_bias"], 0)
    return float(1 / (1 + np.exp(-np.clip(hidden @ model["out"] + model["out_bias"], -30, 30))[0]))


def _forward_back(model: dict, data: np.ndarray, owner: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict:
    """Gradients of the weighted log loss; ``data`` holds chunks, ``owner`` the document of each, in order."""
    n, places = len(data), 2 * HALF // STEP
    embedded = model["embed"][data].reshape(n, places, STEP * DEPTH)
    values = embedded @ model["first"]
    values[:, :-1] += embedded[:, 1:] @ model["second"]
    best = values.argmax(axis=1)
    raw = np.take_along_axis(values, best[:, None], axis=1)[:, 0] + model["bias"]
    chunks = np.maximum(raw, 0)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    sizes = np.diff(np.append(starts, n))
    mean, most = np.add.reduceat(chunks, starts) / sizes[:, None], np.maximum.reduceat(chunks, starts)
    pooled = np.concatenate([mean, most], axis=1)
    before = pooled @ model["hidden"] + model["hidden_bias"]
    hidden = np.maximum(before, 0)
    guess = 1 / (1 + np.exp(-np.clip(hidden @ model["out"] + model["out_bias"], -30, 30)))
    off = ((guess[:, 0] - labels) * weight / len(labels))[:, None]
    into = (off @ model["out"].T) * (before > 0)
    back = into @ model["hidden"].T
    spread = back[:, :FILTERS] / sizes[:, None]
    g = np.repeat(spread, sizes, axis=0)
    full = np.repeat(most, sizes, axis=0)
    tied = chunks == full
    share = np.repeat(back[:, FILTERS:] / np.maximum(np.add.reduceat(tied, starts), 1), sizes, axis=0)
    g = ((g + tied * share) * (raw > 0)).astype(np.float32)
    rows = np.arange(n)[:, None]
    here = embedded[rows, best]
    there = np.where((best < places - 1)[..., None], embedded[rows, np.minimum(best + 1, places - 1)], 0)
    grads = {
        "first": np.einsum("nfk,nf->kf", here, g),
        "second": np.einsum("nfk,nf->kf", there, g),
        "bias": g.sum(axis=0),
        "hidden": pooled.T @ into,
        "hidden_bias": into.sum(axis=0),
        "out": hidden.T @ off,
        "out_bias": off.sum(axis=0),
    }
    embed = np.zeros_like(model["embed"])
    at = data.reshape(n, places, STEP)
    np.add.at(embed, at[rows, best], (g[..., None] * model["first"].T).reshape(n, FILTERS, STEP, DEPTH))
    inner = g * (best < places - 1)
    np.add.at(embed, at[rows, np.minimum(best + 1, places - 1)], (inner[..., None] * model["second"].T).reshape(n, FILTERS, STEP, DEPTH))
    return grads | {"embed": embed}


def train(chunks: list[list[bytes]], labels: list[int], steps: int = STEPS) -> dict:
    """Parameters learnt from documents given by some of their chunks. Without labels of both kinds, the score is the share of ones."""
    rng = np.random.default_rng(7)
    y = np.array(labels, np.float32)
    share = float(y.mean()) if len(y) else 0.5
    normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    model = {
        "embed": rng.normal(0, 1, (256, DEPTH)).astype(np.float32),
        "first": normal(STEP * DEPTH, FILTERS),
        "second": normal(STEP * DEPTH, FILTERS),
        "bias": np.zeros(FILTERS, np.float32),
        "hidden": normal(2 * FILTERS, HIDDEN),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN, 1),
        "out_bias": np.array([np.log((share + 1e-3) / (1 - share + 1e-3))], np.float32),
    }
    if share in (0.0, 1.0) or not len(y):
        return model | {"out": np.zeros((HIDDEN, 1), np.float32)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    arrays = [np.stack([np.frombuffer(c, np.uint8) for c in doc]) for doc in chunks]
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        while len(order) < BATCH:
            order = np.append(order, rng.permutation(len(y)))
        some, order = order[:BATCH], order[BATCH:]
        owner = np.repeat(np.arange(len(some)), [len(arrays[i]) for i in some])
        grads = _forward_back(model, np.concatenate([arrays[i] for i in some]), owner, y[some], np.ones(len(some), np.float32))
        rate = RATE * (1 - step / (steps + 1))
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            model[k] = (model[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def _some_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        picked = []
        for text in batch["text"]:
            data = padded(text or "")
            last = len(data) // HALF - 2
            at = np.unique(np.linspace(0, last, min(TRAIN_CHUNKS, last + 1)).round().astype(int))
            picked.append([data[a * HALF : (a + 2) * HALF].tobytes() for a in at])
        yield pd.DataFrame({"label": batch["label"], "chunks": pd.Series(picked, dtype=object, index=batch.index)})


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> dict:
    """A network from at most ``rows`` labelled documents that are not held out, drawn by the hash of their id.

    The driver gets at most ``rows`` times 2 KiB of chunks. A document labelled twice counts with the lower label.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    drawn = known.groupBy("doc_id").agg(F.min(label).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    sample = found.mapInPandas(_some_chunks, "label int, chunks array<binary>").toPandas()
    order = sorted(range(len(sample)), key=lambda i: (b"".join(sample["chunks"][i]), sample["label"][i]))
    return train([list(sample["chunks"][i]) for i in order], [int(sample["label"][i]) for i in order])


def score_column(text: Column, model: dict) -> Column:
    """Probability of label 1 for every text; a null text is scored as an empty one."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([probability(t or "", model) for t in texts], dtype="float64")

    return score(text)
