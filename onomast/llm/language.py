"""Language of documents that may be written in several.

The model holds, for each language, how often hashed letter trigrams occur. For a document, expectation-maximisation
finds the share of each language in its trigrams; of the nested sets of its strongest languages the one with the best
penalised likelihood is kept, and the language with the largest share in that set is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

BUCKETS = 1 << 15
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str, letters: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams around each letter, in lower case, whatever is no letter being a blank; empty without letters."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[codes]
    codes = np.where(is_letter, codes, np.uint32(32))
    mixed = codes[:-2] * np.uint32(2654435761) + codes[1:-1] * np.uint32(2246822519) + codes[2:] * np.uint32(3266489917)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(2654435761)
    return (mixed[is_letter[1:-1]] >> np.uint32(17)).astype(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters, counts = letter_table(), {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            if text:
                found = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found += np.bincount(trigrams(text, letters), minlength=BUCKETS)
    for lang, found in counts.items():
        at = np.flatnonzero(found)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": found[at]})


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, by code point, and their log probabilities of buckets, from all rows (text, lang) with a language.

    Tasks count; sums of counts are shuffled. The driver gets at most 32,768 numbers for each language.
    """
    counts = labelled.where("lang is not null").select("lang", "text").mapInPandas(_count, "lang string, bucket long, n long")
    sums = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(sums["lang"]))
    table = np.zeros((BUCKETS, len(langs)))
    if langs:
        table[sums["bucket"].to_numpy(), sums["lang"].map(langs.index).to_numpy()] = sums["n"]
    smoothed = table + 0.5
    return langs, np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32)


def mixtures(grams: list[np.ndarray], model: np.ndarray, rounds: int = 12, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its share in the chosen set, for documents given by their buckets (none of them empty).

    Sets of up to ``least`` languages are tried for every document, larger ones, up to all, as long as the last one was the best.
    """
    langs = model.shape[1]
    at, number, sizes = [], [], []
    for g in grams:
        counts = np.bincount(g, minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        at.append(seen), number.append(counts[seen]), sizes.append(len(seen))
    at, n = np.concatenate(at), np.concatenate(number).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    total = np.add.reduceat(n, starts).astype(np.float64)
    logs = model[at]
    peak = logs.max(axis=1, keepdims=True)
    given = np.exp(logs - peak)
    base = np.add.reduceat((n * peak[:, 0]).astype(np.float64), starts)

    def fit(shares: np.ndarray, steps: int) -> np.ndarray:
        for _ in range(steps):
            joint = given * np.repeat(shares, sizes, axis=0)
            joint *= (n / np.maximum(joint.sum(axis=1), 1e-30))[:, None]
            shares = (np.add.reduceat(joint, starts, axis=0) / total[:, None]).astype(np.float32)
        return shares

    def likelihood(shares: np.ndarray) -> np.ndarray:
        inside = np.einsum("gl,gl->g", given, np.repeat(shares, sizes, axis=0))
        return base + np.add.reduceat(n * np.log(np.maximum(inside, 1e-30)).astype(np.float64), starts)

    full = fit(np.full((len(sizes), langs), 1.0 / langs, np.float32), rounds)
    order, docs = np.argsort(-full, axis=1, kind="stable"), np.arange(len(sizes))
    best, lang, share = np.full(len(sizes), -np.inf), order[:, 0].copy(), np.ones(len(sizes))
    allowed = np.zeros_like(full)
    for k in range(langs):
        if k >= least:
            # Only documents that the last language made better go on, by themselves.
            if not better.any():
                break
            if not better.all():
                rows = np.repeat(better, sizes)
                given, n, sizes = given[rows], n[rows], [size for size, more in zip(sizes, better) if more]
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                docs, total, base, full, order, allowed = (x[better] for x in (docs, total, base, full, order, allowed))
        allowed[np.arange(len(docs)), order[:, k]] = 1
        shares = full * allowed + 1e-6 * allowed
        shares = fit((shares / shares.sum(axis=1, keepdims=True)).astype(np.float32), rounds // 2 if k else 0)
        # Each letter is in three trigrams, so a third of the log-likelihood counts; each further language costs two numbers.
        value = likelihood(shares) / 3 - k * np.log(np.maximum(total / 3, 2.0))
        better = value > best[docs]
        found = docs[better]
        best[found], lang[found], share[found] = value[better], shares.argmax(axis=1)[better], shares.max(axis=1)[better]
    return lang, share


def predict(texts: pd.Series, langs: list[str], model: np.ndarray, letters: np.ndarray, together: int = 1 << 18) -> pd.DataFrame:
    """Language and score of each text; texts are worked on in runs of about ``together`` characters."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    grams, rows, held = [], [], 0

    def flush() -> None:
        if rows:
            lang, share = mixtures(grams, model)
            for row, l, s in zip(rows, lang, share):
                names[row], scores[row] = langs[l], float(min(max(s, 0.0), 1.0))
            grams.clear(), rows.clear()

    for row, text in enumerate(texts):
        found = trigrams(text, letters) if text and langs else ()
        if len(found):
            grams.append(found), rows.append(row)
            held += len(found)
            if held > together:
                flush()
                held = 0
    flush()
    return pd.DataFrame({"lang": names, "score": scores})


def lettered(text: Column) -> Column:
    """Whether a text has a letter; false for null."""

    @F.pandas_udf("boolean")
    def has_letter(texts: pd.Series) -> pd.Series:
        return pd.Series([any(map(str.isalpha, t or "")) for t in texts], dtype=bool)

    return has_letter(text)


def language_column(text: Column, langs: list[str], model: np.ndarray) -> Column:
    """Struct of ``lang`` and ``score``: ``und`` and 0 for null, for texts without a letter, and if nothing was learnt."""

    @F.pandas_udf("lang string, score double")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for texts in batches:
            yield predict(texts, langs, model, letters)

    # Marked so that a plan which filters by the result does not work it out twice.
    return identify.asNondeterministic()(text)
