"""Periodic runs against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from onomast.llm import tandem
from onomast.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute_runs(words, least=6, periods=4):
    """All maximal stretches by trying every period; of one stretch the smallest period counts."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes, best = np.array([numbers[w] for w in words], np.int64), {}
    for q in range(1, len(words) // periods + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(least, periods * q):
                best.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
    return (doc_id, len(runs), *best, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert len(rows) == len(docs) and sum(r[1] for r in rows.values()) > 10
    for r in docs:
        assert rows[r["doc_id"]] == expected(r["doc_id"], r["text"])


def test_runs_of_small_alphabets():
    rng = random.Random(1)
    for _ in range(600):
        texts = [[bytes([97 + rng.randrange(n)]) for _ in range(rng.randrange(40))] for n in rng.choices([1, 2, 3, 5], k=3)]
        for words, found in zip(texts, tandem.texts_runs(texts, 2, 2)):
            assert list(zip(*found[6:9])) == brute_runs(words, 2, 2)


def test_nested_and_overlapping_runs():
    words = "a a a a a a b a a a a a a b a a a a a a b a a a a a a b".encode().split()
    (found,) = tandem.texts_runs([words], 6, 4)
    assert list(zip(*found[6:9])) == brute_runs(words) == [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]
    assert found[2:6] == (0, 28, 7, 4000) and found[10] == hashlib.sha256(b"a b").hexdigest()


def test_lookups_in_pieces(monkeypatch):
    rng = random.Random(2)
    words = [rng.choice([b"x", b"y"]) for _ in range(400)]
    whole = tandem.texts_runs([words], 2, 2)
    monkeypatch.setattr(tandem, "LOOKUPS", 7)
    assert tandem.texts_runs([words], 2, 2) == whole


def test_odd_rows(spark):
    long = "palabra larga " * 200_000
    nbsp = "a b " * 8
    rows = [(1, None), (1, None), (2, ""), (3, " \n\t"), (4, long), (5, "eins " * 7), (5, "eins " * 7), (None, "x y " * 4), (6, nbsp), (7, "uno dos tres")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"r": F.lit("own"), "number": F.lit("own"), "start": F.lit(1)})
    found = docs.select("doc_id", "r", "start", tandem.runs_column(F.col("text")).alias("x")).select("doc_id", "r", "start", "x.n_words", "x.n_runs", "x.run_start", "x.run_length", "x.run_period")
    assert all(r["r"] == "own" for r in found.collect())
    got = sorted(((r["doc_id"], r["n_words"], r["n_runs"], r["run_start"], r["run_length"], r["run_period"]) for r in found.collect()), key=str)
    none = ([], [], [])
    assert got == sorted(
        [(1, 0, 0, *none)] * 2 + [(2, 0, 0, *none), (3, 0, 0, *none), (4, 400_000, 1, [0], [400_000], [2])] + [(5, 7, 1, [0], [7], [1])] * 2
        + [(None, 8, 1, [0], [8], [2]), (6, 8, 1, [0], [8], [1]), (7, 3, 0, *none)], key=str
    )
    empty = docs.limit(0).select(tandem.runs_column(F.col("text"), F.crc32("text")).alias("x"))
    assert empty.collect() == []
    planted = docs.where("doc_id is null").select(tandem.runs_column(F.col("text"), F.lit(None).cast("long")).alias("x")).first()["x"]
    assert planted["n_runs"] == 1
