"""Packing by concatenation: documents end to end, cut into windows of equal length.

The first pass tokenises each document once and writes its ids with the tokens before it in its own partition. The
second adds the tokens of earlier partitions (one number per partition, summed as a prefix) and cuts every document at
the window limits of the global stream. No rows are shuffled; only the last window can be short.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from .common import arrow_batches, ship

ship(__name__)

# Fixed value: how a byte-level tokenizer file with ``use_regex`` splits a text before merging.
PRETOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def byte_alphabet() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the others from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_ranks(file: dict) -> dict[bytes, int] | None:
    """Ranks by which the merges of a plain byte-level BPE file can be run, or None for another kind of file.

    A token's rank is its id: ids rise with the merges, and every token is a byte or the result of a merge.
    """
    model, split = file["model"], file["pre_tokenizer"] or {}
    plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    unusual = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or file["normalizer"] or any(model.get(name) for name in unusual):
        return None
    alphabet, vocabulary = byte_alphabet(), model["vocab"]
    made = [vocabulary["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    if made != sorted(set(made)) or len(made) + 256 != len(vocabulary) or not all(c in alphabet for token in vocabulary for c in token):
        return None
    return {bytes(alphabet[c] for c in token): number for token, number in vocabulary.items()}


class Encoder:
    """Ids of texts by a tokenizer file, as ``tokenizers`` gives them.

    The merges of a plain byte-level BPE file are run by ``tiktoken``, which gives the same ids in little more than half the time
    (tested on all characters and all tokens). Files of another kind are left to ``tokenizers``, as are texts that hold an added token of
    the file, unless such tokens are read as ``plain`` text.
    """

    def __init__(self, path: str, kind: str, plain: bool = True):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype(kind)
        with open(path, encoding="utf-8") as file:
            ranks = merge_ranks(json.load(file))
        self.fast = ranks and tiktoken.Encoding("file", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[bytes]:
        """By ``tokenizers``."""
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in encoded]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.fast:
            return self.whole(texts)
        out = [b"" if any(a in t for a in self.added) else np.array(self.fast.encode_ordinary(t), self.kind).tobytes() for t in texts]
        left = [i for i, t in enumerate(texts) if t and not out[i]]
        for i, found in zip(left, self.whole([texts[i] for i in left])):
            out[i] = found
        return out


def held_encoder(path: str, kind: str, plain: bool) -> Encoder:
    """An encoder that stays in the Python worker for its next tasks."""
    held = vars(sys.modules.setdefault("_held_encoders", ModuleType("_held_encoders")))
    if (path, kind, plain) not in held:
        held[path, kind, plain] = Encoder(path, kind, plain)
    return held[path, kind, plain]


def _tokenise(batches: Iterator[pd.DataFrame], path: str, kind: str, end_id: int, plain: bool) -> Iterator[pd.DataFrame]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encode, end = held_encoder(path, kind, plain), np.array([end_id], kind).tobytes()
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        for low in range(0, len(batch), 500):
            some = batch.iloc[low : low + 500]
            ids = [found + end for found in encode([t or "" for t in some["_text"]])]
            counts = np.array([len(x) // encode.kind.itemsize for x in ids], np.int64)
            starts = at + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
            at += int(counts.sum())
            yield some.drop(columns="_text").assign(_part=part, _before=starts, doc_tokens=counts, _ids=ids)


def _cut(batches: Iterator[pd.DataFrame], kind: str, window: int, carried: list[str]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for low in range(0, len(batch), 500):
            some = batch.iloc[low : low + 500]
            rows, starts, ends, begins, pieces = [], [], [], [], []
            for row, (ids, begin) in enumerate(zip(some["_ids"], some["_begin"])):
                ids, begin = np.frombuffer(ids, kind).astype("<u4"), int(begin)
                cuts = [0, *range(window - begin % window, len(ids), window), len(ids)]
                for a, b in zip(cuts, cuts[1:]):
                    rows.append(row), starts.append(a), ends.append(b), begins.append(begin + a), pieces.append(ids[a:b].tobytes())
            start, end, begin = np.array(starts, np.int64), np.array(ends, np.int64), np.array(begins, np.int64)
            yield some[[*carried, "doc_tokens", "_total"]].iloc[rows].reset_index(drop=True).assign(
                start=start, length=end - start, sequence_id=begin // window, offset=begin % window, ids=pieces
            )


def pack(
    docs: DataFrame, tokenizer: str, carried: list[str], text: str = "text", window: int = 1024, end_id: int = 0, vocabulary: int = 65_536, plain: bool = True
) -> DataFrame:
    """Pieces of documents in sequences of ``window`` tokens.

    ``tokenizer`` is the path of a byte-level BPE file on every executor. A document is its ids and ``end_id``; a null
    text is empty. The name of an added token such as ``<|endoftext|>`` in a text is read as ``plain`` text, or else as that
    token, which is what the file gives by default. Columns: the ``carried`` ones, doc_tokens, start (its ids before the piece), length, sequence_id,
    offset (place in the sequence), padded (the sequence's length with padding: the window, or its own length if that is a power of two),
    ids (little-endian unsigned 32-bit). An empty table gives an empty one; repeated rows are packed each.
    """
    spark, kind = docs.sparkSession, "<u2" if vocabulary <= 65_536 else "<u4"
    names = {f"_c{i}": c for i, c in enumerate(carried)}
    chosen = docs.select(*[F.col(c).alias(a) for a, c in names.items()], F.col(text).alias("_text"))
    fields = ", ".join(f"{a} {chosen.schema[a].dataType.simpleString()}" for a in names)
    first = chosen.mapInPandas(
        lambda batches: _tokenise(batches, tokenizer, kind, end_id, plain), ", ".join(filter(None, [fields, "_part long, _before long, doc_tokens long, _ids binary"]))
    )
    path = scratch_path(spark, "ids")
    with arrow_batches(spark, 2_000):
        first.write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(first.schema).parquet(path)

    # One number for each task of the first pass: that bounds what is summed in order and broadcast.
    parts = staged.groupBy("_part").agg(F.sum("doc_tokens").alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"), F.sum("_sum").over(Window.partitionBy(F.lit(1))).alias("_total")
    )
    placed = staged.join(F.broadcast(starts), "_part").select(*names, "doc_tokens", "_ids", "_total", (F.col("_start") + F.col("_before")).alias("_begin"))
    pieces = placed.mapInPandas(
        lambda batches: _cut(batches, kind, window, list(names)),
        ", ".join(filter(None, [fields, "doc_tokens long, _total long, start long, length long, sequence_id long, offset long, ids binary"])),
    )
    own = F.least(F.lit(window), F.col("_total") - F.col("sequence_id") * window)
    padded = F.when(own.bitwiseAND(own - 1) == 0, own).otherwise(F.lit(window)).cast("bigint")
    return pieces.select(*[F.col(a).alias(c) for a, c in names.items()], "doc_tokens", "start", "length", "sequence_id", "offset", padded.alias("padded"), "ids")
