"""A filter of the keys that a large table may have, small enough to be sent to every task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage

#: Bits of a block of the filter, bits for each key and bits that a key sets, and blocks at most (16 MB).
BLOCK_BITS, KEY_BITS, PROBES, MAX_BLOCKS = 32_768, 12, 4, 4_096

_BLOCK, _BITS, _HASH = "_block", "_bits", "_hash"


def _block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _position(hash: Column, probe: int) -> Column:
    """One of the places of a key in its block: fifteen bits of its hash."""
    return F.shiftrightunsigned(hash, 15 * probe).bitwiseAND(BLOCK_BITS - 1)


def key_filter(keys: DataFrame, key: Column, number: int) -> tuple[DataFrame, int]:
    """A Bloom filter of about ``number`` keys in blocks, as a table of bitmaps, and how many blocks it has.

    It is aggregated in the cluster; a block has the bits of its own keys only. With 12 bits a key, about one key in seventy that was
    not put in passes. From ten million keys on, blocks fill up and more pass.
    """
    blocks = max(1, min(MAX_BLOCKS, math.ceil(number * KEY_BITS / BLOCK_BITS)))
    hashed = keys.where(key.isNotNull()).select(_block_of(key, blocks).alias(_BLOCK), F.xxhash64(key).alias(_HASH))
    places = hashed.select(_BLOCK, F.explode(F.array(*[_position(F.col(_HASH), i) for i in range(PROBES)])).alias("at"))
    return stage(places.groupBy(_BLOCK).agg(F.bitmap_construct_agg("at").alias(_BITS)), "filter"), blocks


def possible_rows(df: DataFrame, key: Column, filter: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and few others. No row is moved."""
    bits = filter.select(F.col(_BLOCK).alias("_of"), _BITS)

    def is_set(probe: int) -> Column:
        at = _position(F.col(_HASH), probe)
        byte = F.conv(F.hex(F.substring(F.col(_BITS), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1

    columns = df.columns
    # At most MAX_BLOCKS rows of 4 kB.
    rows = df.withColumns({_BLOCK: _block_of(key, blocks), _HASH: F.xxhash64(key)}).where(key.isNotNull())
    rows = rows.join(F.broadcast(bits), F.col(_BLOCK) == F.col("_of"))
    for probe in range(PROBES):
        rows = rows.where(is_set(probe))
    return rows.select(*columns)
