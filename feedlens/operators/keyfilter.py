"""A Bloom filter of dictionary keys, built and probed with built-in functions.

The filter is blocked: a key's hash names one block of 32,768 bits, and a second hash gives
``PROBES`` positions in it. ``bitmap_construct_agg`` builds the blocks (with map-side partial
bitmaps, so a repeated key costs nothing), each is kept as 512 longs, and the blocks are
broadcast when their measured size is within bounds. Probing is one broadcast hash join on
the block number and ``PROBES`` bit tests, in the same generated code as the tokenizing.

A key that was put in always passes; another passes with a chance of well under 1 % at
``BITS_PER_KEY`` bits a key. So the filter only drops what cannot match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens import config

BLOCK_BITS = 32_768  # fixed by the bitmap functions
BITS_PER_KEY, PROBES = 16, 4
BLOCK_BYTES = BLOCK_BITS // 8 + 64


@dataclass(frozen=True)
class KeyFilter:
    """``blocks``: ``(block, longs)``, at most ``n_blocks`` rows."""

    blocks: DataFrame
    n_blocks: int

    @property
    def approx_bytes(self) -> int:
        return self.n_blocks * BLOCK_BYTES


def blocks_for(rows: int) -> int:
    return max(1, -(-rows * BITS_PER_KEY // BLOCK_BITS))


def fits(rows: int, max_bytes: int | None = None) -> bool:
    """Whether the filter of ``rows`` keys may be broadcast."""
    return blocks_for(rows) * BLOCK_BYTES <= (config.MAX_BROADCAST_FILTER_BYTES if max_bytes is None else max_bytes)


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _positions(key: Column) -> list[Column]:
    second = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(second, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for k in range(PROBES)]


def build(keys: DataFrame, key: str, rows: int) -> KeyFilter:
    """The filter of column ``key`` of ``keys``, which has ``rows`` rows (repeats may count)."""
    n = blocks_for(rows)
    bits = keys.select(_block(F.col(key), n).alias("block"), F.explode(F.array(*(p.cast("bigint") for p in _positions(F.col(key))))).alias("position"))
    bitmaps = bits.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits"))
    word = lambda k: F.conv(F.hex(F.substring("bits", k * 8 + 1, F.lit(8))), 16, -10).cast("bigint")  # noqa: E731  big-endian, signed
    longs = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), word)
    return KeyFilter(bitmaps.select("block", longs.alias("longs")), n)


def _bit(longs: Column, position: Column) -> Column:
    """Bit ``position % 8`` of byte ``position / 8`` of the bitmap."""
    byte_in_long = F.shiftright(position, 3).bitwiseAND(F.lit(7))
    shift = (F.lit(7) - byte_in_long) * 8 + position.bitwiseAND(F.lit(7))
    return F.getbit(F.get(longs, F.shiftright(position, 6)), shift) == 1


def passing(rows: DataFrame, key: str, keys: KeyFilter) -> DataFrame:
    """The rows whose ``key`` may be one of ``keys``; nothing moves but the broadcast."""
    joined = rows.withColumn("_block", _block(F.col(key), keys.n_blocks)).join(
        F.broadcast(keys.blocks.select(F.col("block").alias("_block"), F.col("longs").alias("_longs"))), "_block"
    )
    test = F.lit(True)
    for position in _positions(F.col(key)):
        test = test & _bit(F.col("_longs"), position)
    return joined.where(test).select(*rows.columns)
