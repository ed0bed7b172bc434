"""A filter of bounded size for 64-bit keys: it passes all keys that it was made of, and few others.

For rows that are too many to move or to send to every executor. What passes is compared exactly afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import arrowtext as at

#: A key marks bits of one block of 4 KB.
BLOCK_BITS = 15
#: 32 MB: 8 bits for each of 33 million keys. Beyond that more other keys pass, and no key is lost.
MOST_BLOCKS = 1 << 13
KEY_BITS = 16
MARKS = 4


def _bits(keys: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of its block that each key marks."""
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    step = (keys >> np.uint64(BLOCK_BITS)) & mask | np.uint64(1)
    for i in range(MARKS):
        yield ((keys + np.uint64(i) * step) & mask).astype(np.int64)


def _marked(batches):
    """(block, bits) of rows (block, key) that are sorted by block."""

    def out():
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

    block, bits = None, np.zeros(1 << BLOCK_BITS, bool)
    for batch in batches:
        of, keys = batch.column("block").to_numpy(), batch.column("key").to_numpy().view(np.uint64)
        edge = np.flatnonzero(np.diff(of, prepend=-1))
        for low, high in zip(edge, np.append(edge[1:], len(of)), strict=True):
            if of[low] != block:
                if block is not None:
                    yield out()
                block, bits = of[low], np.zeros(1 << BLOCK_BITS, bool)
            for places in _bits(keys[low:high]):
                bits[places] = True
    if block is not None:
        yield out()


def made(keys: DataFrame, n: int) -> np.ndarray:
    """The filter of ``keys`` (key bigint, well mixed), ``n`` or so: its blocks, one after another.

    The keys of a block come together in a task; only the blocks reach the driver.
    """
    blocks = 1
    while blocks < MOST_BLOCKS and n * KEY_BITS > blocks << BLOCK_BITS:
        blocks *= 2
    of = F.shiftright("key", 48).bitwiseAND(F.lit(blocks - 1)).cast("int")
    rows = keys.select(of.alias("block"), "key").repartition("block").sortWithinPartitions("block")
    bits = np.zeros((blocks, 1 << (BLOCK_BITS - 3)), np.uint8)
    for x in rows.mapInArrow(at.tidied(_marked), "block int, bits binary").collect():
        bits[x.block] = np.frombuffer(x.bits, np.uint8)
    return bits


def passing(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` (unsigned) the filter passes."""
    block = ((keys >> np.uint64(48)) & np.uint64(len(bits) - 1)).astype(np.int64)
    ok = np.ones(len(keys), bool)
    for places in _bits(keys):
        ok &= (bits[block, places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
    return ok
