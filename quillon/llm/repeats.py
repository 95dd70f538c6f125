"""Bloom filters of hashes seen once and seen twice, built by tasks that ship only the numbers of the bits they mark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillon.llm.common import hand_back

#: Slices of the filters, powers of two: the least, the most, and the marks that one takes, about.
SLICES, MOST_SLICES, SLICE_MARKS = 64, 4096, 1 << 24
#: Bits a hash, and the bounds of a filter's size: at most 32 MB, whatever the input.
BITS_A_HASH, LEAST_BITS, MOST_BITS = 16, 20, 28


def size_for(hashes: int) -> int:
    """Bits of a filter, as a power of two. Beyond MOST_BITS it errs more often towards suspicion, nothing else."""
    return min(MOST_BITS, max(LEAST_BITS, (BITS_A_HASH * hashes).bit_length()))


def slices_for(hashes: int) -> int:
    """Slices that the marks of so many hashes are dealt to: more marks are more tasks."""
    return min(MOST_SLICES, max(SLICES, 1 << (2 * hashes // SLICE_MARKS).bit_length()))


def positions(h: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers: h has a row of 64-bit hashes for each member."""
    return (h & np.uint64((1 << bits) - 1)).astype(np.int64)


def _slices(numbers: list[np.ndarray], bits: int, slices: int) -> pa.RecordBatch:
    number, times = np.unique(np.concatenate(numbers), return_counts=True)
    rows, width = [], bits - slices.bit_length() + 1
    cut = np.searchsorted(number, np.arange(slices + 1) << width)
    for k in range(slices):
        n, t = number[cut[k] : cut[k + 1]] - (k << width), times[cut[k] : cut[k + 1]]
        if len(n):
            rows.append((k, np.diff(n, prepend=0).astype("<u4").tobytes(), np.packbits(t > 1).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["slice", "gaps", "twice"])


def marks(extract: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, slices: int = SLICES, most: int = 1_000_000):
    """mapInArrow: for each slice of the filters, the numbers of the bits marked in this task, and which of them twice.

    extract gives, for each document of a batch, the hashes of its distinct members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for h in extract(b):
                if len(h):
                    held.append(np.unique(positions(h, bits).ravel()))
                    n += len(held[-1])
                if n > most:
                    yield _slices(held, bits, slices)
                    held, n = [], 0
        if held:
            yield _slices(held, bits, slices)
        held.clear()
        hand_back()

    return run


def merged(bits: int, slices: int = SLICES):
    """applyInArrow for one slice: its bits that are marked twice over all tasks."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << bits) // slices
        once, twice = np.zeros(size, bool), np.zeros(size, bool)
        for b in batches:
            for gaps, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                n = np.cumsum(np.frombuffer(gaps, "<u4"), dtype=np.int64)
                twice[n[once[n]]] = True
                twice[n[np.unpackbits(np.frombuffer(t, np.uint8), count=len(n)).astype(bool)]] = True
                once[n] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())], ["slice", "bits"])
        hand_back()

    return run


def repeat_filter(df: DataFrame, extract, bits: int, hashes: int = 0) -> bytearray:
    """The bits marked twice, 2 ** bits of them: this is all that reaches the driver. hashes: how many to expect."""
    slices = slices_for(hashes)
    marked = df.mapInArrow(marks(extract, bits, slices), "slice int, gaps binary, twice binary")
    out, width = bytearray(1 << (bits - 3)), (1 << (bits - 3)) // slices
    for k, part in marked.groupBy("slice").applyInArrow(merged(bits, slices), "slice int, bits binary").collect():
        out[k * width : (k + 1) * width] = part
    return out


def suspected(f: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Which members may repeat; f: the filter's bytes."""
    p = positions(h, bits)
    return ((f[p >> 3] >> (p & 7)) & 1).astype(bool).all(axis=1)
