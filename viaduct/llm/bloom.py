"""A filter of fixed size that tells which hashes may occur more than once.

Each hash hits two places; a place hit by two rows belongs to the `twice` plane. Rows whose places are all in that
plane may be repeated; all others are certainly single. Equal hashes hit the same places, so a repeated hash is never
missed; a chance hit only sends a single row the longer way.

Tasks reduce their rows to places with a count of 1 or 2 before the shuffle. The planes are dealt out by block, and
the finished plane has at most `MOST_BITS` bits, however large the table is; beyond that the share of chance hits
grows, and in the end all rows take the longer way, with the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shipping import ship

BITS_PER_ROW = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
BLOCK_BITS = 1 << 16


def bits_for(rows: int) -> int:
    wanted = max(LEAST_BITS, min(MOST_BITS, rows * BITS_PER_ROW))
    return 1 << (wanted - 1).bit_length()


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    wide = hashes.astype(np.int64).view(np.uint64)
    return ((wide & np.uint64(bits - 1)).astype(np.int64),
            ((wide >> np.uint64(33)) & np.uint64(bits - 1)).astype(np.int64))


def _reduced(bits: int):
    """Arrow batches of `hash` to rows of (block, once, twice): places of a block, as packed 16-bit offsets."""
    def run(batches):
        once = np.zeros(bits // 8, np.uint8)
        twice = np.zeros(bits // 8, np.uint8)
        any_row = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            any_row = True
            first, second = places(batch.column(0).to_numpy(zero_copy_only=False), bits)
            # A row whose two places coincide hits that place once.
            hit = np.concatenate([first, second[second != first]])
            spot, count = np.unique(hit, return_counts=True)
            byte, bit = spot >> 3, np.left_shift(1, spot & 7).astype(np.uint8)
            again = ((once[byte] & bit) != 0) | (count > 1)
            np.bitwise_or.at(twice, byte[again], bit[again])
            np.bitwise_or.at(once, byte, bit)
        if not any_row:
            return
        for block in range(bits // BLOCK_BITS):
            part = slice(block * BLOCK_BITS // 8, (block + 1) * BLOCK_BITS // 8)
            if once[part].any():
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int32()),
                    "once": pa.array([_packed(once[part])], pa.binary()),
                    "twice": pa.array([_packed(twice[part])], pa.binary())})
    return run


def _packed(plane: np.ndarray) -> bytes:
    return np.flatnonzero(np.unpackbits(plane, bitorder="little")).astype(np.uint16).tobytes()


def _merged(batches):
    """Rows of the blocks of one partition to the finished `twice` planes, in rows of (block, plane)."""
    planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, one, two in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if block not in planes:
                planes[block] = np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
            once, twice = planes[block]
            spots = np.frombuffer(one, np.uint16)
            twice[np.frombuffer(two, np.uint16)] = True
            twice[spots[once[spots]]] = True
            once[spots] = True
    for block, (once, twice) in planes.items():
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int32()),
            "once": pa.array([np.packbits(once, bitorder="little").tobytes()], pa.binary()),
            "twice": pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())})


def repeated_plane(hashes: DataFrame, rows: int) -> np.ndarray:
    """First pass over a frame with one long column: the `twice` plane, at most MOST_BITS / 8 bytes."""
    return _plane(hashes, rows, "twice")


def once_plane(hashes: DataFrame, rows: int) -> np.ndarray:
    """The plane of all places that are hit, for telling which hashes may be among these."""
    return _plane(hashes, rows, "once")


def _plane(hashes: DataFrame, rows: int, kind: str) -> np.ndarray:
    ship(hashes.sparkSession)
    bits = bits_for(rows)
    parts = hashes.mapInArrow(_reduced(bits), "block int, once binary, twice binary")
    plane = np.zeros(bits // 8, np.uint8)
    merged = parts.repartition("block").mapInArrow(_merged, "block int, once binary, twice binary")
    for row in merged.select("block", kind).collect():
        at = row["block"] * BLOCK_BITS // 8
        plane[at:at + BLOCK_BITS // 8] = np.frombuffer(row[kind], np.uint8)
    return plane


def passes(plane: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Second pass: which hashes have all their places in the plane."""
    first, second = places(hashes, len(plane) * 8)
    return (((plane[first >> 3] >> (first & 7)) & 1) & ((plane[second >> 3] >> (second & 7)) & 1)).astype(bool)
