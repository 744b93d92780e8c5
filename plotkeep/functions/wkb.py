"""WKB binary <-> nested vertex arrays.

The only geometry step in Python: bytes need a cursor. Batches arrive as
Arrow arrays and coordinates are moved with numpy, never vertex by vertex.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.functions.geometry import PARTS

# ISO WKB geometry type codes, two dimensions.
WKB_POINT, WKB_POLYGON, WKB_MULTIPOLYGON = 1, 3, 6


def _read_parts(buf: bytes, coords: list[np.ndarray]) -> list[list[int]]:
    """Ring sizes per part; appends each ring's coordinates to ``coords``."""
    def header(at: int) -> tuple[str, int, int]:
        order = "<" if buf[at] == 1 else ">"
        return order, struct.unpack_from(order + "I", buf, at + 1)[0], at + 5

    def take(order: str, count: int, at: int) -> int:
        flat = np.frombuffer(buf, dtype=order + "f8", count=2 * count, offset=at)
        coords.append(flat.reshape(count, 2))
        return at + 16 * count

    def polygon(order: str, at: int) -> tuple[list[int], int]:
        (n_rings,) = struct.unpack_from(order + "I", buf, at)
        at += 4
        sizes = []
        for _ in range(n_rings):
            (count,) = struct.unpack_from(order + "I", buf, at)
            at = take(order, count, at + 4)
            sizes.append(count)
        return sizes, at

    order, kind, at = header(0)
    if kind == WKB_POINT:
        take(order, 1, at)
        return [[1]]
    if kind == WKB_POLYGON:
        return [polygon(order, at)[0]]
    if kind == WKB_MULTIPOLYGON:
        (n_parts,) = struct.unpack_from(order + "I", buf, at)
        at += 4
        out = []
        for _ in range(n_parts):
            part_order, _, at = header(at)
            sizes, at = polygon(part_order, at)
            out.append(sizes)
        return out
    raise ValueError(f"unsupported WKB geometry type {kind}")


def decode_batch(values: pa.Array) -> pa.Array:
    """A binary Arrow array to the nested ``parts`` layout."""
    coords: list[np.ndarray] = []
    missing, row_ends, part_ends, ring_sizes = [], [0], [0], []
    for value in values:
        buf = value.as_py()
        missing.append(buf is None)
        sizes = _read_parts(buf, coords) if buf is not None else []
        for part in sizes:
            ring_sizes.extend(part)
            part_ends.append(part_ends[-1] + len(part))
        row_ends.append(row_ends[-1] + len(sizes))
    flat = np.concatenate(coords).astype("f8") if coords else np.empty((0, 2))
    points = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(flat[:, 0])), pa.array(np.ascontiguousarray(flat[:, 1]))], ["x", "y"]
    )
    ring_ends = np.concatenate([[0], np.cumsum(ring_sizes)]).astype("i4")
    ring_list = pa.ListArray.from_arrays(pa.array(ring_ends, pa.int32()), points)
    part_list = pa.ListArray.from_arrays(pa.array(part_ends, pa.int32()), ring_list)
    return pa.ListArray.from_arrays(
        pa.array(row_ends, pa.int32()), part_list, mask=pa.array(missing, pa.bool_())
    )


def _ring_bytes(ring: list) -> bytes:
    xy = np.array([(p["x"], p["y"]) for p in ring], dtype="<f8").reshape(-1, 2)
    return struct.pack("<I", len(ring)) + xy.tobytes()


def _polygon_bytes(part: list) -> bytes:
    head = struct.pack("<BII", 1, WKB_POLYGON, len(part))
    return head + b"".join(_ring_bytes(ring) for ring in part)


def encode_one(parts: list | None, multi: bool) -> bytes | None:
    if parts is None:
        return None
    if len(parts) == 1 and len(parts[0]) == 1 and len(parts[0][0]) == 1:
        p = parts[0][0][0]
        return struct.pack("<BIdd", 1, WKB_POINT, p["x"], p["y"])
    if len(parts) == 1 and not multi:
        return _polygon_bytes(parts[0])
    return struct.pack("<BII", 1, WKB_MULTIPOLYGON, len(parts)) + b"".join(map(_polygon_bytes, parts))


@F.arrow_udf(returnType=PARTS)
def from_wkb(values: pa.Array) -> pa.Array:
    return decode_batch(values)


@F.arrow_udf(returnType=T.BinaryType())
def to_wkb(values: pa.Array) -> pa.Array:
    """Little-endian ISO WKB: a point, a polygon, or a multipolygon for several parts."""
    return pa.array([encode_one(v.as_py(), multi=False) for v in values], pa.binary())


@F.arrow_udf(returnType=T.BinaryType())
def to_wkb_multi(values: pa.Array) -> pa.Array:
    """As ``to_wkb``, but one polygon is also written as a multipolygon."""
    return pa.array([encode_one(v.as_py(), multi=True) for v in values], pa.binary())
