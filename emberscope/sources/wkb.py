"""Polygon WKB to rings and back, a whole Arrow batch at a time.

Headers of all features of a batch are read side by side: every step takes the next part
and the next ring of each feature that has one, as numpy arrays over byte offsets. The
coordinates are then gathered in one go. No Python function runs per feature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLYGON, MULTIPOLYGON = 3, 6
# Points gathered at a time: their byte offsets take 64 bytes each.
CHUNK = 1 << 18

_RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
RINGS = T.ArrayType(_RING)
PARTS = T.ArrayType(
    T.StructType([T.StructField("rings", RINGS), T.StructField("wkb", T.BinaryType())])
)
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_ARROW_RINGS = pa.list_(pa.list_(_POINT))


class _Bytes:
    """The bytes of a binary array, read at many offsets at once."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def u32(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        four = self.data[at[:, None] + np.arange(4)]
        low = four.view("<u4").ravel() if len(at) else np.zeros(0, "<u4")
        return np.where(little, low, low.byteswap()).astype(np.int64)

    def doubles(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        eight = self.data[at[:, None] + np.arange(8)]
        value = eight.view("<u8").ravel() if len(at) else np.zeros(0, "<u8")
        return np.where(little, value, value.byteswap()).view("<f8")

    def header(self, at: np.ndarray, end: np.ndarray):
        """(fits, little, kind, dimensions, count, offset after the count) of geometries."""
        fits = at + 9 <= end
        at = np.where(fits, at, 0)
        little = self.data[at] == 1
        code = np.zeros(len(at), np.int64)
        code[fits] = self.u32(at[fits] + 1, little[fits])
        fits &= self.data[at] <= 1
        flags, kind = code >> 29, code & 0x1FFFFFFF
        level = kind // 1000
        fits &= level <= 3
        dims = 2 + np.maximum((flags >> 2 & 1) + (flags >> 1 & 1), np.array([0, 1, 1, 2])[np.minimum(level, 3)])
        at = at + 5 + 4 * (flags & 1)
        fits &= at + 4 <= end
        count = np.zeros(len(at), np.int64)
        count[fits] = self.u32(at[fits], little[fits])
        return fits, little, kind % 1000, dims, count, at + 4


def _spread(starts: np.ndarray, counts: np.ndarray, steps: np.ndarray | int) -> np.ndarray:
    """``start, start + step, ..`` of every run, one after the other."""
    before = np.cumsum(counts) - counts
    place = np.arange(int(counts.sum())) - np.repeat(before, counts)
    return np.repeat(starts, counts) + place * (np.repeat(steps, counts) if np.ndim(steps) else steps)


def _walk(raw: _Bytes, start: np.ndarray, end: np.ndarray, null: np.ndarray):
    """Parts and rings of all features: (bad, part_feature, ring_part, ring_n, ring_at, step, little)."""
    n = len(start)
    at, bad = start.copy(), null.copy()
    parts_left, rings_left = np.zeros(n, np.int64), np.zeros(n, np.int64)
    multi = np.zeros(n, bool)
    little, dims, part = np.zeros(n, bool), np.full(n, 2), np.full(n, -1)
    if n and len(raw.data):
        fits, _, kind, _, count, after = raw.header(start, end)
        multi = fits & ~null & (kind == MULTIPOLYGON)
        bad |= ~(multi | (fits & (kind == POLYGON)))
        parts_left = np.where(multi, count, 1)
        at = np.where(multi, after, start)
    else:
        bad[:] = True
    parts, rings, n_parts = [], [], 0
    while True:
        i = np.flatnonzero(~bad & (rings_left == 0) & (parts_left > 0))
        if len(i):
            fits, small, kind, d, count, after = raw.header(at[i], end[i])
            fits &= kind == POLYGON
            bad[i[~fits]] = True
            i, small, d, count, after = (x[fits] for x in (i, small, d, count, after))
            little[i], dims[i], rings_left[i], at[i] = small, d, count, after
            part[i] = n_parts + np.arange(len(i))
            parts_left[i] -= 1
            parts.append(i)
            n_parts += len(i)
        j = np.flatnonzero(~bad & (rings_left > 0))
        if len(j):
            fits = at[j] + 4 <= end[j]
            bad[j[~fits]] = True
            j = j[fits]
            count, step = raw.u32(at[j], little[j]), 8 * dims[j]
            fits = at[j] + 4 + count * step <= end[j]
            bad[j[~fits]] = True
            j, count, step = j[fits], count[fits], step[fits]
            rings.append(np.column_stack([part[j], count, at[j] + 4, step, little[j]]))
            at[j] += 4 + count * step
            rings_left[j] -= 1
        elif not len(i):
            break
    feature = np.concatenate([np.zeros(0, np.int64), *parts])
    found = np.concatenate([np.zeros((0, 5), np.int64), *rings]).astype(np.int64)
    # In order of features, parts and rings; those of features found to be bad go.
    order = np.argsort(feature, kind="stable")
    order = order[~bad[feature[order]]]
    rank = np.full(len(feature), -1)
    rank[order] = np.arange(len(order))
    found = found[rank[found[:, 0]] >= 0]
    found[:, 0] = rank[found[:, 0]]
    found = found[np.argsort(found[:, 0], kind="stable")]
    return bad, feature[order], found


def _offsets(owner: np.ndarray, n: int) -> pa.Array:
    """List offsets of ``n`` owners from the ascending owner of every item."""
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]), pa.int32())


def _lists(offsets: pa.Array, values: pa.Array, null: np.ndarray | None = None) -> pa.Array:
    mask = None if null is None else pa.array(null)
    return pa.ListArray.from_arrays(offsets, values, mask=mask)


def _encode(ring_part: np.ndarray, ring_n: np.ndarray, xs: np.ndarray, ys: np.ndarray, n: int) -> pa.Array:
    """Little-endian two-dimensional WKB of ``n`` polygons."""
    n_rings = np.bincount(ring_part, minlength=n)
    size = 9 + np.bincount(ring_part, weights=4 + 16 * ring_n, minlength=n).astype(np.int64)
    ends = np.cumsum(size)
    start = ends - size
    out = np.zeros(int(size.sum()), np.uint8)

    def put(at: np.ndarray, values: np.ndarray, kind: str) -> None:
        plain = np.ascontiguousarray(values.astype(kind))
        width = plain.dtype.itemsize
        out[at[:, None] + np.arange(width)] = plain.view(np.uint8).reshape(-1, width)

    out[start] = 1
    put(start + 1, np.full(n, POLYGON), "<u4")
    put(start + 5, n_rings, "<u4")
    # A ring starts behind its polygon's header and the rings before it.
    length = 4 + 16 * ring_n
    before = np.cumsum(length) - length
    first = np.cumsum(n_rings) - n_rings
    ring_at = start[ring_part] + 9 + before - before[first[ring_part]] if len(ring_n) else before
    put(ring_at, ring_n, "<u4")
    points = _spread(ring_at + 4, ring_n, 16)
    for a in range(0, len(points), CHUNK):
        b = a + CHUNK
        put(points[a:b], xs[a:b], "<f8")
        put(points[a:b] + 8, ys[a:b], "<f8")
    bounds = np.concatenate([[0], ends]).astype(np.int64)
    large = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(out)])
    return large.cast(pa.binary())


def decode(array: pa.Array) -> pa.Array:
    """Per feature its parts, each with rings and its own WKB; null where it is no polygon."""
    array = array.cast(pa.large_binary())
    n = len(array)
    null = np.asarray(array.is_null())
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = _Bytes(np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8))
    bad, part_feature, rings = _walk(raw, bounds[:-1].copy(), bounds[1:].copy(), null)
    ring_part, ring_n, ring_at, step, little = rings.T
    points, order = _spread(ring_at, ring_n, step), np.repeat(little == 1, ring_n)
    xs, ys = np.empty(len(points)), np.empty(len(points))
    for a in range(0, len(points), CHUNK):
        b = a + CHUNK
        xs[a:b] = raw.doubles(points[a:b], order[a:b])
        ys[a:b] = raw.doubles(points[a:b] + 8, order[a:b])
    flat = pa.StructArray.from_arrays([pa.array(xs), pa.array(ys)], fields=list(_POINT))
    by_ring = _lists(pa.array(np.concatenate([[0], np.cumsum(ring_n)]), pa.int32()), flat)
    n_parts = len(part_feature)
    by_part = _lists(_offsets(ring_part, n_parts), by_ring)
    own = _encode(ring_part, ring_n, xs, ys, n_parts)
    return _lists(_offsets(part_feature, n), pa.StructArray.from_arrays([by_part, own], ["rings", "wkb"]), bad)


def encode(array: pa.Array) -> pa.Array:
    """WKB of each polygon given as rings; null where the rings are null."""
    array = array.cast(_ARROW_RINGS)
    null = np.asarray(array.is_null())
    size = np.asarray(array.value_lengths().fill_null(0))
    rings = array.flatten()
    ring_n = np.asarray(rings.value_lengths().fill_null(0)).astype(np.int64)
    points = rings.flatten()
    xs, ys = (np.asarray(points.field(k).cast(pa.float64())) for k in ("x", "y"))
    if points.offset:
        xs, ys = (np.asarray(x) for x in points.flatten())
    out = _encode(np.repeat(np.arange(len(array)), size), ring_n, xs, ys, len(array))
    return pa.compute.if_else(pa.array(null), pa.scalar(None, pa.binary()), out) if null.any() else out


@F.arrow_udf(PARTS)
def decode_wkb(wkb: pa.Array) -> pa.Array:
    """Parts of every feature; null for anything that is no polygon, so that it can be set aside."""
    return decode(wkb)


@F.arrow_udf(T.BinaryType())
def encode_wkb(rings: pa.Array) -> pa.Array:
    return encode(rings)
