"""A MySQL source's stored geometry (SRID, then well-known binary) as well-known text (F4).

Rows read through the source's own select list come as text already; this is for
rows that arrive as stored bytes (dumps, change files, another engine's export)."""

from __future__ import annotations

import struct
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of geometry by their number in well-known binary.
KINDS = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON",
         7: "GEOMETRYCOLLECTION"}
# Source column types that hold them.
GEOMETRY_TYPES = ("GEOMETRY", *KINDS.values())
_PART = {4: 1, 5: 2, 6: 3}  # what a multi-geometry is made of
MAX_DEPTH = 100  # collections within collections


class GeometryError(ValueError):
    """Bytes that are no geometry."""


def _number(value: float) -> str:
    """Shortest text that reads back as the same double; whole numbers without a fraction."""
    text = repr(value).replace("e+", "e")
    return text[:-2] if text.endswith(".0") else text


class _Reader:
    """Walks one geometry; every count is checked against the bytes that are left."""

    def __init__(self, data: bytes, at: int, swap: bool):
        self.data, self.at, self.swap = data, at, swap

    def take(self, n: int) -> int:
        if n > len(self.data) - self.at:
            raise GeometryError(f"geometry ends after {len(self.data)} bytes")
        self.at += n
        return self.at - n

    def count(self, order: str) -> int:
        return struct.unpack_from(order + "I", self.data, self.take(4))[0]

    def points(self, order: str, n: int) -> str:
        at = self.take(16 * n)
        xy = np.frombuffer(self.data, f"{order}f8", 2 * n, at).reshape(n, 2)
        if not np.isfinite(xy).all():
            raise GeometryError("a coordinate is not a finite number")
        return ",".join(f"{_number(x)} {_number(y)}" for x, y in (xy[:, ::-1] if self.swap else xy).tolist())

    def lists(self, kind: int, order: str) -> str:
        """The text between a kind's outer brackets; empty for a geometry of no points."""
        if kind == 1:
            return self.points(order, 1)
        n = self.count(order)
        if kind == 2:
            return self.points(order, n)
        return ",".join(f"({self.points(order, self.count(order))})" for _ in range(n))

    def geometry(self, depth: int = 0, only: int | None = None) -> tuple[int, str]:
        """(kind, text between the brackets) of the geometry that starts here."""
        head = self.data[self.take(1)]
        if head > 1:
            raise GeometryError(f"no byte order mark: {head}")
        order = "<" if head else ">"
        kind = self.count(order)
        if kind not in KINDS or (only is not None and kind != only):
            raise GeometryError(f"unexpected kind of geometry: {kind}")
        if kind < 4:
            return kind, self.lists(kind, order)
        if depth >= MAX_DEPTH:
            raise GeometryError(f"collections nested over {MAX_DEPTH} deep")
        parts = []
        for _ in range(self.count(order)):
            inner, text = self.geometry(depth + 1, _PART.get(kind))
            parts.append(f"({text})" if kind < 7 else tagged(inner, text))
        return kind, ",".join(parts)


def tagged(kind: int, text: str) -> str:
    return f"{KINDS[kind]}({text})" if text else f"{KINDS[kind]} EMPTY"


def decode_geometry(data: bytes, lat_first: Sequence[int] = ()) -> str:
    """Text of one stored geometry; raises ``GeometryError`` for other bytes."""
    if len(data) < 4:
        raise GeometryError(f"geometry of {len(data)} bytes")
    reader = _Reader(data, 4, struct.unpack_from("<I", data)[0] in lat_first)
    text = tagged(*reader.geometry())
    if reader.at != len(data):
        raise GeometryError(f"{len(data) - reader.at} bytes after the geometry")
    return text


def geometry_text(value: Column, *, lat_first: Sequence[int] = (4326,), strict: bool = True) -> Column:
    """Well-known text of stored geometries, all seven kinds in either byte order, as the
    source's ``ST_AsText`` writes it. Systems in ``lat_first`` are stored longitude first
    and written latitude first. NULL stays NULL; bytes that are no geometry fail the
    query, or give NULL without ``strict``. Rows are decoded batch by batch where they lie."""
    swapped = frozenset(lat_first)

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        def one(data):
            try:
                return None if data is None else decode_geometry(bytes(data), swapped)
            except GeometryError:
                if strict:
                    raise
                return None

        return pd.Series([one(v) for v in values], dtype=object)

    return decode(value)


def geometry_srid(value: Column) -> Column:
    """Number of the spatial reference system, the first four bytes (least one first)."""
    h = F.hex(F.substring(value, 1, 4))
    turned = F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)])
    return F.when(F.length(value) >= 4, F.conv(turned, 16, 10).cast("bigint"))
