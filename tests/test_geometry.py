import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import PythonException

from tidecopy.functions import geometry_srid, geometry_text
from tidecopy.functions.geometry import MAX_DEPTH, GeometryError, decode_geometry

P, Q, R = (1.0, 2.5), (-3.0, 0.1), (1e20, -1e-7)
POINTS = {P: "1 2.5", Q: "-3 0.1", R: "1e20 -1e-07"}


def wkb(o, kind, body=b""):
    return (b"\x01" if o == "<" else b"\x00") + struct.pack(o + "I", kind) + body


def count(o, items):
    return struct.pack(o + "I", len(items)) + b"".join(items)


def xy(o, *points):
    return [struct.pack(o + "2d", *p) for p in points]


def cases(o):
    point, line = wkb(o, 1, xy(o, P)[0]), wkb(o, 2, count(o, xy(o, P, Q, R)))
    ring, hole = count(o, xy(o, P, Q, R, P)), count(o, xy(o, Q, P, Q))
    polygon = wkb(o, 3, count(o, [ring, hole]))
    other = "<" if o == ">" else ">"  # a part has a byte order of its own
    p, q, r = POINTS.values()
    flat = f"({p},{q},{r},{p}),({q},{p},{q})"
    return {
        point: f"POINT({p})",
        line: f"LINESTRING({p},{q},{r})",
        polygon: f"POLYGON({flat})",
        wkb(o, 4, count(o, [point, wkb(other, 1, xy(other, Q)[0])])): f"MULTIPOINT(({p}),({q}))",
        wkb(o, 5, count(o, [line, line])): f"MULTILINESTRING(({p},{q},{r}),({p},{q},{r}))",
        wkb(o, 6, count(o, [polygon])): f"MULTIPOLYGON(({flat}))",
        wkb(o, 7, count(o, [point, wkb(o, 7, count(o, [line])), polygon])):
            f"GEOMETRYCOLLECTION(POINT({p}),GEOMETRYCOLLECTION(LINESTRING({p},{q},{r})),POLYGON({flat}))",
        wkb(o, 7, count(o, [])): "GEOMETRYCOLLECTION EMPTY",
        wkb(o, 2, count(o, [])): "LINESTRING EMPTY",
    }


@pytest.mark.parametrize("order", ["<", ">"])
def test_every_kind(order):
    for data, text in cases(order).items():
        assert decode_geometry(struct.pack("<I", 0) + data) == text


def test_latitude_first():
    data = struct.pack("<I", 4326) + wkb("<", 2, count("<", xy("<", (10.0, 50.0), (11.0, 51.0))))
    assert decode_geometry(data, (4326,)) == "LINESTRING(50 10,51 11)"
    assert decode_geometry(data) == "LINESTRING(10 50,11 51)"


@pytest.mark.parametrize("body", [
    b"", b"\x01", wkb("<", 1), wkb("<", 9, b"\0" * 16), b"\x07" + wkb("<", 1)[1:], wkb("<", 2, struct.pack("<I", 2**32 - 1)),
    wkb("<", 1, xy("<", P)[0]) + b"x", wkb("<", 1, struct.pack("<2d", float("nan"), 0)), wkb("<", 4, count("<", [wkb("<", 2, count("<", []))])),
])
def test_other_bytes(body):
    with pytest.raises(GeometryError):
        decode_geometry(b"\0\0\0\0" + body)


def test_depth():
    nested = wkb("<", 7, count("<", []))
    for _ in range(MAX_DEPTH - 1):
        nested = wkb("<", 7, count("<", [nested]))
    assert decode_geometry(b"\0\0\0\0" + nested).endswith("EMPTY" + ")" * (MAX_DEPTH - 1))
    with pytest.raises(GeometryError, match="deep"):
        decode_geometry(b"\0\0\0\0" + wkb("<", 7, count("<", [nested])))


def test_column(spark):
    good = [(i, struct.pack("<I", i) + d) for i, d in enumerate(cases("<"))]
    df = spark.createDataFrame([*good, (90, None), (91, b"abc"), (92, b"\0\0\0\0")], "id int, g binary")
    rows = {r["id"]: r for r in df.select("id", geometry_text(F.col("g"), strict=False).alias("t"), geometry_srid(F.col("g")).alias("s"),
                                          ).collect()}
    assert [rows[i]["t"] for i in range(len(good))] == list(cases("<").values())
    assert [rows[i]["s"] for i in range(len(good))] == list(range(len(good)))
    assert rows[90]["t"] is None and rows[90]["s"] is None
    assert rows[91]["t"] is None and rows[91]["s"] is None and rows[92]["t"] is None and rows[92]["s"] == 0
    with pytest.raises(PythonException, match="GeometryError"):
        df.select(geometry_text(F.col("g"))).collect()
