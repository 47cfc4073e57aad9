"""Coordinates: envelopes, extents, tile keys, WKB, the Hilbert curve, web-mercator tiles.  Built-in expressions throughout."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kilometres of a degree of longitude at the equator and of latitude; the widest envelope that is taken as measured.
KM_PER_DEGREE_LON, KM_PER_DEGREE_LAT = 111.32, 110.57
HEMISPHERE = 180.0
#: With an exponent, which makes 1e-05 one number.
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"


def envelope(wkt: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax> of the numbers of a WKT text (its data type cut off); null if there are fewer than two."""
    numbers = F.transform(F.regexp_extract_all(F.substring_index(wkt, "^^", 1), F.lit(f"({NUMBER})"), F.lit(1)), lambda x: x.try_cast("double"))
    xs, ys = F.filter(numbers, lambda _, i: i % 2 == 0), F.filter(numbers, lambda _, i: i % 2 == 1)
    box = F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))
    return F.when(F.size(numbers) >= 2, box)


def crosses_antimeridian(xmin: Column, xmax: Column) -> Column:
    return xmax - xmin > HEMISPHERE


def extent_km(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The larger of width and height in km; null for an envelope that is wider than a hemisphere and so says nothing of the width."""
    width = (xmax - xmin) * KM_PER_DEGREE_LON * F.cos(F.radians((ymin + ymax) / 2))
    return F.when(~crosses_antimeridian(xmin, xmax), F.greatest(width, (ymax - ymin) * KM_PER_DEGREE_LAT))


def area_km2(literal: Column) -> Column:
    """Square kilometres of a literal in square metres; null unless it is a number above 0."""
    m2 = F.translate(F.substring_index(literal, "^^", 1), '"', "").try_cast("double")
    return F.when(m2 > 0, m2 / 1e6)


def dem_tile(lat: Column, lon: Column) -> Column:
    """Name of the 1 x 1 degree elevation tile: hemisphere and degrees of its south-west corner."""
    south, west = F.floor(lat).cast("int"), F.floor(lon).cast("int")
    ns = F.concat(F.when(south >= 0, "N").otherwise("S"), F.lpad(F.abs(south).cast("string"), 2, "0"))
    ew = F.concat(F.when(west >= 0, "E").otherwise("W"), F.lpad(F.abs(west).cast("string"), 3, "0"))
    # Fixed value: the form of a tile's name.
    return F.concat(F.lit("Copernicus_DSM_COG_10_"), ns, F.lit("_00_"), ew, F.lit("_00_DEM"))


def off_the_edge(v: Column) -> Column:
    """A coordinate on a whole degree is sampled a thousandth beside it."""
    return F.when(v == F.floor(v), v + 0.001).otherwise(v)


def _double_bytes(v: Column) -> Column:
    """Little-endian IEEE 754 bytes of a finite double, by arithmetic: Spark casts no double to binary."""
    a = F.abs(v)
    e = F.when(a == 0, F.lit(-1023)).otherwise(F.floor(F.log2(a)).cast("int"))
    # log2 may be one off beside a power of two
    e = F.when(a == 0, e).when(a < F.pow(F.lit(2.0), e), e - 1).when(a >= F.pow(F.lit(2.0), e + 1), e + 1).otherwise(e)
    mantissa = F.when(a == 0, F.lit(0).cast("long")).otherwise(((a / F.pow(F.lit(2.0), e) - 1.0) * float(1 << 52)).cast("long"))
    bits = F.shiftleft((e + 1023).cast("long"), 52).bitwiseOR(mantissa).bitwiseOR(F.when(v < 0, F.lit(-(1 << 63))).otherwise(F.lit(0).cast("long")))
    big = F.lpad(F.hex(bits), 16, "0")
    return F.unhex(F.concat(*[F.substring(big, 15 - 2 * k, 2) for k in range(8)]))


def wkb_point(lon: Column, lat: Column) -> Column:
    """Well-known binary of a point: byte order, type, x, y."""
    return F.concat(F.unhex(F.lit("0101000000")), _double_bytes(lon), _double_bytes(lat))


def _double_of(hexa: Column) -> Column:
    """The double of 16 hexadecimal digits, big-endian: sign and exponent, then 52 bits of mantissa."""
    head = F.conv(F.substring(hexa, 1, 3), 16, 10).cast("int")
    mantissa, exponent = F.conv(F.substring(hexa, 4, 13), 16, 10).cast("double"), head % 2048
    size = F.when(exponent == 0, F.lit(0.0)).otherwise((mantissa / float(1 << 52) + 1.0) * F.pow(F.lit(2.0), exponent - 1023))
    return F.when(head >= 2048, -size).otherwise(size)


def wkb_xy(wkb: Column) -> Column:
    """struct<x, y> of a little-endian point; null for anything else."""
    h = F.hex(wkb)
    number = lambda start: _double_of(F.concat(*[F.substring(h, start + 14 - 2 * k, 2) for k in range(8)]))
    return F.when(h.startswith("0101000000") & (F.length(h) == 42), F.struct(number(11).alias("x"), number(27).alias("y")))


def wkt_point(lon: Column, lat: Column) -> Column:
    return F.format_string("POINT (%s %s)", lon, lat)


def geojson_point(lon: Column, lat: Column) -> Column:
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))


def hilbert(lon: Column, lat: Column, order: int = 16) -> Column:
    """Place of a point on the Hilbert curve over ``2^order`` cells a side of the whole globe, as a long."""
    side = 1 << order
    cell = lambda v, low, width: F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor((v - low) / width * side).cast("int"))).cast("int")
    start = F.struct(cell(lon, -180.0, 360.0).alias("x"), cell(lat, -90.0, 180.0).alias("y"), F.lit(0).cast("long").alias("d"))

    def step(a: Column, k: Column) -> Column:
        s = F.call_function("shiftleft", F.lit(1), k)
        rx, ry = (a["x"].bitwiseAND(s) > 0).cast("int"), (a["y"].bitwiseAND(s) > 0).cast("int")
        flip = (ry == 0) & (rx == 1)
        x, y = F.when(flip, s - 1 - a["x"].bitwiseAND(s - 1)).otherwise(a["x"].bitwiseAND(s - 1)), F.when(flip, s - 1 - a["y"].bitwiseAND(s - 1)).otherwise(a["y"].bitwiseAND(s - 1))
        d = a["d"] + s.cast("long") * s.cast("long") * ((3 * rx).bitwiseXOR(ry)).cast("long")
        return F.struct(F.when(ry == 0, y).otherwise(x).cast("int").alias("x"), F.when(ry == 0, x).otherwise(y).cast("int").alias("y"), d.alias("d"))

    return F.aggregate(F.sequence(F.lit(order - 1), F.lit(0), F.lit(-1)), start, step, lambda a: a["d"])


def mercator_tile(lon: Column, lat: Column, zoom: int) -> Column:
    """struct<z, x, y> of the web-mercator tile; latitudes beyond the map are put on its edge."""
    n = 1 << zoom
    limit = 85.05112878
    rad = F.radians(F.least(F.lit(limit), F.greatest(F.lit(-limit), lat)))
    inside = lambda v: F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor(v).cast("int"))).cast("int")
    x = inside((lon + 180.0) / 360.0 * n)
    y = inside((1.0 - F.log(F.tan(rad) + 1.0 / F.cos(rad)) / math.pi) / 2.0 * n)
    return F.struct(F.lit(zoom).alias("z"), x.alias("x"), y.alias("y"))
