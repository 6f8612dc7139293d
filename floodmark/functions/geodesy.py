"""Positions: grid cells, geography codes and transverse Mercator coordinates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def geoid(fips, level: str) -> Column:
    """Leading part of a block code: ``tract`` (11), ``county`` (5) or ``state`` (2)."""
    return F.substring(_col(fips), 1, {"tract": 11, "county": 5, "state": 2}[level])


def cell_number(coord, origin, size, flip: bool = False, truncate: bool = False) -> Column:
    """Cell number of a coordinate; ``flip`` counts downwards from the origin.

    ``truncate`` rounds toward zero, which puts points up to one cell before the origin
    into cell 0; the default is the floor.
    """
    coord, origin, size = (_col(x) if isinstance(x, (str, Column)) else F.lit(float(x)) for x in (coord, origin, size))
    offset = ((origin - coord) if flip else (coord - origin)) / size
    return offset.cast("bigint") if truncate else F.floor(offset).cast("bigint")


MORTON_BITS = 26


def _spread_bits(number: Column) -> Column:
    """Bits of a number of MORTON_BITS bits, each followed by a zero bit."""
    # The usual masks; each step halves the runs of bits that still stand together.
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def morton(lat, lon) -> Column:
    """Place of a position on a Z-shaped curve over the globe, as a bigint: near places on the curve are near positions.

    Both coordinates are cut into 2**26 steps (under 0.7 m) and their bits interleaved, latitude first.  Positions beyond the
    poles or the date line count as on them; a missing or NaN coordinate gives NULL.
    """
    def steps(c, half: float) -> Column:
        c = _col(c).cast("double")
        whole = F.floor((F.greatest(F.lit(-half), F.least(F.lit(half), c)) + half) * ((1 << MORTON_BITS) / (2 * half)))
        return F.when(c.isNotNull() & ~F.isnan(c), F.least(whole, F.lit((1 << MORTON_BITS) - 1)).cast("bigint"))

    return F.shiftleft(_spread_bits(steps(lat, 90.0)), 1).bitwiseOR(_spread_bits(steps(lon, 180.0)))


def utm_zone(lat, lon) -> Column:
    """UTM zone of a point, with the wider zones of Norway and Svalbard."""
    lat, lon = _col(lat), _col(lon)
    plain = F.pmod(F.floor((lon + 180) / 6), F.lit(60)).cast("int") + 1
    svalbard = F.when(lon < 9, 31).when(lon < 21, 33).when(lon < 33, 35).otherwise(37)
    return (
        F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), 32)
        .when((lat >= 72) & (lat <= 84) & (lon >= 0) & (lon < 42), svalbard)
        .otherwise(plain)
    )


# WGS84 ellipsoid and the UTM scale.
_A = 6378137.0
_F = 1 / 298.257223563
_E2 = _F * (2 - _F)
_EP2 = _E2 / (1 - _E2)
_K0 = 0.9996


def to_utm(lat, lon, zone=None) -> Column:
    """Struct of zone, easting and northing in metres (Snyder 1987, transverse Mercator series)."""
    lat, lon = _col(lat), _col(lon)
    if zone is None:
        zone = utm_zone(lat, lon)
    elif isinstance(zone, int):
        zone = F.lit(zone)
    else:
        zone = F.coalesce(_col(zone), utm_zone(lat, lon))
    phi = F.radians(lat)
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    central = F.radians((zone * 6 - 183).cast("double"))
    n = F.lit(_A) / F.sqrt(1 - F.lit(_E2) * sin * sin)
    t = tan * tan
    c = F.lit(_EP2) * cos * cos
    a = cos * (F.radians(lon) - central)
    m = F.lit(_A) * (
        F.lit(1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256) * phi
        - F.lit(3 * _E2 / 8 + 3 * _E2**2 / 32 + 45 * _E2**3 / 1024) * F.sin(2 * phi)
        + F.lit(15 * _E2**2 / 256 + 45 * _E2**3 / 1024) * F.sin(4 * phi)
        - F.lit(35 * _E2**3 / 3072) * F.sin(6 * phi)
    )
    a2 = a * a
    east = F.lit(_K0) * n * a * (
        1 + a2 * ((1 - t + c) / 6 + a2 * (5 - 18 * t + t * t + 72 * c - F.lit(58 * _EP2)) / 120)
    ) + 500000
    north = F.lit(_K0) * (
        m + n * tan * a2 * (
            F.lit(0.5) + a2 * ((5 - t + 9 * c + 4 * c * c) / 24
                               + a2 * (61 - 58 * t + t * t + 600 * c - F.lit(330 * _EP2)) / 720)
        )
    ) + F.when(lat < 0, 10000000.0).otherwise(0.0)
    return F.struct(zone.alias("zone"), east.alias("easting"), north.alias("northing"))
