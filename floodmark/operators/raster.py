"""Depth grids as cell tables: geometry, sampling, wet tiles and category remap."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed_values as fv, geodesy
from .joins import BROADCAST_ROWS, Lookup, as_lookup, lookup, one_per_key, written_lookup

TILE_DEGREES, TILE_METRES, OWN_ZONE = 1.0, 100_000.0, 61
HEADER = ("raster_id string, x0 double, y0 double, pw double, ph double, width int, height int, nodata double, "
          "is_projected_metre boolean, zone int")
OUTSIDE_KEYS = 1 << 20
#: Headers up to this number are held by the driver; a run has a few dozen grids.
KNOWN_HEADERS = 10_000
#: Headers up to this number are written into the plan as literals.
WRITTEN_OUT = 32
PACKED_TILE = 64


@dataclass(frozen=True)
class Raster:
    """Geometry of one depth grid, as read from its header."""

    raster_id: str
    x0: float
    y0: float
    pw: float
    ph: float
    width: int
    height: int
    nodata: float = fv.SURGE_NODATA
    is_projected_metre: bool = False
    zone: int | None = None

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        """(left, bottom, right, top) in the units of the grid."""
        return (self.x0, self.y0 - self.ph * self.height, self.x0 + self.pw * self.width, self.y0)


@dataclass(frozen=True)
class PackedCells:
    """Wet cells as square tiles: raster_id, trow, tcol and the tile's values as an array by place, see :func:`packed_cells`."""

    lookup: Lookup
    tile: int = PACKED_TILE


def known_headers(spark: SparkSession, rasters: Sequence[Raster] | DataFrame) -> list[Raster] | None:
    """Grid headers on the driver, one per grid id, in order of the ids; None for a table of more than KNOWN_HEADERS."""
    if isinstance(rasters, DataFrame):
        rows = headers(spark, rasters).limit(KNOWN_HEADERS + 1).collect()
        if len(rows) > KNOWN_HEADERS:
            return None
        return sorted((Raster(**r.asDict()) for r in rows), key=lambda r: r.raster_id)
    if not rasters:
        raise ValueError("at least one grid is needed")
    def order(r: Raster) -> list:
        return [(v is None, v) for v in (getattr(r, f.name) for f in fields(r))]

    first = {r.raster_id: r for r in sorted(rasters, key=order, reverse=True)}
    return [first[name] for name in sorted(first)]


def headers(spark: SparkSession, rasters: Sequence[Raster] | DataFrame) -> DataFrame:
    """Grid headers as a table, one row per grid id: of a list, or of a metadata table with defaults filled in."""
    names = list(Raster.__dataclass_fields__)
    if isinstance(rasters, DataFrame):
        table = rasters
    else:
        if not rasters:
            raise ValueError("at least one grid is needed")
        table = spark.createDataFrame([tuple(getattr(r, n) for n in names) for r in rasters], HEADER)
    given = {f.name for f in table.schema}
    kinds = dict(f.split() for f in HEADER.split(", "))
    defaults = {"nodata": fv.SURGE_NODATA, "is_projected_metre": False, "zone": None}
    cols = {
        n: F.coalesce(F.col(n).cast(kinds[n]), F.lit(defaults.get(n)).cast(kinds[n])) if n in given
        else F.lit(defaults[n]).cast(kinds[n])
        for n in names
    }
    return one_per_key(table.select(*[c.alias(n) for n, c in cols.items()]), ["raster_id"])


def raster_bounds(meta: DataFrame) -> DataFrame:
    """Bounding box of every grid of a metadata table."""
    return meta.select(
        "raster_id",
        F.col("x0").alias("left"),
        (F.col("y0") - F.col("ph") * F.col("height")).alias("bottom"),
        (F.col("x0") + F.col("pw") * F.col("width")).alias("right"),
        F.col("y0").alias("top"),
    )


def remap_codes(cells: DataFrame, mapping: dict[int, float] | None = None,
                nodata: float = fv.SURGE_NODATA) -> DataFrame:
    """Surge category codes to feet; unlisted codes become ``nodata``."""
    mapping = mapping or fv.SURGE_FEET
    entries = [F.lit(x) for k, v in mapping.items() for x in (int(k), float(v))]
    feet = F.try_element_at(F.create_map(*entries), F.col("value").cast("int"))
    whole = F.col("value") == F.floor("value")
    return cells.withColumn("value", F.coalesce(F.when(whole, feet), F.lit(float(nodata))))


def wet_cells(cells: DataFrame, rasters: Sequence[Raster] | DataFrame) -> DataFrame:
    """Cells that carry a depth: grids of this run, without nodata, NaN and zero; of a repeated cell the deepest."""
    value = F.col("value")
    return (
        _header_lookup(cells.sparkSession, rasters, "nodata").join(cells, ["raster_id"], "inner")
        .where(value.isNotNull() & ~F.isnan(value) & (value != 0) & (value != F.col("nodata")))
        .groupBy("raster_id", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"))
        .agg(F.max(value).alias("value"))
    )


def _header_table(spark: SparkSession, rasters: Sequence[Raster] | DataFrame) -> tuple[DataFrame, list[Raster] | None]:
    known = known_headers(spark, rasters)
    if known is None:
        return headers(spark, rasters), None
    return spark.createDataFrame([tuple(getattr(r, f.name) for f in fields(r)) for r in known], HEADER), known


def _header_lookup(spark: SparkSession, rasters: Sequence[Raster] | DataFrame, *columns: str) -> Lookup:
    table, known = _header_table(spark, rasters)
    own = table.select("raster_id", *columns)
    return lookup(own) if known is None else Lookup(own, True)


def packed_cells(cells: DataFrame, rasters: Sequence[Raster] | DataFrame, tile: int = PACKED_TILE) -> DataFrame:
    """Wet cells as one row per tile that holds some: ``values`` has tile * tile entries by row, then column; dry ones are NULL.

    A join against tiles moves one row where a join against cells moves up to tile * tile, and a point then reads its
    depth by place.  Every tile is laid out with all its places before it is gathered, so a gathered group has exactly
    tile * tile rows.
    """
    at = {"trow": F.floor(F.col("row") / tile), "tcol": F.floor(F.col("col") / tile)}
    keys = ["raster_id", *at]
    wet = wet_cells(cells, rasters).select(
        "raster_id", *[c.alias(n) for n, c in at.items()],
        (F.pmod("row", F.lit(tile)) * tile + F.pmod("col", F.lit(tile))).cast("int").alias("place"), "value")
    empty = wet.select(*keys).distinct().select(
        *keys, F.explode(F.sequence(F.lit(0), F.lit(tile * tile - 1))).alias("place"), F.lit(None).cast("double").alias("value"))
    laid = wet.unionByName(empty).groupBy(*keys, "place").agg(F.max("value").alias("value"))
    placed = F.sort_array(F.collect_list(F.struct("place", "value")))
    return laid.groupBy(*keys).agg(F.transform(placed, lambda c: c["value"]).alias("values"))


def pack_cells(cells: DataFrame, rasters: Sequence[Raster] | DataFrame, tile: int = PACKED_TILE) -> PackedCells:
    return PackedCells(written_lookup(packed_cells(cells, rasters, tile)), tile)


def _with_value(cells: DataFrame | Lookup | PackedCells, indexed: DataFrame, rasters: Sequence[Raster] | DataFrame, how: str) -> DataFrame:
    """Numbered positions with the ``value`` of their cell; an inner join keeps wet cells only."""
    if not isinstance(cells, PackedCells):
        wet = cells if isinstance(cells, Lookup) else as_lookup(wet_cells(cells, rasters))
        return wet.join(indexed, ["raster_id", "row", "col"], how)
    n = cells.tile
    place = F.pmod("row", F.lit(n)) * n + F.pmod("col", F.lit(n))
    tiled = indexed.withColumns({"trow": F.floor(F.col("row") / n), "tcol": F.floor(F.col("col") / n), "_place": place.cast("int")})
    out = cells.lookup.join(tiled, ["raster_id", "trow", "tcol"], how).withColumn("value", F.get("values", "_place"))
    out = out.drop("values", "trow", "tcol", "_place")
    return out.where("value is not null") if how == "inner" else out


def _numbered(rows: DataFrame, columns: Sequence[str], x: Column, y: Column, truncate: bool) -> DataFrame:
    """Cell numbers of positions in the grid ``_g`` beside them."""
    out = rows.select(
        *columns,
        F.col("_g.raster_id").alias("raster_id"),
        geodesy.cell_number(y, F.col("_g.y0"), F.col("_g.ph"), flip=True, truncate=truncate).alias("row"),
        geodesy.cell_number(x, F.col("_g.x0"), F.col("_g.pw"), truncate=truncate).alias("col"),
        F.col("_g.width").alias("_w"), F.col("_g.height").alias("_h"),
    )
    inside = F.col("row").between(0, F.col("_h") - 1) & F.col("col").between(0, F.col("_w") - 1)
    return out.withColumn("inside", F.coalesce(inside, F.lit(False))).drop("_w", "_h")


def cell_index(points: DataFrame, rasters: Sequence[Raster] | DataFrame, lat: str = "Latitude", lon: str = "Longitude",
               truncate: bool = False) -> DataFrame:
    """Every point once per grid, with ``raster_id``, ``row``, ``col`` and ``inside``: for reports that name every pair.

    :func:`cell_hits` forms only the pairs where the point is inside.
    """
    table, known = _header_table(points.sparkSession, rasters)
    out = points.withColumn("_g", F.explode(_all_headers(table, known)))
    x, y = F.col(lon), F.col(lat)
    if known is None and not table.where("is_projected_metre").isEmpty() or any(r.is_projected_metre for r in known or ()):
        utm = F.when(F.col("_g.is_projected_metre"), geodesy.to_utm(lat, lon, F.col("_g.zone")))
        out = out.withColumn("_m", utm)
        x, y = F.coalesce("_m.easting", lon), F.coalesce("_m.northing", lat)
    return _numbered(out, points.columns, x, y, truncate)


def _all_headers(table: DataFrame, known: list[Raster] | None) -> Column:
    """All headers as one array: written out where they are few, else a scalar subquery."""
    if known is None or len(known) > WRITTEN_OUT:
        return table.agg(F.array_sort(F.collect_list(F.struct("*")))).scalar()
    return F.array(*[F.struct(*_written(r)) for r in known])


def _written(r: Raster) -> list[Column]:
    """The header's fields as literals."""
    return [F.lit(getattr(r, n)).cast(k).alias(n) for n, k in (f.split() for f in HEADER.split(", "))]


def _frames(table: DataFrame, known: list[Raster] | None) -> list[int]:
    """Reference frames in use: 0 for degrees, a zone, OWN_ZONE for each point's own zone."""
    if known is None:
        return sorted(r[0] for r in table.select(_frame().alias("f")).distinct().collect())
    return sorted({(r.zone or OWN_ZONE) if r.is_projected_metre else 0 for r in known})


def _frame(header: str = "") -> Column:
    at = f"{header}." if header else ""
    return F.when(F.col(f"{at}is_projected_metre"), F.coalesce(f"{at}zone", F.lit(OWN_ZONE))).otherwise(0)


def _n_tiles(rasters: list[Raster]) -> int:
    """Rows of the tile table of :func:`cell_hits`."""
    def along(low: float, high: float, size: float) -> int:
        return math.floor(high / size) - math.floor(low / size) + 1

    return sum(
        along(r.x0 - r.pw, r.x0 + r.pw * (r.width + 1), size) * along(r.y0 - r.ph * (r.height + 1), r.y0 + r.ph, size)
        for r in rasters for size in [TILE_METRES if r.is_projected_metre else TILE_DEGREES])


def outside_grids(points: DataFrame, rasters: Sequence[Raster] | DataFrame, lat: str = "Latitude", lon: str = "Longitude",
                  truncate: bool = False, name: str = "outside") -> DataFrame:
    """Points with the ids of the grids each is not in: all but those of :func:`cell_hits`, without forming a pair."""
    table, known = _header_table(points.sparkSession, rasters)
    frames = _frames(table, known)
    positions = []
    for f in frames:
        if f == 0:
            positions.append(F.struct(F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y")))
        else:
            m = geodesy.to_utm(lat, lon, None if f == OWN_ZONE else F.lit(f))
            positions.append(F.struct(F.coalesce(m["easting"], lon).alias("x"), F.coalesce(m["northing"], lat).alias("y")))
    at = F.array(*positions)

    def outside(g: Column, at: Column) -> Column:
        frame = F.when(g["is_projected_metre"], F.coalesce(g["zone"], F.lit(OWN_ZONE))).otherwise(0)
        here = F.get(at, F.array_position(F.array(*map(F.lit, frames)), frame).cast("int") - 1) if len(frames) > 1 else F.get(at, F.lit(0))
        row = geodesy.cell_number(here["y"], g["y0"], g["ph"], flip=True, truncate=truncate)
        col = geodesy.cell_number(here["x"], g["x0"], g["pw"], truncate=truncate)
        return ~F.coalesce(row.between(0, g["height"] - 1) & col.between(0, g["width"] - 1), F.lit(False))

    if not frames:
        return points.withColumn(name, F.array().cast("array<string>"))
    if known is not None and len(known) <= WRITTEN_OUT:
        # Written out, as a function over an array of headers would take the stage out of generated code.
        placed = points.withColumn("_at", at)
        ids = [F.when(outside(F.struct(*_written(r)), F.col("_at")), F.lit(r.raster_id)) for r in known]
        no_id = F.array(F.lit(None).cast("string"))
        return placed.withColumn(name, F.array_except(F.array(*ids), no_id)).drop("_at")
    out = points.withColumn("_all", _all_headers(table, known))
    return out.withColumn(name, F.transform(F.filter("_all", lambda g: outside(g, at)), lambda g: g["raster_id"])).drop("_all")


def cell_hits(points: DataFrame, rasters: Sequence[Raster] | DataFrame, lat: str = "Latitude", lon: str = "Longitude",
              truncate: bool = False) -> DataFrame:
    """Points with each grid they lie in: ``raster_id``, ``row`` and ``col``.

    Points and grids meet by an equality join on coarse tiles (a degree, or 100 km of a UTM zone), so a point forms no
    pair with a distant grid.  Positions are worked out once per reference frame, of which there are 62 at most:
    degrees, each zone, and each point's own zone.
    """
    table, known = _header_table(points.sparkSession, rasters)
    metre = F.col("is_projected_metre")
    size = F.when(metre, TILE_METRES).otherwise(TILE_DEGREES)
    left, right = F.col("x0") - F.col("pw"), F.col("x0") + F.col("pw") * (F.col("width") + 1)
    low, high = F.col("y0") - F.col("ph") * (F.col("height") + 1), F.col("y0") + F.col("ph")
    tiles = (
        table.select(F.struct("*").alias("_g"), _frame().alias("_frame"), F.explode(_tiles(left, right, size)).alias("_tx"),
                     _tiles(low, high, size).alias("_ys"))
        .select("_g", "_frame", "_tx", F.explode("_ys").alias("_ty"))
    )
    tiles = lookup(tiles) if known is None else Lookup(tiles, _n_tiles(known) <= BROADCAST_ROWS)
    frames = _frames(table, known)
    out = points.withColumn("_frame", F.explode(F.array(*map(F.lit, frames))) if len(frames) > 1 else F.lit(frames[0] if frames else 0))
    if frames and frames != [0]:
        zone = F.when(F.col("_frame") != OWN_ZONE, F.col("_frame"))
        out = out.withColumn("_m", F.when(F.col("_frame") != 0, geodesy.to_utm(lat, lon, zone)))
        x, y = F.coalesce("_m.easting", lon), F.coalesce("_m.northing", lat)
    else:
        x, y = F.col(lon), F.col(lat)
    unit = F.when(F.col("_frame") == 0, TILE_DEGREES).otherwise(TILE_METRES)
    out = out.withColumns({"_x": x.cast("double"), "_y": y.cast("double")}).withColumns(
        {"_tx": F.floor(F.col("_x") / unit), "_ty": F.floor(F.col("_y") / unit)})
    met = tiles.join(out, ["_frame", "_tx", "_ty"], "inner")
    return _numbered(met, points.columns, F.col("_x"), F.col("_y"), truncate).where("inside").drop("inside")


def _tiles(low: Column, high: Column, size: Column) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def sample_inside(points: DataFrame, cells: DataFrame | Lookup | PackedCells, rasters: Sequence[Raster] | DataFrame,
                  lat: str = "Latitude", lon: str = "Longitude", truncate: bool = False) -> DataFrame:
    """Points once per grid they lie in, with ``GridName`` and ``Depth_Grid``, which is 0 off the wet cells."""
    indexed = cell_hits(points, rasters, lat, lon, truncate)
    return _sampled(points, _with_value(cells, indexed, rasters, "left"))


def _sampled(points: DataFrame, valued: DataFrame) -> DataFrame:
    return valued.select(
        *points.columns, F.col("raster_id").alias("GridName"), F.coalesce("value", F.lit(0.0)).alias("Depth_Grid"))


def sample_depth(points: DataFrame, cells: DataFrame | Lookup | PackedCells, rasters: Sequence[Raster] | DataFrame,
                 lat: str = "Latitude", lon: str = "Longitude", wet_only: bool = False,
                 truncate: bool = False) -> DataFrame:
    """Grid depth at every point, once per grid; outside the extent or on nodata it is 0.

    ``cells`` is a cell table, which is filtered here, a :class:`Lookup` of wet cells (see :func:`wet_cells`) or
    :class:`PackedCells`, both used as given.  ``wet_only`` keeps only points on a wet cell, and then forms
    pairs only with the grids that hold the point; without it the result itself is every pair.
    Points outside the extent get a spread-out key that matches no cell, so they do not
    gather in one shuffle partition.
    """
    if wet_only:
        indexed = cell_hits(points, rasters, lat, lon, truncate)
    else:
        spread = -1 - F.pmod(F.xxhash64(lat, lon), F.lit(OUTSIDE_KEYS))
        indexed = cell_index(points, rasters, lat, lon, truncate)
        indexed = indexed.withColumn("row", F.when(F.col("inside"), F.col("row")).otherwise(spread))
    return _sampled(points, _with_value(cells, indexed, rasters, "inner" if wet_only else "left"))


def wet_bitmaps(cells: DataFrame, rasters: Sequence[Raster] | DataFrame, tile: int = 8) -> DataFrame:
    """Tiles with a wet cell as bitmaps: raster_id, bucket, bits; exact.

    A bitmap of 4 KB stands for 32,768 tiles, so a million tiles take 125 KB per grid, where a table of tiles takes
    tens of MB.  Bits are set in every task before the bitmaps of a bucket are joined.
    """
    sizes = _header_lookup(cells.sparkSession, rasters, "width", "height")
    wet = sizes.join(wet_cells(cells, rasters).where("value > 0"), ["raster_id"], "inner")
    inside = F.col("row").between(0, F.col("height") - 1) & F.col("col").between(0, F.col("width") - 1)
    return (
        wet.where(inside).withColumn("_n", _tile_number(tile))
        .groupBy("raster_id", F.bitmap_bucket_number("_n").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits"))
    )


def _tile_number(tile: int) -> Column:
    """Number from 1 of a cell's tile in its grid of ``width`` columns, by row."""
    across = F.floor((F.col("width") - 1) / tile) + 1
    return F.floor(F.col("row") / tile) * across + F.floor(F.col("col") / tile) + 1


def _bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def wet_tiles(points: DataFrame, cells: DataFrame, rasters: Sequence[Raster] | DataFrame, tile: int = 8,
              lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Points, with each grid in which their tile holds a wet cell: a cheap footprint prefilter.

    Tiles are tested in bitmaps (see :func:`wet_bitmaps`), so no row per tile is joined and no point passes by mistake.
    """
    sizes = _header_lookup(points.sparkSession, rasters, "width")
    hit = sizes.join(cell_hits(points, rasters, lat, lon), ["raster_id"], "inner").withColumn("_n", _tile_number(tile))
    hit = hit.withColumn("bucket", F.bitmap_bucket_number("_n"))
    met = written_lookup(wet_bitmaps(cells, rasters, tile)).join(hit, ["raster_id", "bucket"], "inner")
    return met.where(_bit_is_set(F.col("bits"), F.bitmap_bit_position("_n"))).select(*points.columns, "raster_id")


def selectivity(points: DataFrame, cells: DataFrame | Lookup | PackedCells, rasters: Sequence[Raster] | DataFrame,
                lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Per grid: buildings in total, inside the extent and on a wet cell, with percentages."""
    hits = cell_hits(points.select(lat, lon), rasters, lat, lon)
    inside = _with_value(cells, hits, rasters, "left").groupBy("raster_id").agg(
        F.count("*").alias("in_extent"), F.count_if(F.col("value") > 0).alias("on_wet_cell"))
    total = points.agg(F.count("*").alias("n")).scalar()
    grids = _header_table(points.sparkSession, rasters)[0].select("raster_id", total.alias("buildings"))
    out = grids.where("buildings > 0").join(inside, "raster_id", "left").na.fill(0, ["in_extent", "on_wet_cell"])
    return out.select("*", (F.col("in_extent") * 100 / F.col("buildings")).alias("in_extent_pct"),
                      (F.col("on_wet_cell") * 100 / F.col("buildings")).alias("on_wet_pct"))
