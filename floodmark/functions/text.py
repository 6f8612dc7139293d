"""Text columns: normalise identifiers, codes and names.  Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as fv


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(mapping: dict, key: Column) -> Column:
    """Value of ``key`` in a literal map, NULL when absent."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def norm_occ(col) -> Column:
    """Occupancy class: upper case, text before the first ``-``."""
    return F.upper(F.split_part(_col(col), F.lit("-"), F.lit(1)))


def foundation_code(col) -> Column:
    """Foundation text to its numeric code; unknown and missing give the slab code."""
    code = _lookup(fv.FOUNDATION_CODES, F.upper(F.trim(_col(col))))
    return F.coalesce(code, F.lit(fv.FOUNDATION_DEFAULT))


def norm_fips(col, width: int = 15) -> Column:
    """Keep the digits of a geography code and left-pad with zeros; blank gives NULL."""
    digits = F.regexp_replace(_col(col).cast("string"), "[^0-9]", "")
    return F.when(digits != "", F.lpad(digits, width, "0"))


def clean_cell(col) -> Column:
    """Trim a text cell; blank and the words nan, none, null give NULL."""
    text = F.trim(_col(col).cast("string"))
    return F.when(~F.lower(text).isin("", "nan", "none", "null"), text)


def clean_text(col) -> Column:
    """Trim, collapse inner whitespace and fold case."""
    return F.lower(F.regexp_replace(F.trim(_col(col)), "\\s+", " "))


def norm_flood_class(col) -> Column:
    """Flood class spelling to the engine's class code; unknown text passes through trimmed."""
    text = F.trim(F.coalesce(_col(col), F.lit("")))
    return F.coalesce(_lookup(fv.FLOOD_CLASS_CODES, F.lower(text)), text)


def norm_flood_condition(col) -> Column:
    """Run-parameter spelling of the flood class; spaces, ``_`` and ``-`` are ignored."""
    text = F.trim(F.coalesce(_col(col), F.lit("CoastalA")))
    key = F.lower(F.regexp_replace(text, "[\\s_-]+", ""))
    return F.coalesce(_lookup(fv.FLOOD_CLASS_NAMES, key), text)


def parse_range_pct(col) -> Column:
    """First number of a range text such as ``11 - 34``; above one it is a percentage."""
    number = F.regexp_extract(_col(col), "([\\d.]+)", 1).try_cast("double")
    return F.when(number > 1, number / 100).otherwise(number)


def state_key(col) -> Column:
    """Lookup key of a state written as two digits, two letters or a name."""
    token = F.trim(_col(col))
    name = F.lower(F.regexp_replace(F.trim(F.regexp_replace(token, "[_-]", " ")), "\\s+", " "))
    return (
        F.when(token.rlike("^[0-9]{2}$"), token)
        .when(token.rlike("^[A-Za-z]{2}$"), F.upper(token))
        .otherwise(name)
    )


def state_partition(col) -> Column:
    """State name as written in partition values: words title-cased and joined by ``_``."""
    return F.regexp_replace(F.initcap(F.regexp_replace(F.trim(_col(col)), "[_-]", " ")), " ", "_")


_STORM_ID = "^([A-Z]{2})([0-9]{1,2})([0-9]{2,4})?$"


def norm_storm_id(col, year) -> Column:
    """Storm id as basin, two-digit number, four-digit year; other text gets the year appended."""
    text = F.upper(F.trim(_col(col)))
    year = F.lit(year) if isinstance(year, int) else _col(year)
    given = F.regexp_extract(text, _STORM_ID, 3)
    full_year = (
        F.when(F.length(given) == 4, given)
        .when(F.length(given) > 0, F.concat(F.lit("20"), given))
        .otherwise(year.cast("string"))
    )
    number = F.lpad(F.regexp_extract(text, _STORM_ID, 2), 2, "0")
    return F.when(
        text.rlike(_STORM_ID), F.concat(F.regexp_extract(text, _STORM_ID, 1), number, full_year)
    ).otherwise(F.concat(text, year.cast("string")))


def storm_id_variants(normalized, year) -> Column:
    """Distinct spellings of a storm id, short year first."""
    full = _col(normalized)
    year = F.lit(year) if isinstance(year, int) else _col(year)
    short = F.concat(F.substring(full, 1, 4), F.right(year.cast("string"), F.lit(2)))
    return F.array_distinct(F.array(short, full))


def advisory_variants(adv) -> Column:
    """Distinct spellings of an advisory number: plain, then three digits."""
    number = _col(adv).cast("int").cast("string")
    padded = F.when(F.length(number) >= 3, number).otherwise(F.lpad(number, 3, "0"))
    return F.array_distinct(F.array(number, padded))


def raster_name(storm_name, year, adv) -> Column:
    """File name of a surge raster."""
    return F.concat(
        F.upper(F.trim(_col(storm_name))), F.lit("_"), _col(year).cast("string"),
        F.lit("_adv"), _col(adv).cast("int").cast("string"), F.lit("_e10_ResultMaskRaster.tif"),
    )


_RASTER_NAME = "^(.+)_([0-9]{4})_adv([0-9]+)_e([0-9]+)_"


def parse_raster_name(col) -> Column:
    """Struct of event, year, advisory and exceedance parsed from a raster file name."""
    text = _col(col)

    def part(i, kind):
        return F.nullif(F.regexp_extract(text, _RASTER_NAME, i), F.lit("")).cast(kind)

    return F.struct(
        F.concat_ws("_", part(1, "string"), part(2, "string")).alias("event"),
        part(1, "string").alias("storm"),
        part(2, "int").alias("year"),
        part(3, "int").alias("adv"),
        part(4, "int").alias("exceedance"),
    )


def building_key(bid, lat, lon) -> Column:
    """Digest of building id and position, for inventories whose ids repeat."""
    return F.sha2(F.concat_ws("|", *(_col(c).cast("string") for c in (bid, lat, lon))), 256)
