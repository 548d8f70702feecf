"""Text splitting, safe casts and GeoJSON feature fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The GeoJSON feature layout and the property that names a zone.
FEATURE_SCHEMA = "properties map<string,string>, geometry struct<type:string,coordinates:string,geometries:string>"
ZIP_PROPERTY = "ZCTA5CE10"
COORD_TYPE = "decimal(10,6)"


def split_part(text: Column | str, pattern: str, index: int) -> Column:
    """Piece ``index`` (from 0) of a regex split; NULL when there are fewer pieces."""
    return F.get(F.split(text, pattern), F.lit(index))


def is_castable(text: Column | str, type_name: str = "int") -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast(type_name).isNotNull()


def decimal_coord(value: Column | str) -> Column:
    """A coordinate with six decimals; NULL when it does not parse or does not fit."""
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast(COORD_TYPE)


def feature(line: Column | str) -> Column:
    """One GeoJSON feature line as a struct; coordinates stay raw JSON text."""
    return F.from_json(line, FEATURE_SCHEMA)


def feature_zip(parsed: Column, property_name: str = ZIP_PROPERTY) -> Column:
    return F.try_element_at(parsed["properties"], F.lit(property_name))


def clean_geometry(parsed: Column) -> Column:
    """The geometry as GeoJSON text with the quotes around coordinates removed; of a collection, those around numbers."""
    geometry = parsed["geometry"]
    plain = F.concat(
        F.lit('{"type":"'),
        geometry["type"],
        F.lit('","coordinates":'),
        F.regexp_replace(geometry["coordinates"], F.lit('"'), F.lit("")),
        F.lit("}"),
    )
    members = F.regexp_replace(geometry["geometries"], r'"(-?[0-9][-+.0-9eE]*)"', "$1")
    collection = F.concat(F.lit('{"type":"GeometryCollection","geometries":'), members, F.lit("}"))
    return F.when(geometry["type"] == "GeometryCollection", collection).otherwise(plain)
