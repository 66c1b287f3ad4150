"""Identifier, address and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import STATE_NAMES


def strip_query(href: Column) -> Column:
    return F.substring_index(href, "?", 1)


def coord_number(location_id: Column) -> Column:
    """n of ``coord_n``; null for any other id."""
    return F.when(F.startswith(location_id, F.lit("coord_")), F.substring(location_id, 7, 20).try_cast("bigint"))


def tile_of_uri(uri: Column) -> Column:
    """The tile that a surface file is named after."""
    stem = F.regexp_replace(F.substring_index(uri, "/", -1), r"\.[^.]*$", "")
    return F.substring_index(stem, "__", 1)


def county_fips(block: Column) -> Column:
    return F.substring(block, 1, 5)


def state_fips(county: Column) -> Column:
    return F.substring(county, 1, 2)


def state_name(state: Column) -> Column:
    """The state's name, or its code where it has none."""
    names = F.create_map(*[F.lit(x) for pair in STATE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, state), state)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, "—").otherwise(F.concat(F.format_string("%.1f", F.round(100.0 * part / F.when(whole != 0, whole), 1)), F.lit("%")))


def keyword_score(keywords: list[str], *fields: Column) -> Column:
    """How many keywords stand in the joined fields; 1 for all if there are no keywords."""
    words = [k.lower() for k in keywords if str(k).strip()]
    if not words:
        return F.lit(1)
    hay = F.lower(F.concat_ws(" ", *fields))
    return sum((F.contains(hay, F.lit(k)).cast("int") for k in words[1:]), F.contains(hay, F.lit(words[0])).cast("int"))
