"""Distances and place keys as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import AFRICA

EARTH_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres; infinite if a coordinate is missing."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.coalesce(2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0)))), F.lit(float("inf")))


def geo_key(name: Column, aliases: dict[str, str]) -> Column:
    """Coarse place: the alias of the whole name, of the name before a comma, or of a word; else the name in capitals; UNKNOWN without one."""
    known = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv))
    whole = F.trim(F.lower(name))
    first = F.trim(F.element_at(F.split(whole, ","), 1))
    word = F.get(F.filter(F.transform(F.split(whole, "[ ,]+"), lambda w: known[w]), lambda x: x.isNotNull()), F.lit(0))
    return F.coalesce(known[whole], known[first], word, F.when(whole != "", F.upper(whole)), F.lit("UNKNOWN"))


def places_in(text: Column, parents: dict[str, str | None]) -> Column:
    """Places a text names, each with the places that hold it."""
    closure: dict[str, list[str]] = {}
    for p in parents:
        chain, at = [], p
        while at and at not in chain:
            chain.append(at)
            at = parents.get(at)
        closure[p] = chain
    named = "|".join(sorted(parents, key=lambda x: (-len(x), x)))
    of = F.create_map(*(x for p, c in closure.items() for x in (F.lit(p), F.array(*map(F.lit, c)))))
    return F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"\b({named})\b"), F.lit(1)), lambda p: of[p])))


def places_disagree(a: Column, b: Column) -> Column:
    """Both name places, and none in common."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def in_africa(iso: Column) -> Column:
    """Whether a country code is African; a missing one isn't."""
    return F.coalesce(F.upper(F.trim(iso)).isin(*AFRICA), F.lit(False))
