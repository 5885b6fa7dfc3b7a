"""Code -> label lookups as map literals."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import refdata as ref


def _map_literal(table: dict) -> Column:
    """The table as one SQL text; Catalyst folds it into a constant."""
    return F.expr("map(" + ", ".join(repr(x) for x in chain.from_iterable(table.items())) + ")")


def flag_of(mmsi: Column) -> Column:
    return F.try_element_at(_map_literal(ref.FLAG_BY_MID), F.substring(mmsi, 1, 3))


def nav_label(code: Column) -> Column:
    """Label of a status code; reserved codes become unknown_<code>, null stays null."""
    known = F.try_element_at(_map_literal(ref.NAV_STATUS), code)
    return F.coalesce(known, F.concat(F.lit("unknown_"), code.cast("string")))


def ship_category(code: Column) -> Column:
    """Category of a ship-type code; unlisted codes are "other", null stays null."""
    table = {code: label for low, high, label in ref.SHIP_TYPE_RANGES for code in range(low, high + 1)}
    known = F.coalesce(F.try_element_at(_map_literal(table), code), F.lit(ref.SHIP_TYPE_FALLBACK))
    return F.when(code.isNotNull(), known)


def speed_limit(category: Column) -> Column:
    """Knots allowed for a ship category: eleven fixed rows, so a map literal instead of a join."""
    table = ", ".join(f"'{name}', {knots!r}D" for name, knots in ref.SPEED_LIMIT_KNOTS.items())
    limit = F.try_element_at(F.expr(f"map({table})"), category)
    return F.coalesce(limit, F.lit(ref.DEFAULT_SPEED_LIMIT_KNOTS))
