"""Cleaning of sentinel values and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import refdata as ref


def clean_sog(sog: Column) -> Column:
    """Speed over ground, or null when missing, NaN or the not-available value."""
    return F.when(~F.isnan(sog) & (sog < ref.SOG_NOT_AVAILABLE), sog)


def clean_cog(cog: Column) -> Column:
    return F.when(cog < ref.COG_NOT_AVAILABLE, cog)


def clean_heading(heading: Column) -> Column:
    return F.when(heading != ref.HEADING_NOT_AVAILABLE, heading)


def clean_destination(text: Column) -> Column:
    shout = F.upper(F.trim(text))
    return F.when(~shout.isin(ref.EMPTY_DESTINATIONS), shout)


def mask_mmsi(mmsi: Column) -> Column:
    return F.concat(F.substring(mmsi, 1, 6), F.lit("***"))
