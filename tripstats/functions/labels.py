"""Labels that carry the fleet: ``Queens_Yellow``, ``May (Yellow)``."""

from __future__ import annotations

import calendar
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripstats.model import FLEETS

# ---- fixed values -----------------------------------------------------------
# Boroughs that the fixed-list labelling knows; any other name keeps its text.
LABELLED_BOROUGHS = ("Manhattan", "Queens", "Unknown", "Brooklyn", "Bronx")
LABELLED_YEAR = 2023
LABELLED_MONTHS = range(1, 8)
# -----------------------------------------------------------------------------


def fleet_label(taxi_type: Column) -> Column:
    """``yellow_taxi`` -> ``Yellow``; an unknown tag keeps its text."""
    label = taxi_type
    for fleet in FLEETS:
        label = F.when(taxi_type == fleet.tag, F.lit(fleet.label)).otherwise(label)
    return label


def with_fleet_suffix(name: Column, taxi_type: Column) -> Column:
    """Every name gets its fleet; a NULL name stays NULL."""
    return F.concat(name, F.lit("_"), fleet_label(taxi_type))


def _quoted(name: str) -> str:
    """A name as it is inside a pattern."""
    return "\\Q" + name.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def listed_with_fleet_suffix(
    name: Column, taxi_type: Column, names: Iterable[str] = LABELLED_BOROUGHS
) -> Column:
    """Only the listed names, wherever they occur in the text, get the fleet."""
    quoted = [_quoted(x) for x in names]
    if not quoted:
        return name
    return F.regexp_replace(
        name, F.lit(f"({'|'.join(quoted)})"), F.concat(F.lit("$1_"), fleet_label(taxi_type))
    )


def month_with_fleet(month: Column, taxi_type: Column) -> Column:
    """``2024-05`` -> ``2024-05 (Yellow)``, for any month."""
    return F.concat(month, F.lit(" ("), fleet_label(taxi_type), F.lit(")"))


def listed_month_with_fleet(
    month: Column,
    taxi_type: Column,
    year: int = LABELLED_YEAR,
    months: Iterable[int] = LABELLED_MONTHS,
) -> Column:
    """``2023-05`` -> ``May (Yellow)``; months outside the list keep their text."""
    named = [
        F.when(month == f"{year}-{number:02d}", F.lit(calendar.month_name[number]))
        for number in months
    ]
    if not named:
        return month
    return F.coalesce(month_with_fleet(F.coalesce(*named), taxi_type), month)
