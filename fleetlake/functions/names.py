"""What a file name says: its type, how it matched, and the arrival date in its stamp."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.registry import FILE_TYPES

# --- Fixed values: the naming convention of incoming files. -------------------------------
STRICT_NAME = r"^([a-z_]+)_\d{14}\.json$"
STAMP = r"(\d{14})"
STAMP_FORMAT = "yyyyMMddHHmmss"
PLURAL_PREFIX = "^vehicles_"
SINGULAR_PREFIX = "vehicle_"
# -----------------------------------------------------------------------------------------


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def decoded(uri: Column) -> Column:
    """A file URI as a plain path; in URIs, unlike in forms, a plus sign means itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def strict_type(name: Column, types: Iterable[str] = tuple(FILE_TYPES)) -> Column:
    """The type of a name that follows the convention, plural or singular; else null."""
    prefix = F.regexp_extract(F.lower(name), STRICT_NAME, 1)
    singular = F.regexp_replace(prefix, PLURAL_PREFIX, SINGULAR_PREFIX)
    return F.when(singular.isin(*types), singular)


def contained_type(name: Column, types: Iterable[str] = tuple(FILE_TYPES)) -> Column:
    """The first type, in registry order, that occurs anywhere in the name; else null."""
    return F.coalesce(*[F.when(F.lower(name).contains(t), F.lit(t)) for t in types])


def stamp_of(name: Column) -> Column:
    """The first run of fourteen digits, null when there is none."""
    return F.nullif(F.regexp_extract(name, STAMP, 1), F.lit(""))


def stamp_is_valid(stamp: Column) -> Column:
    """True without a stamp; with one, true only if it is a real date and time."""
    return stamp.isNull() | F.try_to_timestamp(stamp, F.lit(STAMP_FORMAT)).isNotNull()


def partition_date(stamp: Column, ingest_date: Column) -> Column:
    """Arrival date: from the stamp, or ``ingest_date`` without one; null for a bad stamp.

    The date is cut from the digits, so no session time zone can move it.
    """
    digits = F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2))
    return F.when(stamp.isNull(), ingest_date).when(stamp_is_valid(stamp), digits.try_cast("date"))
