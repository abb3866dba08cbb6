"""Qualified-name expressions: part counts, catalog prefix, stage paths, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_parts(name: Column) -> Column:
    """Number of '.'-separated parts (0 for null or empty)."""
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(name, r"\.")))


def part(name: Column, i: int) -> Column:
    """The i-th (0-based) part of a dotted name; null when absent (ANSI-safe)."""
    return F.try_element_at(F.split(name, r"\."), F.lit(i + 1))


def qualify(name: Column, catalog: str) -> Column:
    """3-part names are kept; others get ``catalog.`` in front."""
    return F.when(name_parts(name) == 3, name).otherwise(F.concat(F.lit(f"{catalog}."), name))


def empty_to_null(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(None).cast("string")).otherwise(c)


def parse_flag(text: Column) -> Column:
    """'true'/'false' text (any case, padded) to boolean; anything else null."""
    t = F.lower(F.trim(text))
    return F.when(t == "true", F.lit(True)).when(t == "false", F.lit(False))


def stage_path(root: str, target: Column, source: Column) -> Column:
    """``root/<target catalog>/<source parts joined by __>`` (null parts skipped)."""
    src = F.concat_ws("__", part(source, 0), part(source, 1), part(source, 2))
    return F.concat_ws("/", F.lit(root), part(target, 0), src)
