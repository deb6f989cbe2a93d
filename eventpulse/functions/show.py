"""Figures as text: columns of text made in the query that makes the figures, by one table of kinds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(n: Column) -> Column:
    return F.format_number(n.cast("bigint"), 0)


def _unless_nothing(whole: Column, text: Column) -> Column:
    """What has no denominator is an error of the query: no plausible zero is made up."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.raise_error(F.lit("a share of nothing")).cast("string")).otherwise(text)


#: Kinds of figures: how the columns of one become text with so many places.
KINDS = {
    "count": lambda places, n: _digits(F.coalesce(n, F.lit(0))),
    "number": lambda places, x: F.format_string(f"%.{places}f", x.cast("double")),
    "percent": lambda places, x: F.format_string(f"%.{places}f%%", x.cast("double")),
    "times": lambda places, x: F.format_string(f"%.{places}f×", x.cast("double")),
    "share": lambda places, part, whole: _unless_nothing(whole, F.format_string(f"%.{places}f%%", 100.0 * F.coalesce(part, F.lit(0)) / whole)),
    "bytes": lambda places, n: F.format_string(f"%.{places}f GiB (%s bytes)", n / F.lit(float(1 << 30)), _digits(n)),
    "text": lambda places, x: x.cast("string"),
}


def cell(kind: str, *columns: str, places: int = 2) -> Column:
    """A figure as text. ``columns`` are names."""
    return KINDS[kind](places, *map(F.col, columns))


def shortened(items: Iterable, most: int = 10) -> str:
    """The first ``most`` items, and how many more there are."""
    told = list(map(str, items))
    return ", ".join(told[:most]) + (f" (+{len(told) - most} more)" if len(told) > most else "")
