"""Parts of URLs, also of URLs without a scheme."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column

# Schemes cut off. The path function leaves app links alone.
HOST_SCHEMES = ("android-app://", "http://", "https://")
PATH_SCHEMES = ("http://", "https://")


def _without(url: Column, schemes: tuple[str, ...]) -> Column:
    return reduce(lambda text, scheme: F.replace(text, F.lit(scheme), F.lit("")), schemes, url)


def _part(text: Column, separator: str, number: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(number))


def url_host(url: str | Column) -> Column:
    """Everything before the first slash or question mark, port included."""
    return _part(_part(_without(as_column(url), HOST_SCHEMES), "/", 1), "?", 1)


def url_path(url: str | Column) -> Column:
    """What follows the first slash, up to the question mark.

    A URL with neither slash nor question mark is returned whole.
    """
    rest = _without(as_column(url), PATH_SCHEMES)
    slash = F.nullif(F.instr(rest, "/"), F.lit(0))
    skipped = F.coalesce(slash, F.instr(rest, "?") - 1)
    return _part(F.right(rest, F.length(rest) - skipped), "?", 1)


def url_parameter(url: str | Column, name: str) -> Column:
    """Value of a query parameter; NULL where it is missing or empty."""
    return F.nullif(_part(_part(as_column(url), f"{name}=", 2), "&", 1), F.lit(""))
