"""Identifier slugs, for names on the driver and for values in a column."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column

# Blanks and dashes to one underscore, drop the rest, no leading digit.
# The first item is a pattern, the second its replacement with $1 for the group.
SLUG_STEPS = (
    (r"[ -]+", "_"),
    (r"[^a-z0-9_]+", ""),
    (r"^([0-9])", "_$1"),
)


def slugify(name: str) -> str:
    """Slug of one name."""
    return reduce(
        lambda text, step: re.sub(step[0], step[1].replace("$", "\\"), text), SLUG_STEPS, name.lower()
    )


def slug(value: str | Column) -> Column:
    """Slug of every value of a column."""
    return reduce(
        lambda text, step: F.regexp_replace(text, step[0], step[1]), SLUG_STEPS, F.lower(as_column(value))
    )
