"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column

# Stored keys were hashed with them.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(fields: Sequence[str | Column], nulls_as_empty: bool = False) -> Column:
    """MD5 of the fields as text, joined by a dash; NULLs hash as a token."""
    if isinstance(fields, (str, Column)):
        raise TypeError("surrogate_key takes a list of fields")
    token = F.lit("" if nulls_as_empty else NULL_TOKEN)
    texts = [F.coalesce(as_column(field).cast("string"), token) for field in fields]
    return F.md5(F.concat_ws(SEPARATOR, *texts))
