"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the reference's for the hashes to agree.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
MISSING_ID = -1


def _text(column: str) -> str:
    return f"coalesce(cast({column} as string), '{NULL_MARKER}')"


def surrogate_key(*columns: str) -> Column:
    """MD5 of the columns' texts joined by '-', a NULL standing in as a fixed marker.

    Pass integers and dates only: the text of a double differs between engines.
    """
    return F.expr(f"md5(concat_ws('-', {', '.join(map(_text, columns))}))")


def missing_key() -> Column:
    """The key of a dimension's missing-member row."""
    return F.expr(f"md5('{MISSING_ID}')")


def keyed_nulls(column: str) -> Column:
    """The surrogate key, a NULL pointing at the missing member."""
    return F.expr(f"if({column} is null, md5('{MISSING_ID}'), md5({_text(column)}))")
