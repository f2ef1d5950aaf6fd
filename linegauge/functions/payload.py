"""Helpers for landed payload fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(value: Column) -> Column:
    """JSON text of a VARIANT; absent and JSON null both become NULL, an empty list stays ``[]``."""
    return F.when(~F.is_variant_null(value), F.to_json(value))
