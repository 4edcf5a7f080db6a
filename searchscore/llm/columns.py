"""Names for working columns."""
from __future__ import annotations

from pyspark.sql import DataFrame


def fresh_prefix(*tables: DataFrame) -> str:
    """A prefix that no column of ``tables`` begins with, whatever its case."""
    prefix = "__"
    while any(c.startswith(prefix) for t in tables for c in t.columns):
        prefix += "_"
    return prefix
