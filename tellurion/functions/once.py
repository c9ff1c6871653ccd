"""Columns that are computed once however often later steps use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(rows: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column behind a one-element explode.

    Filters on a column are rewritten in terms of its inputs and moved down, so
    a filter on the outcome of a hundred checks would compute all of them, and
    the document they read, once more. A filter on this column stays above it,
    while filters on other columns still move to the scan. The column itself is
    computed in a projection, which is compiled; the explode only passes it on.
    Rows are neither added nor dropped and nothing is shuffled.
    """
    computed = rows.withColumn("_once", column)
    return computed.select(*rows.columns, F.explode(F.array("_once")).alias(name))
