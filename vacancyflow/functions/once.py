"""Computing a column exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """`rows` with further columns that later filters see as results.

    Catalyst pushes a filter below a projection by writing the projected expressions into it, each time
    they are named. For URL work that multiplies regex calls and lets the generated code outgrow the JVM's
    method size. A one-row generator stays where it is, and still runs inside whole-stage code.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))
