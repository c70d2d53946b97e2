"""Evaluate costly columns once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Select ``keep`` and the given columns, each evaluated once per row.

    A filter on a plain computed column moves below the projection and takes a
    copy of the expression along; over a chain of such columns the copies
    multiply.  A generator with one row of output is a line filters on its
    columns do not cross, and it needs no shuffle.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline_outer(F.array(row)))
