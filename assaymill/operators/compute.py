"""Keeping expensive columns from being computed more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .. import sqltext as sql


def computed_once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same table, with the given columns computed before anything that follows looks at them.

    A filter on a computed column normally moves below the computation, where every mention of the
    column repeats its whole expression: right for cheap expressions over a scan, wrong for chains
    of regular expressions. Passing the columns through a one-element generator keeps the filter
    above. Other columns are untouched and can still be pruned.
    """
    wanted = [c for c in df.columns if c in set(columns)]
    if not wanted:
        return df
    others = [sql.name(c) for c in df.columns if c not in wanted]
    once = sql.rows([{c: sql.name(c) for c in wanted}])
    return df.selectExpr(*others, once).select(*[sql.name(c) for c in df.columns])
