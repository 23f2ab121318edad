"""Join helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_broadcast(small: DataFrame) -> DataFrame:
    """Broadcast a table whose size is fixed by construction (not by data).

    Tables whose size depends on data are joined without a hint: stored ones
    have a known file size, the others a measured one when the join is planned
    anew at run time.
    """
    return F.broadcast(small)


def few_rows(small: DataFrame) -> DataFrame:
    """A side of a join of two small tables, which meet by a shuffle of their few rows.  Without the hint the planner
    broadcasts one of them, and a broadcast keyed by text takes a whole memory page (up to 64 MB, by the heap) on the
    driver and on every executor, however few its rows.
    """
    return small.hint("merge")
