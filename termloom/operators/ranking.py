"""Orderings and cuts inside a group."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A cut first runs in this many pieces of each group.
PIECES = 64


def top_per_group(
    rows: DataFrame,
    group: str,
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    spread: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered in column ``rank``.

    With ``spread``, a column that differs inside the group, groups may be of any size:
    the cut is made in pieces first, and one task never sees more than ``PIECES * n``
    rows of a group.  Spark drops rows beyond ``n`` before either shuffle.
    """
    if spread is not None:
        piece = F.pmod(F.xxhash64(spread), F.lit(PIECES)).alias("_piece")
        by_piece = Window.partitionBy(group, "_piece").orderBy(*order)
        rows = (
            rows.select("*", piece)
            .withColumn("_place", F.row_number().over(by_piece))
            .filter(F.col("_place") <= n)
            .drop("_piece", "_place")
        )
    by_group = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(by_group)).filter(F.col(rank) <= n)
