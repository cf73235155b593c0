"""Look-ups for lists of document ids, a whole table of requests at once.

``ids`` has one row per requested id: ``(req_id, pos, id)``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_list(requests: DataFrame) -> DataFrame:
    """``(req_id, ids array)`` to ``(req_id, pos, id)``; an empty list gives no rows."""
    return requests.select("req_id", F.posexplode("ids").alias("pos", "id"))


def first_ranks(ranks: DataFrame) -> DataFrame:
    """One rank per id: the first in file order if an id is listed more than once."""
    return ranks.groupBy("id").agg(F.min_by("rank", "row_no").alias("rank"))


def get_pagerank(ids: DataFrame, ranks: DataFrame, *, strict: bool = True) -> DataFrame:
    """``(req_id, pos, id, rank)`` in request order.

    An id without a rank is an error, or a null with ``strict=False``.
    """
    if "row_no" in ranks.columns:
        ranks = first_ranks(ranks)
    found = ids.join(ranks, "id", "left").select("req_id", "pos", "id", "rank")
    if strict:
        problem = F.concat(F.lit("no rank for id "), F.col("id").cast("string"))
        checked = F.when(F.col("rank").isNull(), F.raise_error(problem)).otherwise(
            F.col("rank")
        )
        found = found.withColumn("rank", checked)
    return found.orderBy("req_id", "pos")


def get_pageview(ids: DataFrame, views: DataFrame) -> DataFrame:
    """``(req_id, pos, id, views)`` in request order; ids without views drop out."""
    found = ids.join(views, "id").select("req_id", "pos", "id", "views")
    return found.orderBy("req_id", "pos")
