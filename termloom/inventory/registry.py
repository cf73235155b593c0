"""The table of registered queries: a DataFrame job and, where possible, its SQL."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.inventory import sql as parts
from termloom.inventory.corpus import Corpus


@dataclass(frozen=True)
class Registered:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None = None):
    """Register ``job(corpus) -> DataFrame`` with the SQL that gives the same rows.

    The SQL may use any of the common table expressions in ``sql.PARTS``.
    """

    def keep(job: Callable[[Corpus], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _long_integers(job(Corpus(spark, sf_dir)))

        REGISTRY[name] = Registered(run, parts.complete(sql) if sql else None)
        return job

    return keep


def _long_integers(df: DataFrame) -> DataFrame:
    """Counts and ranks as bigint, the type SQL gives them."""
    return df.select(
        *(
            F.col(name).cast("bigint").alias(name) if kind == "int" else F.col(name)
            for name, kind in df.dtypes
        )
    )
