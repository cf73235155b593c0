import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]

from mini import MINI_ANCHORS, MINI_DOCS, MINI_QUERIES, MINI_STOP  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("termloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mini(spark):
    return spark.createDataFrame(MINI_DOCS, "doc_id bigint, text string, title string")


@pytest.fixture(scope="session")
def queries(spark):
    return spark.createDataFrame(MINI_QUERIES, "query_id bigint, query_text string")


@pytest.fixture(scope="session")
def build(spark, tmp_path_factory):
    """Builds small indexes with the settings of the mini corpus."""
    from termloom import build_index

    def make(docs, **options):
        settings = dict(stopwords=MINI_STOP, min_df=0, buckets=4) | options
        return build_index(docs, str(tmp_path_factory.mktemp("index") / "ix"), **settings)

    return make


@pytest.fixture(scope="session")
def body(build, mini):
    return build(mini)


@pytest.fixture(scope="session")
def titles(build, mini):
    from pyspark.sql import functions as F

    return build(mini.select("doc_id", F.col("title").alias("text"), "title"))


@pytest.fixture(scope="session")
def anchors(spark, build):
    links = spark.createDataFrame(MINI_ANCHORS, "doc_id bigint, text string")
    return build(links, single_row=False)
