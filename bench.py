"""Times index builds, searches and look-ups; prints one JSON line."""

import json
import os
import tempfile
import time
from statistics import median

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from termloom import evaluate, get_pagerank, get_pageview, mean_average_precision
from termloom import search, search_anchor, search_body_cosine, search_title
from termloom.inventory.corpus import Corpus
from termloom.operators.postings import word_count
from termloom.sources.shared import release, spread_rows


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("termloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    corpus = Corpus(spark, sf_dir)
    # One small job first, so that the first timing does not include JVM start-up.
    corpus.table("region").count()

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    cases = {
        "word_count": lambda: run(word_count(spread_rows(corpus.documents()))),
        "build_index_body": corpus.body_index,
        "build_index_title": corpus.title_index,
        "build_index_anchor": corpus.anchor_index,
        "search": lambda: run(
            search(corpus.body_index(), corpus.title_index(), corpus.queries())
        ),
        "search_body_cosine": lambda: run(
            search_body_cosine(
                corpus.body_index(), corpus.title_index(), corpus.queries()
            )
        ),
        "search_title": lambda: run(search_title(corpus.title_index(), corpus.queries())),
        "search_anchor": lambda: run(
            search_anchor(
                corpus.anchor_index(),
                corpus.page_titles().select(F.col("url").alias("doc_id"), "title"),
                corpus.queries(),
            )
        ),
        "get_pagerank": lambda: run(
            get_pagerank(corpus.rank_requests(), corpus.ranks(), strict=False)
        ),
        "get_pageview": lambda: run(get_pageview(corpus.view_requests(), corpus.views())),
        "scan_index": lambda: run(corpus.body_index().postings()),
    }
    def timed(case) -> float:
        start = time.perf_counter()
        case()
        return time.perf_counter() - start

    # A build is kept by the session and so runs once; the rest is the median of three.
    seconds = {}
    for name, case in cases.items():
        runs = 1 if name.startswith("build") else 3
        seconds[name] = round(median(timed(case) for _ in range(runs)), 3)

    seconds["make_truth"] = round(timed(corpus.qrels), 3)
    scores = evaluate(corpus.body_index(), corpus.title_index(), corpus.qrels())
    quality = mean_average_precision(scores).first()
    indexes = corpus.body_index(), corpus.title_index()
    seconds["evaluate"] = round(timed(lambda: run(evaluate(*indexes, corpus.qrels()))), 3)

    n_queries = corpus.queries().count()
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "n_queries": n_queries,
        "search_sec_per_query": round(seconds["search"] / max(n_queries, 1), 4),
        "mean_average_precision": round(quality.mean_average_precision or 0.0, 4),
        "evaluated_queries": quality.n_queries,
    }
    print(json.dumps(result))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
