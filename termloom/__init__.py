"""Full-text retrieval as Spark DataFrame jobs.

``plans`` holds the user-level calls (build an index, search, look up, evaluate),
``operators`` the joins, aggregates and windows they are made of, ``functions`` the
column expressions, and ``sources`` the readers and the stored index.
"""

from termloom.plans.build import add_documents, add_stems, build_index
from termloom.plans.evaluate import evaluate, mean_average_precision
from termloom.plans.requests import get_pagerank, get_pageview
from termloom.plans.search import (
    search,
    search_anchor,
    search_body,
    search_body_cosine,
    search_stemmed,
    search_title,
)
from termloom.sources.index_store import Index, delete_index, read_index

__all__ = [
    "Index",
    "add_documents",
    "add_stems",
    "build_index",
    "delete_index",
    "evaluate",
    "get_pagerank",
    "get_pageview",
    "mean_average_precision",
    "read_index",
    "search",
    "search_anchor",
    "search_body",
    "search_body_cosine",
    "search_stemmed",
    "search_title",
]
