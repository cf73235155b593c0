"""TF-IDF weights as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: keeps the query-side idf finite for a term without documents.
IDF_EPSILON = 1e-7


def idf(n_docs, df: Column) -> Column:
    """Document-side idf, log10(N / df)."""
    return F.log10(_double(n_docs) / df)


def smoothed_idf(n_docs, df: Column) -> Column:
    """Query-side idf, log10(N / (df + epsilon))."""
    return F.log10(_double(n_docs) / (df + F.lit(IDF_EPSILON)))


def query_weight(qtf: Column, query_len: Column, n_docs, df: Column) -> Column:
    """Share of the query taken by the term, times the smoothed idf."""
    return (qtf / query_len) * smoothed_idf(n_docs, df)


def cosine(dot: Column, query_norm2: Column, doc_norm2: Column) -> Column:
    """Cosine from a dot product and two squared norms; null for a zero norm."""
    return F.try_divide(dot, F.sqrt(query_norm2 * doc_norm2))


def _double(value) -> Column:
    column = value if isinstance(value, Column) else F.lit(float(value))
    return column.cast("double")
