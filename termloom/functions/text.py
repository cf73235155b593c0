"""Column expressions that turn text into tokens and term counts.

Everything here works inside one row, so a document is tokenised and its terms are
counted without any shuffle.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

# A word is a letter, digit, underscore, '#' or '@', followed by further
# word characters, each of which may be preceded by one apostrophe or hyphen.  The
# classes spell out Unicode letters and digits because \w is ASCII-only in Java.
BUILD_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){2,24}"
QUERY_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){0,24}"

NO_TERMS = "CAST(array() AS array<struct<term: string, tf: int>>)"


def tokenize(text: Column, pattern: str = BUILD_PATTERN) -> Column:
    """Lower-cased words of ``text``, in order, as ``array<string>``."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def drop_words(tokens: Column, words: Sequence[str]) -> Column:
    """Remove the given words, keeping order and repeats."""
    words = list(words)
    return F.filter(tokens, lambda t: ~t.isin(words)) if words else tokens


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>``: the distinct tokens with their counts, by term.

    The tokens are sorted and the end of each run of equal ones is found; a run's length
    is the distance to the end before it.
    """

    def from_sorted(words: Column) -> Column:
        positions = F.transform(words, lambda _, i: i)
        run_ends = F.filter(
            positions, lambda i: ~F.get(words, i).eqNullSafe(F.get(words, i + 1))
        )
        return let(
            run_ends,
            lambda ends: F.transform(
                ends,
                lambda end, k: F.struct(
                    F.get(words, end).alias("term"),
                    (end - F.coalesce(F.get(ends, k - 1), F.lit(-1))).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(tokens), from_sorted)


def with_term_counts(rows: DataFrame, text: str, pattern: str) -> DataFrame:
    """Add ``terms``, the term counts of column ``text``; a null text has none.

    A column of arrays holds the tokens themselves.
    """
    given = isinstance(rows.schema[text].dataType, ArrayType)
    tokens = F.array_compact(text) if given else tokenize(F.col(text), pattern)
    counts = F.coalesce(term_counts(tokens), F.expr(NO_TERMS))
    return rows.withColumn("terms", counts)


def kept_terms(stopwords: Sequence[str]) -> Column:
    """Column ``terms`` without the stop words.

    They go after counting: one set probe per distinct term, not per token.

    When ``terms`` is a computed column, ``inline`` should be given this expression.
    Given a bare column, Spark adds a filter on its size and pushes that to the scan,
    and the text is tokenised twice.
    """
    words = ", ".join(map(_quoted, stopwords))
    condition = f"c.term NOT IN ({words})" if words else "c.tf > 0"
    return F.expr(f"filter(terms, c -> {condition})")


def with_terms(
    rows: DataFrame, text: str, pattern: str, stopwords: Sequence[str]
) -> DataFrame:
    """Add ``terms``, the term counts of column ``text`` without the stop words."""
    counted = with_term_counts(rows, text, pattern)
    return counted.withColumn("terms", kept_terms(stopwords))


def _quoted(word: str) -> str:
    escaped = word.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def total_count(counts: Column) -> Column:
    """Sum of ``tf`` over ``array<struct<term, tf>>``."""
    return F.aggregate(
        counts, F.lit(0).cast("bigint"), lambda acc, c: acc + c["tf"].cast("bigint")
    )


def word_runs(tokens: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring tokens, each joined by blanks."""
    return let(
        tokens,
        lambda words: F.transform(
            F.filter(
                F.transform(words, lambda _, i: i), lambda i: i <= F.size(words) - n
            ),
            lambda i: F.array_join(F.slice(words, i + 1, n), " "),
        ),
    )
