"""Porter's suffix-stripping algorithm (1980), with the usual later amendments, in column expressions.

It is applied to distinct terms, never to running text.  Beside a word goes its shape, a string of
c (consonant) and v (vowel); the measure of what a suffix leaves is the number of ``vc`` in as much
of the shape.  Every step binds both, so none is computed twice.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import let

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix and replacement, tried in this order; the first suffix that fits
# decides.  These apply when what is left has a measure above 0.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
# Suffixes dropped when what is left has a measure above 1.
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

VOWELS = "aeiou"


def shape(word: Column) -> Column:
    """``y`` is a vowel after a consonant, and a consonant elsewhere."""
    letters = F.translate(F.regexp_replace(word, f"[^{VOWELS}y]", "c"), VOWELS, "v" * len(VOWELS))
    first = F.regexp_replace(letters, "(^|v)y", "$1c")
    # Only runs of y after a consonant are left, in which vowels and consonants take turns.
    return F.replace(F.replace(first, F.lit("yy"), F.lit("vc")), F.lit("y"), F.lit("v"))


def _head(text: Column, less: int) -> Column:
    """``text`` without its last letters."""
    return F.substring(text, F.lit(1), F.length(text) - less)


def _measure(shaped: Column) -> Column:
    """How often a vowel is followed by a consonant."""
    return F.regexp_count(shaped, F.lit("vc"))


def _short_ending(word: Column, shaped: Column) -> Column:
    """Consonant, vowel, consonant other than w, x, y; or just vowel and consonant."""
    return (F.endswith(shaped, F.lit("cvc")) & ~F.regexp_like(word, F.lit("[wxy]$"))) | (shaped == "vc")


def _ends(word: Column, suffix: str) -> Column:
    return F.endswith(word, F.lit(suffix))


def _cases(word: Column, rules: list[tuple[Column, Column]]) -> Column:
    """The value of the first rule that holds, else the word."""
    start = F.when(*rules[0])
    return reduce(lambda done, rule: done.when(*rule), rules[1:], start).otherwise(word)


def _plural(word: Column, shaped: Column) -> Column:
    return _cases(word, [
        (_ends(word, "ies"), F.when(F.length(word) == 4, _head(word, 1)).otherwise(_head(word, 2))),
        (_ends(word, "sses"), _head(word, 2)),
        (_ends(word, "s") & ~_ends(word, "ss"), _head(word, 1)),
    ])


def _past(word: Column, shaped: Column) -> Column:
    def repaired(n: int) -> Column:
        stem, left = _head(word, n), _head(shaped, n)
        twice = F.regexp_like(stem, F.lit(r"(?s)(.)\1$")) & F.endswith(left, F.lit("c"))
        return (
            F.when(F.regexp_like(stem, F.lit("(at|bl|iz)$")), F.concat(stem, F.lit("e")))
            .when(twice, F.when(F.regexp_like(stem, F.lit("[lsz]$")), stem).otherwise(_head(stem, 1)))
            .when((_measure(left) == 1) & _short_ending(stem, left), F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )

    def dropped(suffix: str) -> Column:
        return _ends(word, suffix) & F.contains(_head(shaped, len(suffix)), F.lit("v"))

    return _cases(word, [
        (_ends(word, "ied"), F.when(F.length(word) == 4, _head(word, 1)).otherwise(_head(word, 2))),
        (_ends(word, "eed"), F.when(_measure(_head(shaped, 3)) > 0, _head(word, 1)).otherwise(word)),
        (dropped("ed"), repaired(2)),
        (dropped("ing"), repaired(3)),
    ])


def _final_y(word: Column, shaped: Column) -> Column:
    stem = _head(shaped, 1)
    long_consonant = (F.length(stem) > 1) & F.endswith(stem, F.lit("c"))
    return _cases(word, [(_ends(word, "y") & long_consonant, F.concat(_head(word, 1), F.lit("i")))])


def _replace(word: Column, shaped: Column, rules) -> Column:
    return _cases(word, [
        (
            _ends(word, suffix),
            F.when(
                _measure(_head(shaped, len(suffix))) > 0,
                F.concat(_head(word, len(suffix)), F.lit(replacement)),
            ).otherwise(word),
        )
        for suffix, replacement in rules
    ])


def _adverb(word: Column, shaped: Column) -> Column:
    return _cases(word, [(_ends(word, "alli") & (_measure(_head(shaped, 4)) > 0), _head(word, 2))])


def _double_suffix(word: Column, shaped: Column) -> Column:
    logy = F.when(_measure(_head(shaped, 3)) > 0, _head(word, 1)).otherwise(word)
    return F.when(_ends(word, "logi"), logy).otherwise(_replace(word, shaped, STEP_2))


def _last_suffix(word: Column, shaped: Column) -> Column:
    def fits(suffix: str) -> Column:
        long = _measure(_head(shaped, len(suffix))) > 1
        return long & F.regexp_like(word, F.lit("[st]ion$")) if suffix == "ion" else long

    return _cases(word, [
        (_ends(word, suffix), F.when(fits(suffix), _head(word, len(suffix))).otherwise(word))
        for suffix in STEP_4
    ])


def _final_e(word: Column, shaped: Column) -> Column:
    stem, left = _head(word, 1), _head(shaped, 1)
    size = _measure(left)
    return _cases(word, [(_ends(word, "e") & ((size > 1) | ((size == 1) & ~_short_ending(stem, left))), stem)])


def _final_l(word: Column, shaped: Column) -> Column:
    return _cases(word, [(_ends(word, "ll") & (_measure(_head(shaped, 1)) > 1), _head(word, 1))])


STEPS = (
    _plural, _past, _final_y, _adverb, _double_suffix,
    lambda word, shaped: _replace(word, shaped, STEP_3),
    _last_suffix, _final_e, _final_l,
)


def stemmed(term: Column) -> Column:
    """Stem of a term; words of up to two letters are their own."""
    lower = F.lower(term)
    known = F.create_map(*(F.lit(text) for pair in IRREGULAR.items() for text in pair))

    def after(word: Column, step) -> Column:
        return let(word, lambda w: let(shape(w), lambda s: step(w, s)))

    short = F.when(F.length(lower) <= 2, lower)
    return F.coalesce(F.element_at(known, lower), short, reduce(after, STEPS, lower))


def with_stem(rows: DataFrame, term: str = "term", name: str = "stem") -> DataFrame:
    """``rows`` with the stem of column ``term``."""
    return rows.withColumn(name, stemmed(F.col(term)))
