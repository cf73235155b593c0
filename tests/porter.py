"""Porter's algorithm on plain strings, to check the column expressions against."""

from termloom.functions.stemmer import IRREGULAR, STEP_2, STEP_3, STEP_4


def _shape(word: str) -> str:
    """The word as a string of c (consonant) and v (vowel)."""
    shape = ""
    for letter in word:
        if letter == "y":
            shape += "v" if shape.endswith("c") else "c"
        else:
            shape += "v" if letter in "aeiou" else "c"
    return shape


def _measure(word: str) -> int:
    """How often a vowel is followed by a consonant."""
    return _shape(word).count("vc")


def _short_ending(word: str) -> bool:
    """Consonant, vowel, consonant other than w, x, y; or just vowel and consonant."""
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word.removesuffix(suffix)
        if stem != word and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if stem[-2:-1] == stem[-1] and _shape(stem)[-1] == "c":
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_ending(stem) else stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    long_consonant = len(stem) > 1 and _shape(stem)[-1] == "c"
    return stem + "i" if word.endswith("y") and long_consonant else word


def _replace(word: str, rules) -> str:
    for suffix, replacement in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + replacement if _measure(stem) > 0 else word
    return word


def _double_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffix(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _replace(word, STEP_2)


def _last_suffix(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st")
            return stem if fits else word
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        size = _measure(stem)
        if size > 1 or (size == 1 and not _short_ending(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR or len(word) <= 2:
        return IRREGULAR.get(word, word)
    word = _double_suffix(_final_y(_past(_plural(word))))
    return _final_e(_last_suffix(_replace(word, STEP_3)))
