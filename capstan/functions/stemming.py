"""Porter's suffix stripping (Program 14(3), 1980), used by the METEOR stage."""

from __future__ import annotations

from functools import lru_cache

# The irregular words and the suffix rules with their
# replacements, as published with the later departures of the author's own
# implementation (bli, logi) and the usual extension for short -ies / -ied words.
IRREGULAR = {
    "skies": "sky",
    "sky": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}
DOUBLE_SUFFIXES = [
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
]
FULL_SUFFIXES = [
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
]
LAST_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _is_consonant(word: str, at: int) -> bool:
    if word[at] in "aeiou":
        return False
    if word[at] == "y":
        return at == 0 or not _is_consonant(word, at - 1)
    return True


def _shape(word: str) -> str:
    return "".join("c" if _is_consonant(word, i) else "v" for i in range(len(word)))


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _ends_short(word: str) -> bool:
    """Consonant-vowel-consonant at the end, the last not w, x or y."""
    if len(word) >= 3:
        return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"
    return len(word) == 2 and _shape(word) == "vc"


def _ends_double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _is_consonant(word, len(word) - 1)


def _longest(word: str, suffixes) -> str | None:
    ending = [s for s in suffixes if word.endswith(s)]
    return max(ending, key=len) if ending else None


def _plural(word: str) -> str:
    if word.endswith("ies") and len(word) == 4:
        return word[:-1]
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            return word[: len(word) - len(suffix)] + new
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _ends_double(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            if _measure(stem) == 1 and _ends_short(stem):
                return stem + "e"
            return stem
    return word


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _is_consonant(word, len(word) - 2):
        return word[:-1] + "i"
    return word


def _double(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double(word[:-2])
    table = dict(DOUBLE_SUFFIXES)
    suffix = _longest(word, table)
    if suffix:
        stem = word[: -len(suffix)]
        return stem + table[suffix] if _measure(stem) > 0 else word
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return word


def _full(word: str) -> str:
    table = dict(FULL_SUFFIXES)
    suffix = _longest(word, table)
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + table[suffix]
    return word


def _last(word: str) -> str:
    suffix = _longest(word, LAST_SUFFIXES)
    if suffix:
        stem = word[: -len(suffix)]
        if _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st"):
            return stem
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _ends_short(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _double, _full, _last, _tidy):
        word = step(word)
        if not word:
            return word
    return word
