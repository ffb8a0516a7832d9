"""Licences in texts: notice phrases and identifier tags by Aho-Corasick, expressions by a shunting-yard."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from capstan.llm.texts import documents_of, per_batch

# Phrases of notices, in words, and the label each stands for.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "expat license": "mit",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software": "isc",
    "boost software license": "bsl",
    "zlib license": "zlib",
    "artistic license": "artistic",
    "open font license": "ofl",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "released into the public domain": "public-domain",
    "the unlicense": "unlicense",
    "all rights reserved": "proprietary",
}
# Words after which an expression stands. True: whatever its names; False: only of known names.
TAGS = {
    "spdx license identifier": True,
    "packagelicenseconcluded": True,
    "packagelicensedeclared": True,
    "license expression": False,
    "licensed under": False,
    "licensed under the": False,
    "released under": False,
    "released under the": False,
}
# How names of licences begin, and their labels.
FAMILIES = {
    "mit": "mit",
    "expat": "mit",
    "apache": "apache",
    "gpl": "gpl",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "mpl": "mpl",
    "epl": "epl",
    "eupl": "eupl",
    "bsd": "bsd",
    "0bsd": "bsd",
    "isc": "isc",
    "bsl": "bsl",
    "zlib": "zlib",
    "artistic": "artistic",
    "ofl": "ofl",
    "psf": "psf",
    "python": "psf",
    "wtfpl": "wtfpl",
    "unlicense": "unlicense",
    "cc0": "cc0",
    "cc-by": "cc-by",
    "cc-by-sa": "cc-by-sa",
    "cc-by-nd": "cc-by-nd",
    "cc-by-nc": "cc-by-nc",
    "cc-by-nc-sa": "cc-by-nc-sa",
    "cc-by-nc-nd": "cc-by-nc-nd",
}
# Labels that allow any use.
PERMISSIVE = frozenset(
    "mit apache bsd isc bsl zlib ofl psf wtfpl unlicense cc0 cc-by public-domain".split()
)
# Labels of a valid expression with a name of no known family, of an exception, and of what does not parse.
OTHER, EXCEPTION, MALFORMED = "other", "exception", "malformed"

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")
# What may stand between a tag and its expression, and the tokens of one.
_MARKS = re.compile(rb"[\"']?[ \t]*[:=]?[ \t]*[\"']?")
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_RANK = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Expression:
    """A licence expression in postfix order: names, and ``and``, ``or``, ``with``."""

    postfix: tuple[str, ...]

    def labels(self) -> set[str]:
        out: list[str] = []
        for token in self.postfix:
            if token == "with":
                # In place of the exception's name.
                out[-1] = EXCEPTION
            elif token not in _RANK:
                out.append(family(token))
        return set(out)

    def allowed(self, accepted: Callable[[str, bool], bool]) -> bool:
        """Whether one may choose alternatives whose parts are all accepted, by label and whether an exception is added."""
        stack: list[tuple[bool, str]] = []
        for token in self.postfix:
            if token not in _RANK:
                stack.append((accepted(family(token), False), token))
                continue
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left[0] or accepted(family(left[1]), True), left[1]))
            else:
                stack.append((left[0] and right[0] if token == "and" else left[0] or right[0], ""))
        return stack[0][0]


def family(name: str) -> str:
    """The label of the longest known beginning of a name that ends there or before a mark or digit."""
    for end in range(len(name), 0, -1):
        if name[:end] in FAMILIES and not name[end : end + 1].isalpha():
            return FAMILIES[name[:end]]
    return OTHER


def parse(tokens: Iterable[str]) -> Expression | None:
    """The expression that lower-case ``tokens`` begin with; none if it is malformed.

    ``with`` binds more closely than ``and``, ``and`` than ``or``; all run from
    left to right, ``with`` takes two names. The expression ends at the end or,
    outside brackets, before what cannot go on after a whole operand.
    """
    out: list[str] = []
    waiting: list[str] = []
    whole, depth, last = False, 0, ""

    def settle(rank: int) -> None:
        while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= rank:
            out.append(waiting.pop())

    for token in tokens:
        if whole and token in _RANK:
            if token == "with" and (last == ")" or "with" in waiting[-1:]):
                return None
            settle(_RANK[token])
            waiting.append(token)
            whole = False
        elif whole and token == ")" and depth:
            settle(0)
            waiting.pop()
            depth -= 1
        elif whole and not depth:
            break
        elif whole or token in _RANK or token == ")":
            return None
        elif token == "(":
            if last == "with":
                return None
            waiting.append(token)
            depth += 1
        else:
            out.append(token)
            whole = True
        last = token
    if not whole or depth:
        return None
    settle(0)
    return Expression(tuple(out))


def tokens_at(data: bytes, at: int) -> Iterator[str]:
    """Names, operators and brackets from a place on, up to the first other mark or the end of the line."""
    at = _MARKS.match(data, at).end()
    while found := _TOKEN.match(data, at):
        # The end of a sentence is no part of a name.
        token = found[1].decode().lower()
        name = token.rstrip(".:-")
        yield name or token
        if name != token:
            return
        at = found.end()


def known(tokens: Iterable[str]) -> list[str]:
    """The longest beginning that ends with a name of a known family, or an exception, and the brackets it closes."""
    read: list[str] = []
    end, depth = 0, 0
    for token in tokens:
        last = read[-1] if read else ""
        if token not in _RANK and token not in "()" and family(token) == OTHER and last != "with":
            break
        if token not in _RANK and token not in "()" and end and last not in _RANK and last != "(":
            break
        read.append(token)
        depth += (token == "(") - (token == ")")
        if depth < 0:
            break
        if token not in _RANK and token != "(":
            end = len(read)
    return read[:end]


@dataclass(frozen=True)
class Scanner:
    """Finds phrases and expressions in texts. ``base`` phrases count as such, ``notices`` add labels, ``tags`` expressions."""

    base: Mapping[str, str]
    notices: Mapping[str, str]
    tags: Mapping[str, bool]

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for phrase in {**self.base, **self.notices, **self.tags}:
            made.add_word(f" {phrase} ", (phrase, len(phrase.split())))
        if len(made):
            made.make_automaton()
        return made

    def scan(self, automaton: ahocorasick.Automaton, text: str) -> dict:
        data = text.encode()
        folded = data.translate(_FOLD)
        words = folded.split()
        line = f" {b' '.join(words).decode()} "
        hits, read, spaces = [], 0, 0
        for end, (phrase, length) in automaton.iter(line) if len(automaton) and words else ():
            spaces += line.count(" ", read, end)
            read = end
            hits.append((spaces - length, spaces, phrase))
        # Notices and tags inside another phrase stand for less than it does.
        longest = _outer(hits)
        base = [(start, self.base[p]) for start, _, p in hits if p in self.base]
        notices = [(start, self.notices[p]) for start, _, p in longest if p in self.notices]
        expressions = self._expressions(data, folded, [h for h in longest if h[2] in self.tags])
        return {"words": len(words), "base": base, "notices": notices, "expressions": expressions}

    def _expressions(self, data: bytes, folded: bytes, tags: list) -> list[tuple[int, Expression | None]]:
        """Expressions after tags: the word each tag starts at, and the expression, none if malformed."""
        out = []
        ends = {last: (start, self.tags[p]) for start, last, p in tags}
        last = max(ends, default=0)
        for number, word in enumerate(_WORD.finditer(folded), 1) if ends else ():
            if number in ends:
                start, any_name = ends[number]
                tokens = tokens_at(data, word.end())
                if any_name:
                    out.append((start, parse(tokens)))
                elif some := known(tokens):
                    out.append((start, parse(some)))
            if number >= last:
                break
        return out


def _outer(hits: list[tuple]) -> list[tuple]:
    """Hits that lie within no other."""
    out: list[tuple] = []
    reach = -1
    for hit in sorted(hits, key=lambda h: (h[0], -h[1])):
        if hit[1] > reach:
            out.append(hit)
            reach = hit[1]
    return out


def accepts(label: str, exception: bool) -> bool:
    """Licences that allow any use; GPL with an exception counts among them."""
    return label in PERMISSIVE or (exception and label in ("gpl", "lgpl"))


SCHEMA = (
    "doc_id long, n_words long, base array<struct<word: long, label: string>>, "
    "notices array<struct<word: long, label: string>>, "
    "expressions array<struct<word: long, postfix: string>>, labels array<string>, permissive boolean, score double"
)


def scan(
    docs: DataFrame,
    base: Mapping[str, str] | None = None,
    notices: Mapping[str, str] | None = None,
    tags: Mapping[str, bool] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licence evidence of every whole text, a row each.

    Words are runs of digits, letters a-z (A-Z count as such) and anything
    beyond ASCII. ``base`` and ``notices`` hold the places of phrases (number of
    the first word, label), in order, overlapping ones included; a notice inside
    a longer phrase is left out, a base phrase never is. ``expressions`` hold
    what stands after tags, in postfix order, null where it does not parse.
    ``labels``, sorted, are those of all three: names by family, ``other`` for
    unknown ones, ``exception`` for what follows ``with``, ``malformed``.
    ``permissive``: every notice allows any use and every expression offers a
    choice that does; null without evidence. ``score``: 1 with a valid
    expression, else 1 - 2**-n for n places.

    A null or empty text has no words and no evidence; rows without an id take
    no part; repeated rows give repeated rows; an empty table gives an empty
    one; other columns are not read.
    """
    scanner = Scanner(
        dict(BASE_PHRASES if base is None else base),
        dict(NOTICE_PHRASES if notices is None else notices),
        dict(TAGS if tags is None else tags),
    )

    def make():
        automaton = scanner.automaton()

        def function(ids: list, texts: list) -> dict[str, Iterable]:
            found = [scanner.scan(automaton, t) for t in texts]
            return {
                "doc_id": ids,
                "n_words": [f["words"] for f in found],
                "base": [_places(f["base"]) for f in found],
                "notices": [_places(f["notices"]) for f in found],
                "expressions": [
                    [{"word": w, "postfix": " ".join(e.postfix) if e else None} for w, e in f["expressions"]] for f in found
                ],
                "labels": [_labels(f) for f in found],
                "permissive": [_permissive(f) for f in found],
                "score": [_score(f) for f in found],
            }

        return function

    return per_batch(documents_of(docs, id_col, text_col), make, SCHEMA)


def _places(found: list[tuple[int, str]]) -> list[dict]:
    return [{"word": w, "label": label} for w, label in sorted(found)]


def _labels(found: dict) -> list[str]:
    out = {label for _, label in found["base"] + found["notices"]}
    for _, expression in found["expressions"]:
        out |= expression.labels() if expression else {MALFORMED}
    return sorted(out)


def _permissive(found: dict) -> bool | None:
    notices = [label in PERMISSIVE for _, label in found["base"] + found["notices"]]
    choices = [e.allowed(accepts) if e else False for _, e in found["expressions"]]
    return all(notices + choices) if notices or choices else None


def _score(found: dict) -> float:
    if any(e for _, e in found["expressions"]):
        return 1.0
    return 1.0 - 0.5 ** (len(found["base"]) + len(found["notices"]))
