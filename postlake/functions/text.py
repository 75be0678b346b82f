"""Text matching shared by the standardizers.

Long vocabularies become SQL text over a named column: one parsed expression
instead of hundreds of calls into the JVM to build the same tree.  The column
should hold text folded in an earlier projection, so that it is folded once per
row and not once per branch.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character as title matching sees it: any letter, decimal digit or "_", and the
# marks of decomposed letters.
WORD = r"[\p{L}\p{Nd}\p{Mn}_]"
DIGITS = r"(\d+)"


def folded(text: Column) -> Column:
    """Lower case without the blanks around; only spaces count as blanks."""
    return F.lower(F.trim(text))


def literal(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(text: str, parts: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {literal(p)})" for p in parts) + ")"


def starts_with_any(text: str, prefixes: Iterable[str]) -> str:
    return "(" + " OR ".join(f"startswith({text}, {literal(p)})" for p in prefixes) + ")"


def first_integer(text: str) -> str:
    """First run of digits as int; NULL without digits or beyond int range."""
    digits = f"regexp_extract({text}, {literal(DIGITS)}, 1)"
    # Casting an empty text throws and catches inside; an empty text is common.
    return f"try_cast(nullif({digits}, '') AS int)"


def first_match(branches: Iterable[tuple[str, str]], otherwise: str) -> str:
    """Flat CASE: the label of the first condition that holds."""
    cases = " ".join(f"WHEN {condition} THEN {literal(label)}" for condition, label in branches)
    return f"CASE {cases} ELSE {otherwise} END"


def _is_word(char: str) -> bool:
    return re.match(r"\w", char) is not None


def _escaped(keyword: str) -> str:
    return re.sub(r"([.+#/])", r"\\\1", keyword)


def word_pattern(keywords: Iterable[str]) -> str:
    """Regex for any of ``keywords`` between word boundaries, longest first.

    A boundary lies between a word and a non-word character.  Spelled with
    look-arounds, it is Unicode-aware on every JDK, and an end such as "+" or
    "#" asks for a word character beyond it, as a boundary there would.  The
    look-behind stands before the alternatives: inside a word none is tried.
    """
    by_start: dict[str, list[str]] = {}
    for keyword in sorted(keywords, key=len, reverse=True):
        before = f"(?<!{WORD})" if _is_word(keyword[0]) else f"(?<={WORD})"
        after = f"(?!{WORD})" if _is_word(keyword[-1]) else f"(?={WORD})"
        by_start.setdefault(before, []).append(_escaped(keyword) + after)
    return "|".join(f"{before}(?:{'|'.join(ends)})" for before, ends in by_start.items())


def has_word(text: str, keywords: Iterable[str]) -> str:
    """True where any keyword stands as a word of its own.

    The substring test runs first: it is a plain byte search, so the regex is
    only evaluated on the few titles that hold the keyword at all.
    """
    keywords = tuple(keywords)
    return f"({contains_any(text, keywords)} AND rlike({text}, {literal(word_pattern(keywords))}))"
