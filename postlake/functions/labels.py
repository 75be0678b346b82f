"""Free text -> label: place, level, experience, working type, company size,
category and deadline (STD-3 to STD-7, STD-10, STD-11).

``text`` names a column of folded text, ``kept`` one of trimmed original text
that is the answer where nothing is recognised.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions import terms
from postlake.functions.text import contains_any, first_integer, first_match, has_word, literal


def _place_priority() -> list[tuple[str, str]]:
    """(spelling, name) pairs, strongest first.

    The shortest spelling wins; of two equally long ones, the later listed.
    """
    listed = [(word, name) for name, words in terms.PLACES.items() for word in words]
    strongest = sorted(enumerate(listed), key=lambda at: (len(at[1][0]), -at[0]))
    return [pair for _, pair in strongest]


def place_name(text: str, kept: str) -> Column:
    """STD-4."""
    # Neighbours with one name share a branch: same result, shorter CASE.
    runs = groupby(_place_priority(), key=lambda pair: pair[1])
    branches = [(contains_any(text, [word for word, _ in run]), name) for name, run in runs]
    return F.expr(first_match(branches, kept))


def level_name(text: str, kept: str) -> Column:
    """STD-6: the highest rank named in the text."""
    highest_first = reversed(terms.LEVELS.items())
    return F.expr(first_match(((contains_any(text, ws), n) for n, ws in highest_first), kept))


def working_type(text: str, kept: str) -> Column:
    """STD-7."""
    named = ((contains_any(text, words), name) for name, words in terms.WORKING_TYPES.items())
    return F.expr(first_match(named, kept))


def experience(text: str) -> Column:
    """STD-5.  A bound without a number stays NULL: it does not fall through."""
    years = f"{first_integer(text)} || ' years'"
    return F.expr(
        f"""CASE
        WHEN {contains_any(text, terms.EXPERIENCE_NOT_REQUIRED)}
            THEN {literal(terms.NOT_REQUIRED_LABEL)}
        WHEN {contains_any(text, terms.EXPERIENCE_UNDER)} THEN '< ' || {years}
        WHEN {contains_any(text, terms.EXPERIENCE_OVER)} THEN '> ' || {years}
        ELSE {years} END"""
    )


def bare_size(size: Column) -> Column:
    """Company size text without digit grouping and line breaks."""
    return F.translate(F.trim(size), ".,\n\r", "")


def company_size(text: str, kept: str) -> Column:
    """STD-11: "1000+", "25-99", or the original text if it has a digit.

    ``text`` is a column of ``bare_size``.
    """
    at_least = r"\d+\+"
    span = r"(\d+)\s*[-–]\s*(\d+)"
    bare = F.col(text)
    low, high = F.regexp_extract(bare, span, 1), F.regexp_extract(bare, span, 2)
    # Substring tests first: a regex runs only where it can match.
    return F.when(
        bare.contains("+") & bare.rlike(at_least), F.regexp_extract(bare, at_least, 0)
    ).when(
        (bare.contains("-") | bare.contains("–")) & bare.rlike(span),
        F.concat(low, F.lit("-"), high),
    ).when(bare.rlike(r"\d"), F.col(kept))


def job_category(text: str) -> Column:
    """STD-10: of all categories named in the title, the last listed one."""
    last_first = reversed(terms.JOB_CATEGORIES.items())
    named = ((has_word(text, words), name) for name, words in last_first)
    return F.expr(first_match(named, literal(terms.OTHER_CATEGORY)))


def deadline_date(deadline: str, seen_on: Column) -> Column:
    """STD-3: the first number in the text is a count of days from ``seen_on``."""
    return F.date_add(seen_on.try_cast("date"), F.expr(first_integer(deadline)))
