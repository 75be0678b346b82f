"""Markup matching with built-in expressions (WEB-1 to WEB-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named entities covered; browsers read them without the semicolon too.  "&amp;" comes last.
_ENTITIES = {"&lt;?": "<", "&gt;?": ">", "&quot;?": '"', "&nbsp;?": "\u00a0", "&amp;?": "&"}
_NUMBERED = "&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?"


def _character(number: Column) -> Column:
    """The character of a decimal or ("x...") hexadecimal number; no character: U+FFFD."""
    code = F.when(
        F.lower(F.substring(number, 1, 1)) == "x", F.conv(F.substring(number, 2, 8), 16, 10)
    ).otherwise(number).cast("int")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    code = F.when(valid, code).otherwise(0xFFFD)
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")


def _resolved(text: Column) -> Column:
    """Numbered entities, then the named ones."""
    between = F.split(text, _NUMBERED, -1)
    numbers = F.regexp_extract_all(text, F.lit(_NUMBERED), F.lit(1))
    characters = F.concat(F.transform(numbers, _character), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(between, characters, lambda a, b: F.concat(a, b)), "")
    text = F.when(text.contains("&#"), joined).otherwise(text)
    for entity, char in _ENTITIES.items():
        text = F.regexp_replace(text, entity, char)
    return text


def hrefs(html: Column, scope: str | None = None) -> Column:
    """Targets of all links of a page, in page order; ``scope`` is a pattern whose first
    group is where links count."""
    if scope:
        html = F.array_join(F.regexp_extract_all(html, F.lit(scope), F.lit(1)), "\n")
    link = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    found = F.regexp_extract_all(html, F.lit(link), F.lit(1))
    return F.transform(found, lambda target: _resolved(F.regexp_replace(target, r"^[\"']|[\"']$", "")))


def inner_text(markup: Column) -> Column:
    """Text without tags and without the white space around it; named entities resolved."""
    bare = F.when(markup.contains("<"), F.regexp_replace(markup, r"<[^>]*>", "")).otherwise(markup)
    text = F.when(markup.contains("&"), _resolved(bare)).otherwise(bare)
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def first_element(html: Column, tag: str) -> Column:
    """Text of the first element of a tag; NULL if there is none."""
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"
    return F.when(html.rlike(pattern), inner_text(F.regexp_extract(html, pattern, 1)))


def all_elements(html: Column, tag: str) -> Column:
    """Texts of all elements of a tag in page order, blanks dropped.

    Elements are split where they start: one ends at its end tag or where the next one (an
    inner one, or a neighbour after a left-out end tag) begins.
    """
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)(?=<{tag}\b|</{tag}\s*>|\z)"
    texts = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), inner_text)
    return F.filter(texts, lambda text: text != "")


def label_values(html: Column, pattern: str) -> Column:
    """(label, value) pairs of a two-group pattern, in page order."""
    labels = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
    return F.arrays_zip(labels.alias("label"), values.alias("value"))


def value_of(pairs: Column, label: str, *, part: bool = False) -> Column:
    """Value of the last pair with the label (or a label holding it); NULL if none."""

    def wanted(pair: Column) -> Column:
        return pair["label"].contains(label) if part else pair["label"] == label

    return F.try_element_at(F.filter(pairs, wanted), F.lit(-1))["value"]
