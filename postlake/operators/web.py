"""Links and fields of raw web pages as column work (WEB-1 to WEB-5).

Every operator is row-local: pages are neither shuffled nor grouped, however
many links or items one page has.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import html as markup
from postlake.functions import tree
from postlake.operators.columns import free_names


@dataclass(frozen=True)
class LinkRule:
    """Which links of a page to keep, and the host put before relative ones."""

    any_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()
    pattern: str | None = None
    longer_than: int = 0
    host: str = ""
    within: str = ""
    unique: bool = False
    scope: str | None = None
    child_of: str | None = None
    """Class of the element whose children the links are."""
    inside: str | None = None
    """Class of an element that holds it; for ``child_of`` only."""


# --- Fixed values: posting links per source -------------------------------------
LINK_RULES = {
    "itviec": LinkRule(
        any_of=("/it-jobs/",), host="https://itviec.com", scope=r"(?is)<h3\b[^>]*>(.*?)</h3\s*>"
    ),
    "vietnamworks": LinkRule(
        any_of=("-jv", "/viec-lam/", "/job/"),
        longer_than=20,
        host="https://www.vietnamworks.com",
        within="vietnamworks.com",
        unique=True,
    ),
    "careerviet": LinkRule(
        any_of=("/tim-viec-lam/", "/viec-lam/"),
        none_of=("/nha-tuyen-dung/",),
        pattern=r"\.[A-Z0-9]{8}\.html$",
        host="https://careerviet.vn",
        within="careerviet.vn",
        unique=True,
    ),
    "topcv": LinkRule(child_of="title", inside="body-box"),
}


def _kept(href: Column, rule: LinkRule) -> Column:
    kept = href != ""
    if rule.any_of:
        kept &= reduce(or_, (href.contains(part) for part in rule.any_of))
    for part in rule.none_of:
        kept &= ~href.contains(part)
    if rule.pattern:
        kept &= href.rlike(rule.pattern)
    if rule.longer_than:
        kept &= F.length(href) > rule.longer_than
    return kept


def _absolute(href: Column, host: str) -> Column:
    return F.when(href.startswith("/"), F.concat(F.lit(host), href)).otherwise(href)


def links(pages: DataFrame, rule: LinkRule, html: str = "html") -> DataFrame:
    """WEB-1: one row per kept link; repeats of one page go before the explode."""
    if rule.child_of:
        box = tree.has_class(rule.inside) if rule.inside else None
        found = tree.child_links(F.col(html), tree.has_class(rule.child_of), box)
    else:
        found = markup.hrefs(F.col(html), rule.scope)
    found = F.filter(found, lambda href: _kept(href, rule))
    found = F.transform(found, lambda href: _absolute(href, rule.host))
    if rule.within:
        found = F.filter(found, lambda link: link.contains(rule.within))
    if rule.unique:
        found = F.array_distinct(found)
    kept = [name for name in pages.columns if name != html]
    return pages.select(*kept, F.explode(found).alias("link"))


def titles(pages: DataFrame, tag: str = "h1", html: str = "html") -> DataFrame:
    """WEB-2 and WEB-5: the title field; pages without one are dropped."""
    kept = [name for name in pages.columns if name != html]
    titled = pages.select(*kept, markup.first_element(F.col(html), tag).alias("job_title"))
    return titled.filter(F.col("job_title").isNotNull() & (F.col("job_title") != ""))


def list_items(pages: DataFrame, tag: str = "li", html: str = "html") -> DataFrame:
    """WEB-3: the texts of a list as one array."""
    kept = [name for name in pages.columns if name != html]
    return pages.select(*kept, markup.all_elements(F.col(html), tag).alias("items"))


def whole_items(pages: DataFrame, tag: str = "li", html: str = "html") -> DataFrame:
    """WEB-3 by nesting: the whole text of each item, of inner lists and what follows them too."""
    kept = [name for name in pages.columns if name != html]
    texts = tree.whole_texts(F.col(html), lambda node: node["name"] == tag)
    return pages.select(*kept, texts.alias("items"))


def grouped_values(
    pages: DataFrame, group: str, label: str, value: str, columns: Mapping[str, str], html: str = "html",
    *, part: bool = False,
) -> DataFrame:
    """WEB-4 by nesting: elements of class ``group`` hold one of class ``label`` and one of class
    ``value``; the last group of a label wins, whether or not it has a value.  ``part``: labels
    that hold the given one count."""
    kept = [name for name in pages.columns if name != html]
    (pairs,) = free_names(kept, "pairs")
    found = tree.group_values(F.col(html), *map(tree.has_class, (group, label, value)))
    paired = pages.select(*kept, found.alias(pairs))
    values = {name: markup.value_of(F.col(pairs), wanted, part=part) for name, wanted in columns.items()}
    return paired.select(*kept, *(column.alias(name) for name, column in values.items()))


def labelled_values(
    pages: DataFrame, pattern: str, columns: Mapping[str, str], html: str = "html"
) -> DataFrame:
    """WEB-4: label-value pairs as columns; the last pair of a label wins."""
    kept = [name for name in pages.columns if name != html]
    paired = pages.select(*kept, markup.label_values(F.col(html), pattern).alias("_pairs"))
    values = {name: markup.value_of(F.col("_pairs"), label) for name, label in columns.items()}
    return paired.withColumns(values).drop("_pairs")
